"""Frequency of every distinct value or term, and which are too rare or too common."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _runs(terms: Column) -> Column:
    """(token, n) of each distinct term of an array: it is sorted, and equal neighbours are one run."""
    sequence = lambda s: F.when(F.size(s) > 0, F.sequence(F.lit(0), F.size(s) - 1)).otherwise(F.array().cast("array<int>"))
    starts = lambda s: F.filter(sequence(s), lambda i: (i == 0) | (F.get(s, i) != F.get(s, i - 1)))

    def counted(s: Column) -> Column:
        run = lambda b: F.transform(b, lambda i, k: F.struct(F.get(s, i).alias("token"), (F.coalesce(F.get(b, k + 1), F.size(s)) - i).cast("long").alias("n")))
        return F.get(F.transform(F.array(starts(s)), run), F.lit(0))

    # bound by the lambda, so that each array is sorted once
    return F.get(F.transform(F.array(F.array_sort(terms)), counted), F.lit(0))


def _counts(records: DataFrame, terms: Column, with_total: bool) -> DataFrame:
    empty = F.array().cast("array<string>")
    each = F.filter(F.coalesce(terms, empty), lambda t: t.isNotNull())
    emitted = _runs(each)
    if with_total:  # a row without a token for each record that has any
        none = F.array(F.struct(F.lit(None).cast("string").alias("token"), F.lit(0).cast("long").alias("n")))
        emitted = F.transform(F.array(emitted), lambda e: F.when(F.size(e) > 0, F.concat(e, none)).otherwise(e))
        emitted = F.get(emitted, F.lit(0))
    return records.select(F.inline(emitted)).groupBy("token").agg(F.sum("n").alias("occurrences"), F.count("*").alias("records"))


def term_counts(records: DataFrame, terms: Column) -> DataFrame:
    """How often each term occurs and in how many records.

    ``terms`` is an array of strings of a record, repeats included. Each record emits one row for each
    distinct term, with its count; Spark's hash aggregate adds these up within every task before the
    shuffle, so a term that stands in most records crosses the network once a task.

    Defined results: null arrays and null terms count for nothing; the same record given twice counts
    twice; an empty table gives no rows; other columns of ``records``, of any name, are ignored.
    Columns: ``token``, ``occurrences``, ``records``.
    """
    return _counts(records, terms, False)


def marked_terms(records: DataFrame, terms: Column, rare_at_most: int, common_above: float) -> DataFrame:
    """``term_counts`` with ``mark``: ``rare`` in at most so many records, else ``common`` in more than that share, else null.

    The share is of the records that have any term; these are counted along with the terms, in one pass. A term
    can't be both: where so few records exist that both hold, it's ``rare``.
    """
    counts = _counts(records, terms, True)
    total = counts.where("token is null").agg(F.max("records")).scalar()
    mark = F.when(F.col("records") <= rare_at_most, "rare").when(F.col("records") > F.lit(common_above) * total, "common")
    return counts.where("token is not null").withColumn("mark", mark)
