"""Joins, deduplication, numbering and windows over ordered history."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from nightledger.session import store


def keep_one(rows: DataFrame, key: Sequence[str], order: Sequence[Column | tuple[Column, str]], last: bool = False) -> DataFrame:
    """One row a key (nulls are a key), the first or last by ``order``: ascending columns, null least.

    An aggregate over whole rows, combined before the shuffle, so that a key with many rows costs no more
    than one row a task.
    """
    rank = F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)])
    rest = [c for c in rows.columns if c not in key]
    row = F.struct(rank.alias("rank_"), F.struct(*[F.col(c) for c in rest]).alias("row_"))
    best = rows.groupBy(*key).agg((F.max_by if last else F.min_by)(row, rank).alias("best_"))
    return best.select(*key, *[F.col("best_.row_")[c].alias(c) for c in rest]).select(*rows.columns)


def previous(rows: DataFrame, key: Sequence[str], order: str, columns: Sequence[str], prefix: str = "previous_") -> DataFrame:
    """Adds the columns of the row before, in the key's history."""
    w = Window.partitionBy(*key).orderBy(order)
    return rows.select("*", *[F.lag(c).over(w).alias(prefix + c) for c in columns])


def rank_descending(rows: DataFrame, key: Sequence[str], value: str, name: str) -> DataFrame:
    """Competition rank from the greatest value down; a null value has no rank and moves none."""
    w = Window.partitionBy(*key).orderBy(F.desc_nulls_last(value))
    return rows.withColumn(name, F.when(F.col(value).isNotNull(), F.rank().over(w)))


def carry_forward(rows: DataFrame, key: Sequence[str], order: str, columns: Sequence[str]) -> DataFrame:
    """Nulls take the last value before them in the key's order.

    Rows are range-partitioned by key and order, carried on within each partition, and what is still null takes
    the last value that the partitions before it hold of the key: a key's rows may lie in any number of tasks.
    """
    ranged, _ = store(rows.repartitionByRange(*key, order).withColumn("part_", F.spark_partition_id()), "carried")
    within = Window.partitionBy("part_", *key).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    d = ranged.withColumns({c: F.last(c, ignorenulls=True).over(within) for c in columns})
    # one row for each partition and key
    at = [F.max_by(c, F.when(F.col(c).isNotNull(), F.col(order))).alias(f"last_{c}") for c in columns]
    ends = ranged.groupBy("part_", *key).agg(*at)
    before = Window.partitionBy(*key).orderBy("part_").rowsBetween(Window.unboundedPreceding, -1)
    ends = ends.select(F.col("part_").alias("p_"), *[F.col(k).alias(f"k_{k}") for k in key], *[F.last(f"last_{c}", ignorenulls=True).over(before).alias(f"last_{c}") for c in columns])
    on = F.col("part_") == F.col("p_")
    for k in key:
        on &= F.col(k).eqNullSafe(F.col(f"k_{k}"))
    return d.join(ends, on, "left").withColumns({c: F.coalesce(c, f"last_{c}") for c in columns}).select(*rows.columns)


def number_rows(rows: DataFrame, order: Sequence[str], name: str = "index") -> DataFrame:
    """Numbers from 1 in the order of columns that together are unique.

    Range-partitioned, numbered within each partition and moved by what the partitions before hold, so that
    no task sees all rows.
    """
    ranged, _ = store(rows.repartitionByRange(*order).withColumn("part_", F.spark_partition_id()), "ranged")
    sizes = ranged.groupBy("part_").agg(F.count("*").alias("size_"))
    # one row a partition
    before = Window.orderBy("part_").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("part_", F.coalesce(F.sum("size_").over(before), F.lit(0)).alias("before_"), F.sum("size_").over(Window.partitionBy()).alias("total_"))
    within = F.row_number().over(Window.partitionBy("part_").orderBy(*order))
    return ranged.withColumn("n_", within).join(sizes, "part_").withColumn(name, F.col("n_") + F.col("before_")).drop("part_", "n_", "before_")


def largest_by_magnitude(rows: DataFrame, value: str, tie: str, n: int) -> DataFrame:
    """The n rows of the greatest magnitude, of equal ones the least ``tie``; nulls and NaN take no part."""
    return rows.where(F.col(value).isNotNull() & ~F.isnan(value)).orderBy(F.abs(F.col(value)).desc(), F.col(tie)).limit(n)


def next_batch(targets: DataFrame, attempted: DataFrame, key: Sequence[str], order: Sequence[str], n: int) -> DataFrame:
    """The first n targets, by ``order``, that weren't attempted yet."""
    return targets.join(attempted.select(*key).distinct(), list(key), "left_anti").orderBy(*order).limit(n)


def shards(rows: DataFrame, order: Sequence[str], count: int, name: str = "shard") -> DataFrame:
    """Contiguous balanced shards from 1; the first ones get the remainder."""
    d = number_rows(rows, order, "index_")
    size, more = F.floor(F.col("total_") / count), F.col("total_") % count
    i = F.col("index_") - 1
    shard = F.when(i < more * (size + 1), F.floor(F.try_divide(i, size + 1))).otherwise(more + F.floor(F.try_divide(i - more * (size + 1), size)))
    return d.withColumn(name, (shard + 1).cast("int")).drop("index_", "total_")


def in_windows(windows: Sequence[Mapping[str, Any]], columns: Sequence[str], on_missing: str = "error", aliases: Mapping[str, str] | None = None) -> Column:
    """Whether a row lies in any window: all of its non-null keys equal the row's columns.

    Unknown keys are an error or, with ``on_missing="skip"``, don't restrict. No windows, or one
    without keys, take every row.
    """
    aliases = aliases or {}
    terms = []
    for w in windows:
        parts = []
        for k, v in w.items():
            c = aliases.get(k, k)
            if v is None:
                continue
            if c not in columns:
                if on_missing == "error":
                    raise ValueError(f"no such column: {k}")
                continue
            parts.append(F.col(c) == F.lit(v))
        terms.append(reduce(lambda a, b: a & b, parts) if parts else F.lit(True))
    return F.coalesce(reduce(lambda a, b: a | b, terms), F.lit(False)) if terms else F.lit(True)


def in_contexts_of(rows: DataFrame, subject: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows whose context occurs among the subject's, null contexts included."""
    kept = [c for c in columns if c in rows.columns and c in subject.columns]
    if not kept:
        return rows
    ctx = subject.select(*[F.col(c).alias(f"ctx_{c}") for c in kept]).distinct()
    on = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"ctx_{c}")) for c in kept])
    return rows.join(ctx, on, "left_semi")


def latest(rows: DataFrame, column: str) -> DataFrame:
    """Rows with the greatest value of ``column``."""
    return rows.where(F.col(column) == rows.agg(F.max(column)).scalar())


def later_run_wins(rows: DataFrame, entity: str, run: str) -> DataFrame:
    """Of each entity the rows of its last run; null entities keep none."""
    last = rows.where(F.col(entity).isNotNull()).groupBy(entity).agg(F.max(run).alias("last_run_"))
    return rows.join(last, entity).where(F.col(run) == F.col("last_run_")).drop("last_run_")


def fill_from_first(rows: DataFrame, entity: str, order: str, columns: Sequence[str]) -> DataFrame:
    """Nulls of ``columns`` take the entity's first value that isn't null, by ``order``."""
    firsts = rows.groupBy(entity).agg(*[F.min_by(c, F.when(F.col(c).isNotNull(), F.col(order))).alias(f"first_{c}") for c in columns])
    joined = rows.join(firsts.withColumnRenamed(entity, "entity_"), F.col(entity).eqNullSafe(F.col("entity_")), "left")
    return joined.withColumns({c: F.coalesce(c, f"first_{c}") for c in columns}).select(*rows.columns)


def reconcile(rows: DataFrame, known: DataFrame, key: Sequence[str], column: str, order: str, flag: str) -> DataFrame:
    """Nulls and blanks of ``column`` take the first value ``known`` has under ``key``; ``flag`` says which did."""
    index = known.where(F.coalesce(F.trim(column), F.lit("")) != "").groupBy(*key).agg(F.min_by(column, order).alias("found_"))
    missing = F.coalesce(F.trim(column), F.lit("")) == ""
    joined = rows.join(index, list(key), "left")
    return joined.withColumns({flag: missing & F.col("found_").isNotNull(), column: F.when(missing, F.coalesce("found_", column)).otherwise(F.col(column))}).select(*rows.columns, flag)


def missing_windows(required: DataFrame, done: DataFrame, key: Sequence[str]) -> DataFrame:
    """Required (entity, window) rows that aren't done."""
    return required.join(done.select(*key).distinct(), list(key), "left_anti")


def upsert(existing: DataFrame, new: DataFrame, key: Sequence[str], order: Sequence[str] = (), priority: Column | None = None) -> DataFrame:
    """Both tables with one row a key: the new one, or with ``priority`` the least, then the earlier."""
    both = existing.withColumn("batch_", F.lit(0)).unionByName(new.withColumn("batch_", F.lit(1)), allowMissingColumns=True)
    cols = [F.col(c) for c in order]
    out = keep_one(both, key, [F.col("batch_"), *cols], last=True) if priority is None else keep_one(both, key, [priority, F.col("batch_"), *cols])
    return out.drop("batch_")
