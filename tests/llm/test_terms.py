from collections import Counter

from nightledger.functions.text import compared_values
from nightledger.llm import terms
from pyspark.sql import functions as F


def test_counts_and_marks(spark, rows):
    records = [(1, ["A", "a ", "b"], ["c"]), (2, None, ["A"]), (3, [], []), (4, [None, " "], ["a", "b"]), (1, ["a"], None)]
    df = spark.createDataFrame(records, "id long, x array<string>, y array<string>").withColumn("token", F.lit("z"))
    values = compared_values("x", "y")
    counts = terms.term_counts(df, values)
    assert rows(counts) == [("a", 5, 4), ("b", 2, 2), ("c", 1, 1)]
    marked = rows(terms.marked_terms(df, values, 1, 0.5).select("token", "occurrences", "records", "mark"))
    assert marked == [("a", 5, 4, "common"), ("b", 2, 2, None), ("c", 1, 1, "rare")]
    assert rows(terms.term_counts(df.limit(0), values)) == rows(terms.marked_terms(df.limit(0), values, 1, 0.5)) == []


def test_half_is_not_common(spark):
    df = spark.createDataFrame([(["a"],), (["b"],), (["a"],), (["b"],)], "x array<string>")
    marks = {r["token"]: r["mark"] for r in terms.marked_terms(df, F.col("x"), 1, 0.5).collect()}
    assert marks == {"a": None, "b": None}


def test_long_arrays(spark):
    values = [str(i % 977) for i in range(30_000)]
    df = spark.createDataFrame([(values,)], "x array<string>")
    got = {r["token"]: r["occurrences"] for r in terms.term_counts(df, F.col("x")).collect()}
    assert got == Counter(values)
