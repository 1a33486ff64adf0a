import math
import random

from nightledger.llm import percentiles as pc
from pyspark.sql import functions as F

Q = (0.0, 0.1, 0.5, 0.9, 1.0)


def nearest(values, q):
    values = sorted(values)
    return values[max(1, math.ceil(q * len(values) - 1e-9)) - 1]


def test_parts_together_are_the_whole(spark):
    rng = random.Random(2)
    rows = [(rng.choice(["a", "b", None]), rng.randint(1, 5), rng.choice([None, math.nan, -0.0, 0.0, rng.randint(-5, 5) * 1.0, rng.random() * 1e6])) for _ in range(3000)]
    df = spark.createDataFrame(rows, "g string, day int, v double").withColumns({"n": F.lit(3), "part": F.lit(0), "value": F.lit("x")})
    daily = pc.value_counts(df, ["day", "g"], F.col("v"))
    got = {(r["g"], r["q"]): (r["value"], r["n"]) for r in pc.percentiles(pc.combine(daily, ["g"]), ["g"], Q).collect()}
    for g in ("a", "b", None):
        values = [v for x, _, v in rows if x == g and v is not None and v == v]
        for q in Q:
            assert got[(g, q)] == (nearest(values, q), len(values))
    assert len(got) == 15


def test_relative_error(spark):
    values = [math.exp(x / 500) for x in range(5000)] + [-3.0, 0.0]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    counts = pc.value_counts(df, [], F.col("v"), 0.01)
    assert counts.count() < 1000 < len(values)
    for r in pc.percentiles(counts, [], Q).collect():
        exact = nearest(values, r["q"])
        assert abs(r["value"] - exact) <= 0.0101 * abs(exact)


def test_hot_group_spans_partitions_and_empty(spark):
    df = spark.range(0, 20_000).select(F.lit("hot").alias("g"), (F.col("id") % 5000).cast("double").alias("v"))
    counts = pc.value_counts(df, ["g"], F.col("v"))
    got = {r["q"]: r["value"] for r in pc.percentiles(counts, ["g"], (0.25, 0.5, 1.0)).collect()}
    assert got == {0.25: 1249.0, 0.5: 2499.0, 1.0: 4999.0}
    assert pc.percentiles(counts.limit(0), ["g"], Q).count() == 0
