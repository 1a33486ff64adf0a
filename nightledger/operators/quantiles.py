"""Exact quantiles per group from cumulative frequencies; a group may span any number of tasks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from nightledger.session import store


def cumulative_counts(counts: DataFrame, group: Sequence[str]) -> DataFrame:
    """Adds ``upto``, the group's count of values up to the row's, and ``total`` to (group..., value, n).

    Rows are range-partitioned by group and value; each partition sums up its own rows in order, and what the
    partitions before it hold of the same group is added as an offset. No task holds more than one range of a
    group. Null groups are groups of their own.
    """
    keys = [f"k{i}" for i in range(len(group))]
    flat = counts.select(*[F.col(c).alias(k) for c, k in zip(group, keys)], "value", "n")
    ranged = flat.repartitionByRange(*[F.col(k) for k in keys], F.col("value")).withColumn("part", F.spark_partition_id())
    # written down, so that the ranges stay what they are
    table, _ = store(ranged, "ranged-counts")
    sums = table.groupBy("part", *keys).agg(F.sum("n").alias("part_n"))
    # one row a partition and group: as many as there are partitions, besides one a group
    whole = Window.partitionBy(*keys)
    before = whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("part", *keys, F.coalesce(F.sum("part_n").over(before), F.lit(0)).alias("offset"), F.sum("part_n").over(whole).alias("total"))
    running = Window.partitionBy("part", *keys).orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    summed = table.withColumn("upto", F.sum("n").over(running))
    on = F.col("l.part") == F.col("s.part")
    for k in keys:
        on &= F.col(f"l.{k}").eqNullSafe(F.col(f"s.{k}"))
    joined = summed.alias("l").join(sums.alias("s"), on)
    return joined.select(*[F.col(f"l.{k}").alias(c) for c, k in zip(group, keys)], "value", "n", (F.col("upto") + F.col("offset")).alias("upto"), "total")


def quantiles_of_counts(counts: DataFrame, group: Sequence[str], quantiles: dict[str, float], extra: dict[str, Column] | None = None) -> DataFrame:
    """Linear-interpolation quantiles, by name, of (group..., value, c): each value once a group, with its count.

    ``extra`` holds further columns over ``n`` (rows of the group): aggregates of ``value`` weighted by ``c``.
    """
    summed = cumulative_counts(counts.withColumnRenamed("c", "n"), group).withColumnsRenamed({"n": "c", "total": "n"})
    at = lambda pos: F.min(F.when(F.col("upto") > pos, F.col("value")))
    out = {}
    for name, q in quantiles.items():
        pos = (F.col("n") - 1) * float(q)
        out[f"{name}_lo"], out[f"{name}_hi"] = at(F.floor(pos)), at(F.ceil(pos))
    aggs = [c.alias(k) for k, c in out.items()] + [F.first("n").alias("n")] + [c.alias(k) for k, c in (extra or {}).items()]
    got = summed.groupBy(*group).agg(*aggs)
    values = [
        (F.col(f"{k}_lo") + (F.col(f"{k}_hi") - F.col(f"{k}_lo")) * ((F.col("n") - 1) * float(q) - F.floor((F.col("n") - 1) * float(q)))).alias(k) for k, q in quantiles.items()
    ]
    return got.select(*group, "n", *values, *(extra or {}))


def group_quantiles(rows: DataFrame, group: Sequence[str], value: Column, quantiles: dict[str, float], extra: dict[str, Column] | None = None) -> DataFrame:
    """Linear-interpolation quantiles of the values that are there, by name, for each group.

    Values are first counted per group and distinct value, in part before the shuffle. Null and NaN values
    don't count; a group of only those has no row.
    """
    v = value.cast("double") + F.lit(0.0)
    d = rows.select(*group, v.alias("value")).where(F.col("value").isNotNull() & ~F.isnan("value"))
    return quantiles_of_counts(d.groupBy(*group, "value").agg(F.count("*").alias("c")), group, quantiles, extra)


def distribution(rows: DataFrame, group: Sequence[str], value: Column) -> DataFrame:
    """Count, least, quantiles, mean and greatest of each group."""
    extra = {"least": F.min("value"), "mean": F.sum(F.col("value") * F.col("c")) / F.sum("c"), "greatest": F.max("value")}
    return group_quantiles(rows, group, value, {"p10": 0.1, "p25": 0.25, "p50": 0.5, "p75": 0.75, "p90": 0.9}, extra)


def medians(rows: DataFrame, group: Sequence[str], value: Column, name: str = "median") -> DataFrame:
    return group_quantiles(rows, group, value, {name: 0.5})


def percentile_position(rows: DataFrame, group: Sequence[str], value: Column, reference: DataFrame, ref: str) -> DataFrame:
    """For each group the share, in percent to two digits, of values at most the group's ``ref`` in ``reference``."""
    counts = rows.select(*group, value.cast("double").alias("value")).where(F.col("value").isNotNull() & ~F.isnan("value")).groupBy(*group, "value").agg(F.count("*").alias("c"))
    joined = counts.join(reference.select(*group, F.col(ref).alias("ref_")), list(group))
    return joined.groupBy(*group).agg(F.round(100 * F.sum(F.when(F.col("value") <= F.col("ref_"), F.col("c")).otherwise(0)) / F.sum("c"), 2).alias("position"))
