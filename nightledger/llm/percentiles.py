"""Percentiles of very large columns from cumulative frequencies.

Values are reduced to (group, value, count). Such tables of separate days or partitions add up to the
table of all. Percentiles are nearest-rank ones: the first value whose cumulative count reaches the rank
``ceil(q * n)``, which is exact; with a relative error they hold within it.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nightledger.operators.quantiles import cumulative_counts


def binned(value: Column, relative_error: float) -> Column:
    """The value itself, or with an error the middle of its geometric bin, at most that share away."""
    if relative_error == 0:
        return value
    width = 2 * math.log1p(relative_error)
    size = F.exp(F.round(F.log(F.abs(value)) / width) * width)
    return F.when(value == 0, F.lit(0.0)).otherwise(F.signum(value) * size)


def value_counts(rows: DataFrame, group: Sequence[str], value: Column, relative_error: float = 0.0) -> DataFrame:
    """(group..., value, n). Null and NaN values don't count; null groups are groups of their own; -0.0 is 0.0."""
    v = value.cast("double") + F.lit(0.0)
    d = rows.select(*group, v.alias("value")).where(F.col("value").isNotNull() & ~F.isnan("value"))
    return d.withColumn("value", binned(F.col("value"), relative_error)).groupBy(*group, "value").agg(F.count("*").alias("n"))


def combine(counts: DataFrame, group: Sequence[str]) -> DataFrame:
    """Tables of parts, put together with ``unionByName`` or along a dropped column, as one table."""
    return counts.groupBy(*group, "value").agg(F.sum("n").alias("n"))


def percentiles(counts: DataFrame, group: Sequence[str], quantiles: Sequence[float]) -> DataFrame:
    """The values at ``quantiles`` (each in [0, 1]) of every group.

    Counts are range-partitioned by group and value; each partition sums up its own rows in order, and
    what the partitions before it hold of the same group is added as an offset. A group may so span
    any number of partitions; no task holds more than one range of it.

    Defined results: a group without values has no rows; 0 gives the least value; an empty table gives
    no rows. Columns: the group, ``q``, ``value``, ``n`` (the group's count of values).
    """
    if any(not 0 <= q <= 1 for q in quantiles):
        raise ValueError("quantiles lie in [0, 1]")
    joined = cumulative_counts(counts, group)
    ranks = F.array(*[F.struct(F.lit(float(q)).alias("q"), F.greatest(F.ceil(F.col("total") * float(q) - 1e-9), F.lit(1)).alias("rank")) for q in quantiles])
    hit = F.filter(ranks, lambda r: (r["rank"] <= F.col("upto")) & (r["rank"] > F.col("upto") - F.col("n")))
    return joined.select(*group, "value", "total", F.explode(hit).alias("r")).select(*group, F.col("r.q").alias("q"), "value", F.col("total").alias("n"))
