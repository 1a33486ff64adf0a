"""Top N items within every group, by simultaneous bisection of all groups' cutoffs.

An item's rank is a list of codes (longs of 0 or more) whose order is the rank order: two for each
number, then the identifier's bytes, seven at a time. Each round cuts every open group's interval of the
first code that still differs by midpoints, counts the rows between them, and so finds the slice that the
group's cutoff lies in: rows above it are kept, rows below it are dropped, and only those within it are
written for the next round. Groups of no more than N items leave before the first. The identifier's codes are
made only for what is tied in all numbers. Other groups don't matter to a group, and no group is ever sorted
or gathered.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from nightledger.session import remove_path, store

#: Slices an interval is cut into each round: 255 midpoints at once, eight bisections.
SLICES = 256
#: Groups up to this many have their cutoffs broadcast; more are joined by shuffle, hot ones split by AQE.
BROADCAST_GROUPS = 200_000
#: Codes of the identifier looked at in one round, and the bytes in each.
_WINDOW, _BYTES = 12, 7
_INFINITY = 0x7FF0000000000000


def magnitude_bits(c: Column) -> Column:
    """The IEEE bits of a number of 0 or more, as a long of the same order."""
    return F.java_method(F.lit("java.lang.Double"), F.lit("doubleToRawLongBits"), F.coalesce(c, F.lit(0.0))).cast("long")


def number_codes(c: Column, descending: bool) -> list[Column]:
    """Two codes, of the sign and of the magnitude; null and NaN come last either way, -0.0 is 0.0."""
    c = F.when(~F.isnan(c), c.cast("double"))
    bits = magnitude_bits(F.abs(c))
    if descending:
        first = F.when(c.isNull(), 2).when(c < 0, 1).otherwise(0)
        second = F.when(c < 0, bits).otherwise(F.lit(_INFINITY) - bits)
    else:
        first = F.when(c.isNull(), 2).when(c < 0, 0).otherwise(1)
        second = F.when(c < 0, F.lit(_INFINITY) - bits).otherwise(bits)
    return [first.cast("long"), F.when(c.isNull(), F.lit(0).cast("long")).otherwise(second)]


def _identifier_codes(offset: Column) -> list[Column]:
    """The identifier's next codes: seven bytes each with their number, so that a prefix comes first."""
    out = []
    ident = F.encode("i", "utf-8")
    for k in range(_WINDOW):
        part = F.substring(ident, offset + (k * _BYTES + 1), F.lit(_BYTES))
        number = F.conv(F.rpad(F.hex(part), 2 * _BYTES, "0"), 16, 10).cast("long")
        out.append(number * 8 + F.length(part))
    return out


def _small(d: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(d) if rows <= BROADCAST_GROUPS else d


def _round(live: DataFrame, codes: Sequence[Column], paths: list[str]) -> tuple[DataFrame, DataFrame]:
    """One round over all open groups of ``live`` (g, need, ...): (rows with ``kept`` and ``on``, the groups' cutoffs)."""
    spark = live.sparkSession
    groups = Observation()
    stats = live.groupBy("g").agg(F.count("*").alias("size"), F.first("need").alias("need"), *[f(c).alias(f"{n}{k}") for k, c in enumerate(codes) for n, f in (("lo", F.min), ("hi", F.max))])
    comp, lo, hi = F.lit(-1), F.lit(None).cast("long"), F.lit(None).cast("long")
    for k in reversed(range(len(codes))):  # the first code in which the group's rows differ
        differ = F.col(f"lo{k}") < F.col(f"hi{k}")
        comp, lo, hi = F.when(differ, k).otherwise(comp), F.when(differ, F.col(f"lo{k}")).otherwise(lo), F.when(differ, F.col(f"hi{k}")).otherwise(hi)
    stats = stats.select("g", "size", "need", comp.alias("comp"), lo.alias("lo"), hi.alias("hi")).withColumn("width", F.expr(f"(hi - lo) div {SLICES} + 1")).drop("hi")
    stats, stats_path = store(stats.observe(groups, F.count("*").alias("n"), F.count_if((F.col("size") > F.col("need")) & (F.col("comp") >= 0)).alias("open")), "top-n-stats")
    n, some = groups.get["n"], groups.get["open"]
    value = F.lit(None).cast("long")
    for k in reversed(range(len(codes))):
        value = F.when(F.col("comp") == k, codes[k]).otherwise(value)
    sliced = F.expr("(value - lo) div width")
    cuts = spark.createDataFrame([], "g string, above long, cut long, within long")
    if some:
        opened = stats.where((F.col("size") > F.col("need")) & (F.col("comp") >= 0))
        cuts = live.drop("need").join(_small(opened, n), "g").withColumn("value", value).groupBy("g", sliced.alias("slice")).agg(F.count("*").alias("n"), F.first("need").alias("need"))
        # the counts below each midpoint: at most SLICES numbers a group, folded in order
        cuts = cuts.groupBy("g").agg(F.sort_array(F.collect_list(F.struct("slice", "n"))).alias("bars"), F.first("need").alias("need"))
        fold = F.aggregate(
            "bars",
            F.struct(F.lit(0).cast("long").alias("above"), F.lit(-1).cast("long").alias("cut"), F.lit(0).cast("long").alias("within")),
            lambda acc, bar: F.when(acc["cut"] >= 0, acc).otherwise(
                F.struct(
                    F.when(acc["above"] + bar["n"] < F.col("need"), acc["above"] + bar["n"]).otherwise(acc["above"]).alias("above"),
                    F.when(acc["above"] + bar["n"] < F.col("need"), F.lit(-1).cast("long")).otherwise(bar["slice"]).alias("cut"),
                    bar["n"].alias("within"),
                )
            ),
        )
        cuts = cuts.select("g", fold.alias("f")).select("g", "f.*")
    plan, plan_path = store(stats.join(_small(cuts, n), "g", "left"), "top-n-cuts")
    remove_path(spark, stats_path)
    paths.append(plan_path)
    step = live.drop("need").join(_small(plan, n), "g").withColumn("value", value).withColumn("slice", sliced)
    whole, stuck = F.col("size") <= F.col("need"), F.col("comp") < 0
    at = F.col("slice") == F.col("cut")
    last = F.col("above") + F.col("within") == F.col("need")
    step = step.withColumns({
        "kept": whole | F.coalesce(~stuck & ((F.col("slice") < F.col("cut")) | (at & last)), F.lit(False)),
        "on": ~whole & (stuck | F.coalesce(at & ~last, F.lit(False))),
        "stuck": stuck,
        "need": F.when(stuck, F.col("need")).otherwise(F.col("need") - F.coalesce("above", F.lit(0))),
    })
    return step, plan


def top_n(
    items: DataFrame,
    group: str,
    identifier: str,
    order: Sequence[tuple[str, bool]],
    limits: DataFrame,
    limit_column: str,
    default: int,
) -> DataFrame:
    """The first N items of each group, where N is the group's row in ``limits`` or ``default``.

    ``order`` lists numeric columns with True for descending; nulls and NaN come last; what is still
    tied is ordered by the bytes of ``identifier`` ascending, so the result is always the same. An
    identifier listed more than once in a group counts once, by its best row. ``limits`` has one row
    a group; its null, zero and negative limits count as the default.

    Defined results: items with a null group or identifier take no part; a group with fewer than N
    items keeps all; an empty table gives no rows. Columns: ``group``, ``identifier``, the order columns.
    """
    if default < 1:
        raise ValueError("the default limit must be positive")
    names = [c for c, _ in order]
    values = [F.col(f"v_{c}") for c in names]
    codes = [code for c, down in order for code in number_codes(F.col(f"v_{c}"), down)]
    fixed = [F.col(f"c{k}") for k in range(len(codes))]
    rows = items.select(F.col(group).cast("string").alias("g"), F.col(identifier).cast("string").alias("i"), *[F.col(c).cast("double").alias(f"v_{c}") for c in names]).where("g is not null and i is not null")
    best = rows.select("g", "i", F.struct(*[c.alias(f"c{k}") for k, c in enumerate(codes)], *values).alias("best")).groupBy("g", "i").agg(F.min("best").alias("best"))
    n = limits.where(F.col(limit_column) > 0).groupBy(F.col(group).cast("string").alias("g")).agg(F.max(limit_column).cast("long").alias("need"))
    start = best.join(n, "g", "left").select("g", "i", "best.*", F.coalesce("need", F.lit(default).cast("long")).alias("need"), F.lit(0).alias("offset"))
    spark = items.sparkSession
    live, path = store(start, "top-n-items")
    paths = [path]
    done: list[DataFrame] = []
    tied: list[DataFrame] = []  # rows alike in all numbers, of groups that are still open
    by_number = True
    while True:
        step, _ = _round(live, fixed if by_number else _identifier_codes(F.col("offset")), paths)
        done.append(step.where("kept").select("g", "i", *values))
        counts = Observation()
        offset = F.when(F.col("stuck"), F.col("offset") + _WINDOW * _BYTES).otherwise(F.col("offset")) if not by_number else F.col("offset")
        going = step.where("on").select("g", "i", *fixed, *values, "need", offset.alias("offset"), "stuck")
        going, path = store(going.observe(counts, F.count_if("stuck").alias("stuck"), F.count_if(~F.col("stuck")).alias("open")), "top-n-items")
        paths.append(path)
        stuck, some = counts.get["stuck"], counts.get["open"]
        if by_number:
            if stuck:
                tied.append(going.where("stuck").drop("stuck"))
            live = going.where("not stuck").drop("stuck")
            if not some:
                if not tied:
                    break
                live, by_number = reduce(DataFrame.unionByName, tied), False
        elif stuck or some:
            live = going.drop("stuck")
        else:
            break
    out, _ = store(reduce(DataFrame.unionByName, done), "top-n")
    for p in paths:
        remove_path(spark, p)
    kinds = {c: items.schema[c].dataType for c in (group, identifier)}
    return out.select(F.col("g").cast(kinds[group]).alias(group), F.col("i").cast(kinds[identifier]).alias(identifier), *[F.col(f"v_{c}").alias(c) for c in names])
