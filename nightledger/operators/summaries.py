"""Aggregates that describe tables and histories."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nightledger.operators.quantiles import medians, quantiles_of_counts
from nightledger.operators.relational import keep_one
from nightledger.session import store


def modes(rows: DataFrame, group: Sequence[str], column: str, name: str) -> DataFrame:
    """The most frequent value that isn't blank, blanks at its ends aside; of equal ones the least.

    Counted per group and value first, so no task holds a group's values.
    """
    v = F.trim(F.col(column))
    counts = rows.select(*group, v.alias("v")).where("v <> ''").groupBy(*group, "v").agg(F.count("*").alias("n"))
    return counts.groupBy(*group).agg(F.min_by("v", F.struct(-F.col("n"), F.col("v"))).alias(name))


def usual_values(rows: DataFrame, group: Sequence[str], text: str, number: str) -> DataFrame:
    """The group's median number where it has any, and its most frequent text, which stands in where it hasn't."""
    usual = modes(rows, group, text, "usual_text")
    middle = medians(rows, group, F.col(number).cast("string").try_cast("double"), "usual_number").drop("n")
    return usual.join(middle, list(group), "full_outer")


def default_subject(rows: DataFrame, entity: str) -> DataFrame:
    """One row: the entity with the most rows, of equal ones the least; blank ones don't count."""
    counts = rows.where(F.trim(F.col(entity)) != "").groupBy(entity).agg(F.count("*").alias("rows"))
    return counts.agg(F.min_by(F.struct(entity, "rows"), F.struct(-F.col("rows"), F.col(entity))).alias("x")).where("x is not null").select("x.*")


def type_counts(rows: DataFrame, column: str) -> DataFrame:
    label = F.coalesce(F.nullif(F.trim(F.col(column)), F.lit("")), F.lit("(missing)"))
    return rows.groupBy(label.alias("label")).agg(F.count("*").alias("n"))


def missing_shares(rows: DataFrame) -> DataFrame:
    """(column, missing) to four digits: the share of nulls and NaN; null for an empty table. One scan."""
    kinds = dict(rows.dtypes)
    gone = {c: F.col(c).isNull() | (F.isnan(c) if kinds[c] in ("double", "float") else F.lit(False)) for c in rows.columns}
    one = rows.agg(*[F.round(F.avg(g.cast("int")), 4).alias(c) for c, g in gone.items()])
    return one.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("missing")) for c in rows.columns])))


def profiles(offers: DataFrame, entity: str) -> DataFrame:
    """One row an entity: its usual name and type, median numbers, rows and distinct rooms; null entities have none.

    All of it comes from one table of counts, a row for each entity, measure and value: numbers and texts alike
    are counted before they move, and an entity with many rows is many counts in no one's hands.
    """
    numbers, texts = ("latitude", "longitude", "price_per_night"), ("property_name", "property_type")
    none = F.lit(None)
    of = lambda m, text, number: F.struct(F.lit(m).alias("measure"), text.cast("string").alias("text"), number.cast("double").alias("number"))
    each = [of("rows", none, none), of("room", F.col("room_id"), none), *[of(c, F.trim(c), none) for c in texts], *[of(c, none, F.col(c) + F.lit(0.0)) for c in numbers]]
    d = offers.where(F.trim(F.col(entity)) != "").select(F.col(entity).alias("e"), F.inline(F.array(*each)))
    counts, _ = store(d.groupBy("e", "measure", "text", "number").agg(F.count("*").alias("c")), "profile-counts")
    middle = quantiles_of_counts(counts.where(F.col("measure").isin(*numbers) & F.col("number").isNotNull() & ~F.isnan("number")).select("e", "measure", F.col("number").alias("value"), "c"), ["e", "measure"], {"median": 0.5})
    usual = F.struct(-F.col("c"), F.col("text"))
    one = counts.groupBy("e").agg(
        F.sum(F.when(F.col("measure") == "rows", F.col("c"))).alias("offer_rows"),
        F.count_if((F.col("measure") == "room") & F.col("text").isNotNull()).alias("distinct_rooms"),
        *[F.min_by("text", F.when((F.col("measure") == c) & (F.col("text") != ""), usual)).alias(c) for c in texts],
    )
    medians_of = middle.groupBy("e").agg(*[F.max(F.when(F.col("measure") == c, F.col("median"))).alias(f"median_{c}") for c in numbers])
    return one.join(medians_of, "e", "left").withColumnRenamed("e", entity)


def distinct_options(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, option): a row for each distinct value of each column, as text; nulls are no options."""
    each = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("option")) for c in columns])
    return rows.select(*columns).distinct().select(F.inline(each)).where("option is not null").distinct()


def history_status(tables: Sequence[DataFrame], column: str, least: int = 2) -> DataFrame:
    """One row: distinct snapshots over all tables, and whether they make a history."""
    d = tables[0].select(column)
    for t in tables[1:]:
        d = d.unionByName(t.select(column))
    n = d.where(F.col(column).isNotNull()).distinct().agg(F.count("*").alias("snapshots"))
    return n.withColumn("status", F.when(F.col("snapshots") == 0, "missing").when(F.col("snapshots") < least, "low_history").otherwise("ready"))


def table_summary(offers: DataFrame) -> DataFrame:
    """One row of counts over the whole table; each distinct count in its own small aggregate."""

    def distinct(*cols: str | Column) -> Column:
        d = offers.select(*cols).dropna().distinct()
        return d.agg(F.count("*")).scalar()

    one = offers.agg(F.count("*").alias("rows"), F.min("checkin").alias("first_checkin"), F.max("checkin").alias("last_checkin"))
    return one.select("*", distinct("property_url").alias("properties"), distinct("property_url", "room_id").alias("property_rooms"), distinct("block_id").alias("blocks"))


def run_rollup(rows: DataFrame, run: str) -> DataFrame:
    """One row a run: its rows, its priced entities and snapshot bounds."""
    price = F.col("price_per_night")
    priced = rows.where((price > 0) & ~F.isnan(price)).select(run, "property_url").distinct().groupBy(run).agg(F.count("*").alias("priced_properties"))
    base = rows.groupBy(run).agg(F.count("*").alias("rows"), F.min("snapshot_date").alias("first_snapshot"), F.max("snapshot_date").alias("last_snapshot"))
    return base.join(priced, run, "left").withColumn("priced_properties", F.coalesce("priced_properties", F.lit(0).cast("long")))


def catalog(offers: DataFrame, order: str) -> DataFrame:
    """One row a property and name: first type by ``order``, rows."""
    return offers.groupBy("property_url", "property_name").agg(F.min_by("property_type", F.when(F.col("property_type").isNotNull(), F.col(order))).alias("property_type"), F.count("*").alias("rows"))


def nearest_to_median(rows: DataFrame, group: Sequence[str], value: str, tie: str) -> DataFrame:
    """The row of each group whose value lies nearest to the group's median; of equal ones the least ``tie``."""
    m = medians(rows, group, F.col(value), "median_").drop("n")
    near = rows.where(F.col(value).isNotNull() & ~F.isnan(value)).join(m, list(group)).withColumn("gap_", F.abs(F.col(value) - F.col("median_")))
    return keep_one(near, list(group), [F.col("gap_"), F.col(tie)]).drop("gap_", "median_")
