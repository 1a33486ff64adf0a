"""Prices over snapshots: presence derived from offers, peers' markets, aligned series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nightledger.operators.quantiles import medians
from nightledger.operators.relational import rank_descending

#: What names a market within a snapshot.
MARKET_KEY = ("snapshot_date", "lead_time_days", "stay_length_days", "currency", "market")


def presence_from_offers(offers: DataFrame, key: Sequence[str], order: str, carried: Sequence[str]) -> DataFrame:
    """One available record for each key that has an offer: its last capture, and the last known of each carried column.

    ``order`` numbers the rows; nulls are passed over; null keys are keys.
    """
    last = [F.max_by(c, F.when(F.col(c).isNotNull(), F.col(order))).alias(c) for c in carried]
    out = offers.groupBy(*key).agg(F.max("captured_at").alias("captured_at"), *last)
    return out.withColumns({"availability_status": F.lit("available"), "failure_reason": F.lit(None).cast("string")})


def with_market(rows: DataFrame, entity: str, price: str, key: Sequence[str] = MARKET_KEY) -> DataFrame:
    """Each row with the median price of its market and the number of prices in it, its gap and its rank from the top."""
    market = medians(rows, list(key), F.col(price), "market_median").withColumnRenamed("n", "market_prices")
    on = F.lit(True)
    for k in key:
        on = on & F.col(f"r.{k}").eqNullSafe(F.col(f"m.{k}"))
    d = rows.alias("r").join(market.alias("m"), on, "left").select("r.*", "m.market_median", "m.market_prices")
    gap = F.col(price) - F.col("market_median")
    d = d.withColumns({"market_gap": gap, "market_gap_share": F.try_divide(gap, F.col("market_median"))})
    return rank_descending(d, list(key), price, "price_rank")


def price_series(rows: DataFrame, entity: str, snapshot: str, price: Column) -> DataFrame:
    """(entity, snapshot, price): every entity at every snapshot of the table, with the median of its prices there or null.

    A row for each pair of an entity and a snapshot: the snapshots, one a delivery, are inlined into the entities' rows.
    """
    own = medians(rows, [entity, snapshot], price, "price").drop("n")
    every = rows.where(F.col(snapshot).isNotNull()).agg(F.sort_array(F.collect_set(snapshot))).scalar()
    grid = rows.where(F.col(entity).isNotNull()).select(entity).distinct().select(entity, F.explode(every).alias(snapshot))
    return grid.join(own, [entity, snapshot], "left")


def mean_series(series: DataFrame, snapshot: str) -> DataFrame:
    """(snapshot, mean, priced): the mean over entities of each snapshot, and how many have a price."""
    return series.groupBy(snapshot).agg(F.round(F.avg("price"), 4).alias("mean_price"), F.count("price").alias("priced"))


def timeline(rows: DataFrame, snapshot: str, subject: Column, price: str) -> DataFrame:
    """A row for each snapshot: the subject's and the others' median price, and how many others have one."""
    mine = medians(rows.where(subject), [snapshot], F.col(price), "subject_price").drop("n")
    peers = medians(rows.where(~subject), [snapshot], F.col(price), "peer_median").withColumnRenamed("n", "peer_prices")
    return rows.select(snapshot).where(F.col(snapshot).isNotNull()).distinct().join(mine, snapshot, "left").join(peers, snapshot, "left").withColumn("peer_prices", F.coalesce("peer_prices", F.lit(0)))
