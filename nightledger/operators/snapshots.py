"""What changed between consecutive full snapshots."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nightledger.functions.text import null_marked

#: Snapshot dates are one row each; above this many the dates are joined without a broadcast hint.
MAX_BROADCAST_SNAPSHOTS = 10_000


def consecutive_pairs(snapshots: DataFrame, column: str) -> DataFrame:
    """(later, earlier) for each two consecutive values of ``column``; null isn't a snapshot.

    The distinct values are counted on the driver: one per delivery, not per record.
    """
    spark = snapshots.sparkSession
    dates = snapshots.select(F.col(column).alias("later")).where(F.col(column).isNotNull()).distinct()
    known = [r[0] for r in dates.limit(MAX_BROADCAST_SNAPSHOTS + 1).collect()]
    kind = snapshots.schema[column].dataType.simpleString()
    if len(known) <= MAX_BROADCAST_SNAPSHOTS:
        known.sort()
        pairs = spark.createDataFrame(list(zip(known[1:], known[:-1])), f"later {kind}, earlier {kind}")
        return F.broadcast(pairs)
    from pyspark.sql import Window

    return dates.withColumn("earlier", F.lag("later").over(Window.orderBy("later"))).where("earlier is not null")


def snapshot_changes(
    records: DataFrame,
    snapshot: str,
    key: Sequence[str],
    compared: Sequence[str],
    delivered: DataFrame | None = None,
) -> DataFrame:
    """Added, removed and changed records of each two consecutive snapshots.

    ``records`` holds one row per snapshot and key. Rows of a snapshot meet those of the snapshot
    before it in a full outer join on the key; a missing side is an addition or a removal, and two
    rows whose hashes of the ``compared`` columns differ are a change. The equi-join runs on a 64-bit
    hash of (snapshot, key); the columns themselves are then compared null-safe, so that a clash of
    hashes can't merge two keys. Null is a value of its own in keys and compared columns alike.

    ``delivered`` is a plainer table with the same snapshots, to list them from without making the records.

    Defined results: an empty table or a single snapshot gives no rows; rows whose snapshot is null
    belong to no snapshot; further columns of ``records`` are ignored, also those named like ours.
    Columns: ``snapshot`` (the later one), the key, ``change``.
    """
    pairs = consecutive_pairs(records if delivered is None else delivered, snapshot)
    names = [f"k{i}" for i in range(len(key))]
    flat = records.select(
        F.col(snapshot).alias("at"),
        *[F.col(c).alias(n) for c, n in zip(key, names)],
        F.xxhash64(*null_marked(*compared)).alias("row_hash"),
    )

    def side(mark: str, column: str) -> DataFrame:
        # the pairs pick the snapshots, not a filter: a filter would sink below the aggregate that
        # made the records and keep the two sides from sharing its shuffle
        d = flat.join(pairs, F.col("at") == F.col(column), "inner")
        d = d.withColumn("id", F.xxhash64(F.col("later"), *null_marked(*names)))
        return d.select(*[F.col(c).alias(f"{mark}_{c}") for c in ("later", "id", "row_hash", *names)])

    new, old = side("n", "later"), side("o", "earlier")
    # counted rather than joined by "and": the planner would sort and hash by every one of them
    alike = sum((F.col(f"n_{n}").eqNullSafe(F.col(f"o_{n}")).cast("int") for n in names), F.lit(0))
    on = (F.col("n_id") == F.col("o_id")) & (F.col("n_later") == F.col("o_later")) & (alike == len(names))
    change = (
        F.when(F.col("o_id").isNull(), "added")
        .when(F.col("n_id").isNull(), "removed")
        .when(F.col("n_row_hash") != F.col("o_row_hash"), "changed")
    )
    return (
        new.join(old, on, "full_outer")
        .withColumn("change", change)
        .where(F.col("change").isNotNull())
        .select(
            F.coalesce("n_later", "o_later").alias(snapshot),
            *[F.when(F.col("n_id").isNotNull(), F.col(f"n_{n}")).otherwise(F.col(f"o_{n}")).alias(c) for c, n in zip(key, names)],
            "change",
        )
    )


# The eight that name a property and search window within a snapshot.
WINDOW_KEY = ("property_url", "lead_time_days", "stay_length_days", "adults", "children", "rooms", "currency", "market")


def presence_records(presence: DataFrame, offers: DataFrame) -> DataFrame:
    """One record per snapshot, property and search window of ``offer_presence``, with its lowest price.

    Of several rows the one with the greatest ``presence_id`` counts; its status is given as a hash
    (null for null), since statuses are only compared. Both tables go through one aggregation on their
    common key, null keys included, so that the price needs no join of its own; all that it keeps is of
    fixed width, so it combines by hash before the shuffle, without sorting.
    """
    from nightledger.functions.text import canonical_url

    key = [canonical_url("property_url").alias("property_url"), *WINDOW_KEY[1:]]
    status = F.lower(F.trim(F.regexp_replace("availability_status", r"(?U)^\s+|\s+$", "")))
    none = F.lit(None)
    seen = presence.select("snapshot_date", *key, F.col("presence_id"), F.when(status.isNotNull(), F.xxhash64(status)).alias("status"), none.cast("double").alias("price"))
    price = F.col("price_per_night")
    priced = offers.where((price > 0) & ~F.isnan(price)).select("snapshot_date", *key, none.cast("long").alias("presence_id"), none.cast("long").alias("status"), price.alias("price"))
    return (
        seen.unionByName(priced)
        .groupBy("snapshot_date", *WINDOW_KEY)
        .agg(F.max("presence_id").alias("last"), F.max_by("status", "presence_id").alias("status_hash"), F.min("price").alias("price"))
        .where(F.col("last").isNotNull())
        .select("snapshot_date", *WINDOW_KEY, "status_hash", "price")
    )
