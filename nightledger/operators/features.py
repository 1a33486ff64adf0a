"""The wide offer table: offers joined with room and property features, and history rows shaped from it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nightledger.functions import offers as fo
from nightledger.functions.text import canonical_url
from nightledger.operators.relational import fill_from_first, keep_one, reconcile
from nightledger.operators.spatial import haversine_km, usable

# Offers without these take the usual search's values.
SEARCH_DEFAULTS = {"adults": 2, "children": 0, "rooms": 1, "currency": "EUR"}


def last_wins(features: DataFrame, key: Sequence[str], order: str) -> DataFrame:
    """One row of features a key: the last by ``order``; rows without a key give none."""
    whole = F.lit(True)
    for k in key:
        whole = whole & F.col(k).isNotNull()
    return keep_one(features.where(whole), key, [F.col(order)], last=True).drop(order)


def wide_offers(offers: DataFrame, rooms: DataFrame, properties: DataFrame, inventory: DataFrame, order: str) -> DataFrame:
    """One row an offer, with calendar, meal plan and cancellation, its room's and its property's features.

    Missing room ids are first looked up by property and room name in the inventory. Where a column stands
    in more than one table, the property's value goes before the room's and the room's before the offer's,
    apart from the identity columns. ``order`` numbers the rows of every input.
    """
    d = reconcile(offers, inventory, ["property_url", "room_name"], "room_id", order, "room_id_reconciled")
    label, rank = fo.meal_plan("conditions_text")
    free, fixed, flexibility = fo.cancellation("conditions_text")
    d = d.withColumns({"meal_plan": label, "meal_plan_ordinal": rank, "free_cancellation": free, "non_refundable": fixed, "cancellation_flexibility_ordinal": flexibility, **fo.calendar(F.col("checkin").cast("string").try_cast("date"))})
    identity = {"property_url", "property_name", "room_id", "room_name", order}
    for side, key in ((rooms, ["property_url", "room_id"]), (properties, ["property_url"])):
        f = last_wins(side, key, order)
        extra = [c for c in f.columns if c not in identity]
        f = f.select(*key, *[F.col(c).alias(f"new_{c}") for c in extra])
        d = d.join(f, key, "left")
        d = d.withColumns({c: F.coalesce(f"new_{c}", c) if c in d.columns else F.col(f"new_{c}") for c in extra}).drop(*[f"new_{c}" for c in extra])
    return d


def snapshot_of(run_date: str, captured_at: str, run_id: str) -> Column:
    """The run's own date, else the day of capture, else the first eight digits of the run id."""
    return F.coalesce(F.col(run_date).cast("date"), F.col(captured_at).cast("date"), F.try_to_timestamp(F.substring(run_id, 1, 8), F.lit("yyyyMMdd")).cast("date"))


def history_offers(wide: DataFrame, order: str, market: str) -> DataFrame:
    """Offers shaped for the history: names, types and places filled from the property's first known ones."""
    d = fill_from_first(wide, "property_url", order, ["property_name", "property_type", "latitude", "longitude"])
    defaults = {c: F.coalesce(F.col(c), F.lit(v)) if c in d.columns else F.lit(v) for c, v in SEARCH_DEFAULTS.items()}
    return d.withColumns({"property_type": F.coalesce("property_type", F.lit("Unknown")), "market": F.lit(market), **defaults})


def presence_of(offers: DataFrame, failures: DataFrame, key: Sequence[str]) -> DataFrame:
    """One row a property and window that was searched: offered, empty, or failed; the best of these counts.

    Windows that weren't searched have no row.
    """
    seen = offers.select(*key, F.lit("available").alias("availability_status"), F.lit(None).cast("string").alias("failure_reason"))
    status = F.when(F.col("category") == "empty_availability", "no_available_offer").otherwise("scrape_failed")
    failed = failures.where(F.col("stage") == "price_rows").select(*key, status.alias("availability_status"), F.col("category").alias("failure_reason"))
    rank = F.array_position(F.array(*map(F.lit, fo.STATUS_PRIORITY)), F.col("availability_status"))
    return keep_one(seen.unionByName(failed), key, [rank, F.col("failure_reason")])


def place_distances(rows: DataFrame, lat: str, lon: str, anchors: dict[str, Sequence[tuple[float, float]]], poi: dict[str, str] | None = None) -> DataFrame:
    """``<name>_km``: the distance to the nearest of each kind's fixed anchors or, if nearer, of the row's own points.

    ``poi`` names the kind's word in the categories of ``nearby_poi``, an array of structs with ``category``,
    ``distance`` and ``unit`` (m or km). Without usable coordinates only the row's own points count.
    """
    out = {}
    ok = usable(F.col(lat), F.col(lon))
    for name, places in anchors.items():
        km: list[Column] = [F.when(ok, haversine_km(F.lit(a), F.lit(b), F.col(lat), F.col(lon))) for a, b in places]
        if poi and name in poi:
            km.append(nearest_poi("nearby_poi", poi[name]))
        out[f"{name}_km"] = F.least(*km) if len(km) > 1 else km[0]
    return rows.withColumns(out)


def nearest_poi(column: str, word: str) -> Column:
    """Kilometres to the nearest point of interest whose category holds the word; null if none does."""
    near = F.filter(column, lambda p: F.contains(F.lower(p["category"]), F.lit(word.lower())) & p["distance"].isNotNull())
    return F.array_min(F.transform(near, lambda p: F.when(F.lower(p["unit"]) == "m", p["distance"] / 1000).otherwise(p["distance"])))


def covariates_for(rows: DataFrame, covariates: DataFrame, order: str) -> DataFrame:
    """Each row with the last covariates of its checkin and market, or nulls."""
    last = last_wins(covariates, ["checkin", "market"], order)
    extra = [c for c in last.columns if c not in ("checkin", "market")]
    return rows.join(last.select("checkin", "market", *[F.col(c).alias(f"cov_{c}") for c in extra]), ["checkin", "market"], "left")


def candidates(found: DataFrame, known: DataFrame, url: str, order: str) -> DataFrame:
    """New listings: the first of each canonical address that isn't known yet."""
    c = canonical_url(url)
    fresh = keep_one(found.withColumn(url, c).where(F.col(url).isNotNull()), [url], [F.col(order)])
    return fresh.join(known.select(c.alias(url)).where(F.col(url).isNotNull()).distinct(), url, "left_anti")
