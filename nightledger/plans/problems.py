"""Queries of the core problems: places near each other, changes between snapshots."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nightledger.functions.text import canonical_url
from nightledger.operators.snapshots import WINDOW_KEY, presence_records, snapshot_changes
from nightledger.operators.spatial import near_pairs
from nightledger.sources.tables import table

NEAR_KM = 0.25


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    offers = table(spark, folder, "price_observations")
    places = offers.select(canonical_url("property_url").alias("property_url"), "latitude", "longitude")
    return near_pairs(places, "property_url", "latitude", "longitude", NEAR_KM).toDF("property_url_a", "property_url_b")


P2_SQL = """
with places as (
  select distinct split_part(split_part(property_url, '?', 1), '#', 1) as u, latitude as la, longitude as lo
  from price_observations
  where latitude is not null and longitude is not null and not isnan(latitude) and not isnan(longitude)
    and latitude between -90 and 90 and longitude between -180 and 180 and not (latitude = 0 and longitude = 0)
)
select distinct a.u as property_url_a, b.u as property_url_b
from places a join places b on a.u < b.u and b.la between a.la - 0.0023 and a.la + 0.0023
where 2 * 6371.0088 * asin(sqrt(least(1.0, pow(sin(radians(b.la - a.la) / 2), 2)
      + cos(radians(a.la)) * cos(radians(b.la)) * pow(sin(radians(b.lo - a.lo) / 2), 2)))) <= 0.25
"""


def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    presence = table(spark, folder, "offer_presence")
    records = presence_records(presence, table(spark, folder, "price_observations"))
    changes = snapshot_changes(records, "snapshot_date", WINDOW_KEY, ("status_hash", "price"), presence)
    return changes.withColumn("snapshot_date", F.date_format("snapshot_date", "yyyy-MM-dd"))


P5_SQL = """
with seen as (
  select snapshot_date, split_part(split_part(property_url, '?', 1), '#', 1) as property_url, lead_time_days,
    stay_length_days, adults, children, rooms, currency, market, lower(trim(availability_status)) as status,
    row_number() over (partition by snapshot_date, split_part(split_part(property_url, '?', 1), '#', 1), lead_time_days,
      stay_length_days, adults, children, rooms, currency, market order by presence_id desc) as rn
  from offer_presence
), prices as (
  select snapshot_date, split_part(split_part(property_url, '?', 1), '#', 1) as property_url, lead_time_days,
    stay_length_days, adults, children, rooms, currency, market, min(price_per_night) as price
  from price_observations where price_per_night > 0 and not isnan(price_per_night) group by all
), days as (
  select snapshot_date, row_number() over (order by snapshot_date) as o from (select distinct snapshot_date from offer_presence)
), rec as (
  select d.o, s.*, p.price from seen s join days d using (snapshot_date)
  left join prices p on s.snapshot_date = p.snapshot_date and s.property_url = p.property_url
    and s.lead_time_days is not distinct from p.lead_time_days and s.stay_length_days is not distinct from p.stay_length_days
    and s.adults = p.adults and s.children = p.children and s.rooms = p.rooms and s.currency = p.currency and s.market = p.market
  where s.rn = 1
), both_sides as (
  select coalesce(n.o, b.o + 1) as o, coalesce(n.property_url, b.property_url) as property_url,
    coalesce(n.lead_time_days, b.lead_time_days) as lead_time_days, coalesce(n.stay_length_days, b.stay_length_days) as stay_length_days,
    coalesce(n.adults, b.adults) as adults, coalesce(n.children, b.children) as children, coalesce(n.rooms, b.rooms) as rooms,
    coalesce(n.currency, b.currency) as currency, coalesce(n.market, b.market) as market,
    case when b.o is null then 'added' when n.o is null then 'removed'
      when n.status is distinct from b.status or n.price is distinct from b.price then 'changed' end as change
  from rec n full outer join rec b on n.o = b.o + 1 and n.property_url = b.property_url
    and n.lead_time_days is not distinct from b.lead_time_days and n.stay_length_days is not distinct from b.stay_length_days
    and n.adults = b.adults and n.children = b.children and n.rooms = b.rooms and n.currency = b.currency and n.market = b.market
)
select strftime(d.snapshot_date, '%Y-%m-%d') as snapshot_date, property_url, lead_time_days, stay_length_days, adults, children,
  rooms, currency, market, change
from both_sides join days d using (o) where change is not null and o > 1
"""

QUERIES = {"p2_found": p2_found, "p5_found": p5_found}
SQL = {"p2_found": P2_SQL, "p5_found": P5_SQL}
