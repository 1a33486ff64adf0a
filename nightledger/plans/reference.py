"""Queries of the relational layer: scans, joins, aggregates, windows and scalar functions over the test tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nightledger.functions import offers as fo
from nightledger.functions.text import canonical_url, finite, value_set
from nightledger.operators import models, quantiles, relational, summaries, validation
from nightledger.operators.spatial import haversine_km, near_pairs, usable
from nightledger.session import store
from nightledger.sources.tables import table
from nightledger.streaming.history import run_once, windowed_counts

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

_URL = "split_part(split_part(property_url, '?', 1), '#', 1)"
_PRICE = "case when price_per_night > 0 and not isnan(price_per_night) then price_per_night end"
_WINDOW = ["property_url", "lead_time_days", "stay_length_days", "adults", "children", "rooms", "currency", "market"]


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def _offers(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "price_observations")


def _presence(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "offer_presence")


def _day(c: str):
    return F.date_format(c, "yyyy-MM-dd").alias(c)


# --- filters, set operations, projections


@query("select trim(property_type) as property_type, count(*) as n from price_observations where trim(property_type) in ('Apartment', 'Aparthotel', 'Holiday home', 'Villa') group by 1")
def flt01_segment(spark, folder):
    d = _offers(spark, folder).where(fo.in_segment("property_type"))
    return d.groupBy(F.trim("property_type").alias("property_type")).agg(F.count("*").alias("n"))


_WINDOWS = [{"lead_time_days": 7, "stay_length_days": 4}, {"lead_time_days": 30, "currency": "USD"}, {"adults": 4, "children": None}]


@query("select market, count(*) as n from price_observations where (lead_time_days = 7 and stay_length_days = 4) or (lead_time_days = 30 and currency = 'USD') or adults = 4 group by 1")
def flt03_windows(spark, folder):
    d = _offers(spark, folder)
    return d.where(relational.in_windows(_WINDOWS, d.columns)).groupBy("market").agg(F.count("*").alias("n"))


@query("select count(*) as n from price_observations where trim(coalesce(room_id, '')) = '' or trim(coalesce(room_name, '')) = '' or trim(coalesce(block_id, '')) = ''")
def flt06_blank_identity(spark, folder):
    bad = validation.blank("room_id") | validation.blank("room_name") | validation.blank("block_id")
    return _offers(spark, folder).where(bad).agg(F.count("*").alias("n"))


@query("select market, count(*) as n from offer_presence where snapshot_date = (select max(snapshot_date) from offer_presence) group by 1")
def flt08_latest_snapshot(spark, folder):
    return relational.latest(_presence(spark, folder), "snapshot_date").groupBy("market").agg(F.count("*").alias("n"))


@query(f"select src, count(*) as n, count(distinct u) as properties from (select 'o' as src, {_URL} as u from price_observations union all select 'p', {_URL} from offer_presence) group by 1")
def set01_union_by_name(spark, folder):
    o = _offers(spark, folder).withColumn("src", F.lit("o"))
    both = o.unionByName(_presence(spark, folder).withColumn("src", F.lit("p")), allowMissingColumns=True)
    return both.groupBy("src").agg(F.count("*").alias("n"), F.count_distinct(canonical_url("property_url")).alias("properties"))


@query("select distinct strftime(checkin, '%Y-%m-%d') as checkin, lead_time_days, stay_length_days from price_observations")
def set02_distinct_contexts(spark, folder):
    return _offers(spark, folder).select(_day("checkin"), "lead_time_days", "stay_length_days").distinct()


@query("select event_type, json_extract_string(props, '$.k')::bigint as k, count(*) as n from events group by 1, 2")
def sca25_json_field(spark, folder):
    k = F.get_json_object("props", "$.k").cast("long").alias("k")
    return table(spark, folder, "events").groupBy("event_type", k).agg(F.count("*").alias("n"))


# --- scalar functions


@query(f"select distinct property_url, {_URL} as canonical from price_observations")
def sca12_canonical_url(spark, folder):
    return _offers(spark, folder).select("property_url", canonical_url("property_url").alias("canonical")).distinct()


@query(
    """select observation_id, case when isnan(price_per_night) then null else round(price_per_night, 2) end as us_style,
    case when isnan(price_per_night) then null else round(price_per_night, 2) end as eu_style from price_observations"""
)
def sca02_price_text(spark, folder):
    d = _offers(spark, folder).select("observation_id", F.format_number(finite("price_per_night"), 2).alias("us"))
    us, eu = F.concat(F.lit("EUR "), F.col("us")), F.concat(F.translate("us", ",.", ".,"), F.lit(" €"))
    return d.select("observation_id", fo.parse_price(us).alias("us_style"), fo.parse_price(eu).alias("eu_style"))


# price texts and what they say; null where they are no price
_PRICE_TEXTS = {
    "EUR 1,095": 1095.0, "EUR 919": 919.0, "EUR 1,095.50": 1095.5, "EUR 1.095,50": 1095.5, "EUR 2.800": 2800.0, "": None, "Price unavailable": None, "1,2,3": None, "1.095,5,0": None,
    "1.2.3": None, "12,5": 12.5, "12.5": 12.5, "-1.234,5": -1234.5, "1,234,567": 1234567.0, "5-": None, "-": None, ",5": 0.5, "1,234,56": None, "€ 1 095": 1095.0,
}


@query("select * from (values " + ", ".join(f"('{t}', {'null' if v is None else v}::double)" for t, v in _PRICE_TEXTS.items()) + ") x(text, price)")
def sca02_price_literals(spark, folder):
    return spark.createDataFrame([(t,) for t in _PRICE_TEXTS], "text string").select("text", fo.parse_price("text").alias("price"))


@query(
    """select observation_id, case when stay_length_days > 0 then round(current_price_value / stay_length_days, 2) end as nightly
    from price_observations where not isnan(current_price_value)"""
)
def sca03_nightly(spark, folder):
    d = _offers(spark, folder).where(F.col("current_price_value").isNotNull() & ~F.isnan("current_price_value"))
    return d.select("observation_id", fo.nightly("current_price_value", "stay_length_days").alias("nightly"))


@query("select block_id, nullif(regexp_extract(block_id, '^([0-9]+)_', 1), '') as room, count(*) as n from price_observations group by 1, 2")
def sca04_room_of_block(spark, folder):
    return _offers(spark, folder).groupBy("block_id", fo.room_of_block("block_id").alias("room")).agg(F.count("*").alias("n"))


@query("select distinct room_name, regexp_replace(regexp_replace(lower(room_name), '[^a-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g') as slug from price_observations")
def sca05_slug(spark, folder):
    return _offers(spark, folder).select("room_name", fo.slug("room_name").alias("slug")).distinct()


@query(
    """select distinct strftime(checkin, '%Y-%m-%d') as checkin, month(checkin)::int as checkin_month, weekofyear(checkin)::int as checkin_iso_week,
    (isodow(checkin) - 1)::int as checkin_day_of_week, isodow(checkin) >= 6 as checkin_is_weekend,
    case when month(checkin) in (7, 8) then 'peak' when month(checkin) in (5, 6, 9, 10) then 'shoulder' else 'off' end as season from price_observations"""
)
def sca14_calendar(spark, folder):
    d = _offers(spark, folder).select("checkin").distinct()
    return d.select(_day("checkin"), *[c.alias(n) for n, c in fo.calendar("checkin").items()])


@query(
    """select distinct strftime(snapshot_date, '%Y-%m-%d') as snapshot_date, lead_time_days, stay_length_days,
    strftime(snapshot_date + lead_time_days::int, '%Y-%m-%d') as arrive, strftime(snapshot_date + lead_time_days::int + stay_length_days::int, '%Y-%m-%d') as leave
    from price_observations"""
)
def sca15_stay_dates(spark, folder):
    arrive, leave = fo.stay("snapshot_date", "lead_time_days", "stay_length_days")
    d = _offers(spark, folder).select("snapshot_date", "lead_time_days", "stay_length_days").distinct()
    return d.select(_day("snapshot_date"), "lead_time_days", "stay_length_days", F.date_format(arrive, "yyyy-MM-dd").alias("arrive"), F.date_format(leave, "yyyy-MM-dd").alias("leave"))


_ANCHORS = {"harbour": (35.515, 24.018), "airport": (35.54, 24.15)}
_HAV = "round(2 * 6371.0088 * asin(sqrt(least(1.0, pow(sin(radians(latitude - {la}) / 2), 2) + cos(radians({la})) * cos(radians(latitude)) * pow(sin(radians(longitude - {lo}) / 2), 2)))), 6)"
_USABLE = "latitude is not null and longitude is not null and not isnan(latitude) and not isnan(longitude) and abs(latitude) <= 90 and abs(longitude) <= 180 and not (latitude = 0 and longitude = 0)"


@query(
    f"select spec_id, {_HAV.format(la=35.515, lo=24.018)} as harbour_km, {_HAV.format(la=35.54, lo=24.15)} as airport_km, "
    f"least({_HAV.format(la=35.515, lo=24.018)}, {_HAV.format(la=35.54, lo=24.15)}) as nearest_km from client_specs where {_USABLE}"
)
def join10_nearest_anchor(spark, folder):
    d = table(spark, folder, "client_specs").where(usable(F.col("latitude"), F.col("longitude")))
    km = {f"{n}_km": F.round(haversine_km(F.lit(la), F.lit(lo), F.col("latitude"), F.col("longitude")), 6) for n, (la, lo) in _ANCHORS.items()}
    return d.select("spec_id", *[c.alias(n) for n, c in km.items()], F.least(*km.values()).alias("nearest_km"))


_TOKENS_SQL = r"""tok as (select spec_id, list_sort(list_distinct(list_filter(list_transform(list_filter(list_concat(coalesce(amenities, []), coalesce(property_facilities, [])), lambda v: v is not null),
  lambda v: lower(trim(regexp_replace(v, '[\s\p{Z}]+', ' ', 'g')))), lambda v: v <> ''))) as tokens from client_specs)"""


@query(
    f"with {_TOKENS_SQL} select spec_id, "
    + ", ".join(f"(len(list_filter(tokens, lambda t: {' or '.join(f"regexp_matches(t, '{chr(92)}b{p}{chr(92)}b')" for p in ps)})) > 0)::int as hq__{n}" for n, ps in fo.QUALITY_PHRASES.items())
    + " from tok"
)
def sca11_quality_flags(spark, folder):
    flags = fo.quality_flags(value_set("amenities", "property_facilities"))
    return table(spark, folder, "client_specs").select("spec_id", *[c.alias(n) for n, c in flags.items()])


_VOCABULARY = ["free wifi", "balcony", "swimming pool", "lift"]


@query(f"with {_TOKENS_SQL} select spec_id, " + ", ".join(f"list_contains(tokens, '{t}')::int as has_{t.replace(' ', '_')}" for t in _VOCABULARY) + " from tok")
def sca21_multi_hot(spark, folder):
    hot = fo.multi_hot(value_set("amenities", "property_facilities"), _VOCABULARY, "has_")
    return table(spark, folder, "client_specs").select("spec_id", *[c.alias(n) for n, c in hot.items()])


@query(
    """select doc_id, case when contains(t, 'all inclusive') or contains(t, 'all-inclusive') then 'all_inclusive' when contains(t, 'full board') then 'full_board'
    when contains(t, 'half board') then 'half_board' when contains(t, 'breakfast') then 'breakfast' else 'room_only' end as meal_plan,
    contains(t, 'free cancellation') as free_cancellation, contains(t, 'non-refundable') or contains(t, 'non refundable') as non_refundable
    from (select doc_id, lower(coalesce(text, '')) as t from documents)"""
)
def sca09_conditions(spark, folder):
    label, _ = fo.meal_plan("text")
    free, fixed, _ = fo.cancellation("text")
    return table(spark, folder, "documents").select("doc_id", label.alias("meal_plan"), free.alias("free_cancellation"), fixed.alias("non_refundable"))


# --- aggregates


@query("select coalesce(nullif(trim(property_type), ''), '(missing)') as label, count(*) as n from price_observations group by 1")
def agg08_type_counts(spark, folder):
    return summaries.type_counts(_offers(spark, folder), "property_type")


_DIST = "round(quantile_cont(v, 0.1), 6) as p10, round(quantile_cont(v, 0.25), 6) as p25, round(quantile_cont(v, 0.5), 6) as p50, round(quantile_cont(v, 0.75), 6) as p75, round(quantile_cont(v, 0.9), 6) as p90"


def _rounded(d: DataFrame) -> DataFrame:
    return d.select(*[F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in d.dtypes])


@query(f"select market, count(*) as n, min(v) as least, round(avg(v), 6) as mean, max(v) as greatest, {_DIST} from (select market, {_PRICE} as v from price_observations) where v is not null group by 1")
def agg05_price_distribution(spark, folder):
    d = _offers(spark, folder)
    return _rounded(quantiles.distribution(d, ["market"], fo.valid_price("price_per_night")))


@query(f"select trim(property_type) as property_type, count(*) as n, min(v) as least, round(avg(v), 6) as mean, max(v) as greatest, {_DIST} from (select property_type, lead_time_days::double as v from price_observations) where v is not null group by 1")
def agg06_lead_distribution(spark, folder):
    d = _offers(spark, folder).withColumn("property_type", F.trim("property_type"))
    return _rounded(quantiles.distribution(d, ["property_type"], F.col("lead_time_days")))


@query(
    f"""select u as property_url, v as property_name from (
      select u, v, row_number() over (partition by u order by n desc, v) as r from (
        select {_URL} as u, trim(property_name) as v, count(*) as n from price_observations where trim(property_name) <> '' group by 1, 2)) where r = 1"""
)
def agg02_mode(spark, folder):
    d = _offers(spark, folder).withColumn("property_url", canonical_url("property_url"))
    return summaries.modes(d, ["property_url"], "property_name", "property_name")


@query(f"with p as (select market, {_PRICE} as v from price_observations), m as (select market, quantile_cont(v, 0.5) as ref from p where v is not null group by 1) select p.market, round(100.0 * sum((v <= ref)::int) / count(*), 2) as position from p join m using (market) where v is not null group by 1")
def agg07_percentile_position(spark, folder):
    d = _offers(spark, folder).where(F.col("price_per_night") > 0)
    price = fo.valid_price("price_per_night")
    return quantiles.percentile_position(d, ["market"], price, quantiles.medians(d, ["market"], price, "ref"), "ref")


_MISSING = ["room_id", "property_name", "lead_time_days", "price_per_night", "latitude"]


@query(" union all ".join(f"select '{c}' as column, round(avg(({c} is null{f' or isnan({c})' if c in ('price_per_night', 'latitude') else ''})::int), 4) as missing from price_observations" for c in _MISSING))
def agg09_missing_share(spark, folder):
    return summaries.missing_shares(_offers(spark, folder).select(*_MISSING))


@query(
    """select count(*) as rows, strftime(min(checkin), '%Y-%m-%d') as first_checkin, strftime(max(checkin), '%Y-%m-%d') as last_checkin, count(distinct property_url) as properties,
    count(distinct (property_url, room_id)) filter (where room_id is not null) as property_rooms, count(distinct block_id) as blocks from price_observations"""
)
def agg11_table_summary(spark, folder):
    d = summaries.table_summary(_offers(spark, folder))
    return d.withColumns({c: F.date_format(c, "yyyy-MM-dd") for c in ("first_checkin", "last_checkin")})


@query(
    f"""with o as (select *, {_URL} as u from price_observations),
    mode_of as (select u, max(case when r1 = 1 then property_name end) as property_name from (
      select u, trim(property_name) as property_name, row_number() over (partition by u order by count(*) desc, trim(property_name)) as r1 from o where trim(property_name) <> '' group by u, trim(property_name)) group by 1),
    type_of as (select u, max(case when r1 = 1 then property_type end) as property_type from (
      select u, trim(property_type) as property_type, row_number() over (partition by u order by count(*) desc, trim(property_type)) as r1 from o where trim(property_type) <> '' group by u, trim(property_type)) group by 1)
    select o.u as property_url, count(*) as offer_rows, count(distinct room_id) as distinct_rooms, any_value(m.property_name) as property_name, any_value(t.property_type) as property_type,
      round(quantile_cont(case when not isnan(latitude) then latitude end, 0.5), 6) as median_latitude, round(quantile_cont(case when not isnan(longitude) then longitude end, 0.5), 6) as median_longitude,
      round(quantile_cont(case when not isnan(price_per_night) then price_per_night end, 0.5), 6) as median_price_per_night
    from o left join mode_of m on m.u = o.u left join type_of t on t.u = o.u group by o.u"""
)
def agg01_profiles(spark, folder):
    d = _offers(spark, folder).withColumn("property_url", canonical_url("property_url"))
    return _rounded(summaries.profiles(d, "property_url"))


@query(f"select strftime(snapshot_date, '%Y-%m-%d') as snapshot_date, market, lead_time_days, stay_length_days, count(*) as n, round(quantile_cont(v, 0.5), 6) as median from (select *, {_PRICE} as v from price_observations) where v is not null group by all")
def agg12_snapshot_prices(spark, folder):
    d = _offers(spark, folder)
    out = quantiles.medians(d, ["snapshot_date", "market", "lead_time_days", "stay_length_days"], fo.valid_price("price_per_night"))
    return _rounded(out.withColumn("snapshot_date", F.date_format("snapshot_date", "yyyy-MM-dd")))


@query(
    f"""with p as (select snapshot_date, market, {_URL} as u, quantile_cont(v, 0.5) as m from (select *, {_PRICE} as v from price_observations) where v is not null group by all)
    select strftime(snapshot_date, '%Y-%m-%d') as snapshot_date, market, count(*) as n, round(quantile_cont(m, 0.5), 6) as market_median from p group by all"""
)
def agg14_market_of_properties(spark, folder):
    """Each property counts once: the median of the properties' medians."""
    d = _offers(spark, folder).withColumn("property_url", canonical_url("property_url"))
    own = quantiles.medians(d, ["snapshot_date", "market", "property_url"], fo.valid_price("price_per_night"), "own")
    out = quantiles.medians(own, ["snapshot_date", "market"], F.col("own"), "market_median")
    return _rounded(out.withColumn("snapshot_date", F.date_format("snapshot_date", "yyyy-MM-dd")))


@query("select count(*) as snapshots, case when count(*) = 0 then 'missing' when count(*) < 2 then 'low_history' else 'ready' end as status from (select snapshot_date from price_observations union select snapshot_date from offer_presence)")
def agg15_history_status(spark, folder):
    return summaries.history_status([_offers(spark, folder), _presence(spark, folder)], "snapshot_date")


@query("select property_url, property_name, arg_min(property_type, observation_id) as property_type, count(*) as rows from price_observations group by 1, 2")
def agg16_catalog(spark, folder):
    return summaries.catalog(_offers(spark, folder), "observation_id")


@query(" union all ".join(f"select distinct '{c}' as column, {c}::varchar as option from price_observations where {c} is not null" for c in ("lead_time_days", "stay_length_days", "adults")))
def agg18_options(spark, folder):
    return summaries.distinct_options(_offers(spark, folder), ["lead_time_days", "stay_length_days", "adults"])


@query(
    """select run_id, count(*) as rows, strftime(min(snapshot_date), '%Y-%m-%d') as first_snapshot, strftime(max(snapshot_date), '%Y-%m-%d') as last_snapshot,
    count(distinct property_url) filter (where price_per_night > 0 and not isnan(price_per_night)) as priced_properties from price_observations group by 1"""
)
def agg21_run_rollup(spark, folder):
    d = summaries.run_rollup(_offers(spark, folder), "run_id")
    return d.withColumns({c: F.date_format(c, "yyyy-MM-dd") for c in ("first_snapshot", "last_snapshot")})


@query(f"with {_TOKENS_SQL} select token, count(*) as n from (select unnest(tokens) as token from tok) group by 1 having count(*) >= 25")
def agg23_vocabulary(spark, folder):
    d = table(spark, folder, "client_specs").select(F.explode(value_set("amenities", "property_facilities")).alias("token"))
    return d.groupBy("token").agg(F.count("*").alias("n")).where("n >= 25")


@query(
    f"""with o as (select *, {_URL} as u, {_PRICE} as v from price_observations), m as (select u, quantile_cont(v, 0.5) as md from o where v is not null group by 1)
    select u as property_url, observation_id from (select o.u, observation_id, row_number() over (partition by o.u order by abs(v - md), observation_id) as r from o join m on m.u = o.u where v is not null) where r = 1"""
)
def win05_nearest_to_median(spark, folder):
    d = _offers(spark, folder).select(canonical_url("property_url").alias("property_url"), "observation_id", fo.valid_price("price_per_night").alias("price"))
    return summaries.nearest_to_median(d, ["property_url"], "price", "observation_id").select("property_url", "observation_id")


# --- deduplication, history, numbering


_STORAGE_KEY = ["snapshot_date", "property_url", "checkin", "checkout", "adults", "children", "rooms", "currency", "market", "room_id", "block_id"]


@query(f"select max(observation_id) as observation_id from price_observations group by {', '.join(_STORAGE_KEY)}")
def win04_keep_last(spark, folder):
    d = _offers(spark, folder).select("observation_id", *_STORAGE_KEY)
    return relational.keep_one(d, _STORAGE_KEY, [F.col("observation_id")], last=True).select("observation_id")


_PRIORITY = "case lower(trim(availability_status)) when 'available' then 0 when 'no_available_offer' then 1 when 'scrape_failed' then 2 else 3 end"


@query(f"select presence_id from (select presence_id, row_number() over (partition by snapshot_date, {_URL}, {', '.join(_WINDOW[1:])} order by {_PRIORITY}, presence_id) as r from offer_presence) where r = 1")
def win03_priority(spark, folder):
    s = fo.clean_status("availability_status")
    rank = F.when(s == "available", 0).when(s == "no_available_offer", 1).when(s == "scrape_failed", 2).otherwise(3)
    d = _presence(spark, folder).select("presence_id", "snapshot_date", canonical_url("property_url").alias("property_url"), *_WINDOW[1:], rank.alias("priority"))
    return relational.keep_one(d, ["snapshot_date", *_WINDOW], [F.col("priority"), F.col("presence_id")]).select("presence_id")


_HISTORY = f"""h as (select snapshot_date, {_URL} as u, {', '.join(_WINDOW[1:])}, arg_max(coalesce(lower(trim(availability_status)), '(none)'), presence_id) as status from offer_presence group by all)"""


def _history(spark, folder):
    s = F.coalesce(fo.clean_status("availability_status"), F.lit("(none)"))
    d = _presence(spark, folder).select("snapshot_date", canonical_url("property_url").alias("property_url"), *_WINDOW[1:], "presence_id", s.alias("status"))
    return d.groupBy("snapshot_date", *_WINDOW).agg(F.max_by("status", "presence_id").alias("status"))


@query(
    f"""with {_HISTORY}, l as (select status, lag(status) over (partition by u, {', '.join(_WINDOW[1:])} order by snapshot_date) as previous_status from h)
    select status, previous_status, count(*) as n from l group by 1, 2"""
)
def win01_previous_snapshot(spark, folder):
    d = relational.previous(_history(spark, folder), _WINDOW, "snapshot_date", ["status"])
    return d.groupBy("status", "previous_status").agg(F.count("*").alias("n"))


@query(
    f"""with {_HISTORY}, l as (select status as s, lag(status) over (partition by u, {', '.join(_WINDOW[1:])} order by snapshot_date) as p from h)
    select case when p = 'available' and s = 'available' then 'available' when p = 'no_available_offer' and s = 'available' then 'newly_available'
      when p = 'available' and s = 'no_available_offer' then 'disappeared' when p = 'no_available_offer' and s = 'no_available_offer' then 'still_unavailable' else 'unknown' end as state, count(*) as n from l group by 1"""
)
def prd01_availability_state(spark, folder):
    d = relational.previous(_history(spark, folder), _WINDOW, "snapshot_date", ["status"])
    return d.groupBy(fo.availability_state(F.col("status"), F.col("previous_status")).alias("state")).agg(F.count("*").alias("n"))


@query(
    f"""with p as (select snapshot_date, market, lead_time_days, {_URL} as u, quantile_cont({_PRICE}, 0.5) as m from price_observations group by all)
    select strftime(snapshot_date, '%Y-%m-%d') as snapshot_date, market, lead_time_days, u as property_url,
    case when m is not null then rank() over (partition by snapshot_date, market, lead_time_days order by m desc nulls last) end as price_rank from p"""
)
def win02_price_rank(spark, folder):
    d = _offers(spark, folder).withColumn("property_url", canonical_url("property_url"))
    key = ["snapshot_date", "market", "lead_time_days", "property_url"]
    m = quantiles.medians(d, key, fo.valid_price("price_per_night"), "m")
    every = d.select(*key).distinct()
    on = F.lit(True)
    for k in key:
        on = on & every[k].eqNullSafe(m[k])
    d = every.join(m, on, "left").select(*[every[k] for k in key], "m")
    return relational.rank_descending(d, key[:3], "m", "price_rank").drop("m").withColumn("snapshot_date", F.date_format("snapshot_date", "yyyy-MM-dd"))


@query("select observation_id, last_value(room_id ignore nulls) over (partition by run_id, property_url order by observation_id rows between unbounded preceding and current row) as room_id from price_observations")
def win06_carry_forward(spark, folder):
    d = _offers(spark, folder).select("run_id", "property_url", "observation_id", "room_id")
    return relational.carry_forward(d, ["run_id", "property_url"], "observation_id", ["room_id"]).select("observation_id", "room_id")


@query("select property_url, ntile(7) over (order by property_url)::int as shard from (select distinct property_url from price_observations)")
def win08_shards(spark, folder):
    return relational.shards(_offers(spark, folder).select("property_url").distinct(), ["property_url"], 7)


@query("select spec_id, row_number() over (order by property_url, spec_id) as index from client_specs where property_url is not null")
def win09_stable_index(spark, folder):
    d = table(spark, folder, "client_specs").where("property_url is not null").select("spec_id", "property_url")
    return relational.number_rows(d, ["property_url", "spec_id"]).select("spec_id", "index")


# --- joins


_SUBJECT = "property_url like '%mirtolana-bay-resort%'"


@query(f"select market, count(*) as n from price_observations p where not ({_SUBJECT}) and exists (select 1 from price_observations s where {_SUBJECT.replace('property_url', 's.property_url')} and s.checkin is not distinct from p.checkin and s.lead_time_days is not distinct from p.lead_time_days and s.stay_length_days is not distinct from p.stay_length_days) group by 1")
def join01_context_match(spark, folder):
    d = _offers(spark, folder)
    mine = F.col("property_url").contains("mirtolana-bay-resort")
    return relational.in_contexts_of(d.where(~mine), d.where(mine), ["checkin", "lead_time_days", "stay_length_days"]).groupBy("market").agg(F.count("*").alias("n"))


@query(
    """with k as (select property_url, room_name, arg_min(room_id, observation_id) as found from price_observations where trim(coalesce(room_id, '')) <> '' group by 1, 2)
    select observation_id, coalesce(k.found, p.room_id) as room_id, k.found is not null as reconciled from price_observations p left join k using (property_url, room_name) where trim(coalesce(room_id, '')) = ''"""
)
def join06_reconcile_room(spark, folder):
    d = _offers(spark, folder).select("observation_id", "property_url", "room_name", "room_id")
    out = relational.reconcile(d.where(validation.blank("room_id")), d, ["property_url", "room_name"], "room_id", "observation_id", "reconciled")
    return out.select("observation_id", "room_id", "reconciled")


@query(
    """with f as (select property_url, arg_min(property_name, observation_id) filter (where property_name is not null) as name from price_observations group by 1)
    select observation_id, coalesce(p.property_name, f.name) as property_name from price_observations p left join f using (property_url)"""
)
def join07_context_fallback(spark, folder):
    d = _offers(spark, folder).select("observation_id", "property_url", "property_name")
    return relational.fill_from_first(d, "property_url", "observation_id", ["property_name"]).select("observation_id", "property_name")


@query("select p.run_id, count(*) as n from price_observations p join (select property_url, max(run_id) as last_run from price_observations group by 1) l on l.property_url = p.property_url and l.last_run = p.run_id group by 1")
def join11_later_run_wins(spark, folder):
    return relational.later_run_wins(_offers(spark, folder), "property_url", "run_id").groupBy("run_id").agg(F.count("*").alias("n"))


@query(
    f"""with have as (select distinct {_URL} as u, lead_time_days, stay_length_days from offer_presence),
    need as (select u, l.l, s.s from (select distinct u from have), (values (7), (14), (30)) l(l), (values (1), (4), (7)) s(s))
    select u as property_url, l as lead_time_days, s as stay_length_days from need where not exists (select 1 from have h where h.u = need.u and h.lead_time_days = l and h.stay_length_days = s)"""
)
def join13_missing_windows(spark, folder):
    have = _presence(spark, folder).select(canonical_url("property_url").alias("property_url"), "lead_time_days", "stay_length_days").distinct()
    grid = F.array(*[F.struct(F.lit(a).alias("lead_time_days"), F.lit(b).alias("stay_length_days")) for a in (7, 14, 30) for b in (1, 4, 7)])
    need = have.select("property_url").distinct().select("property_url", F.inline(grid))
    return relational.missing_windows(need, have, ["property_url", "lead_time_days", "stay_length_days"])


@query(f"select distinct {_URL} as property_url from price_observations where {_URL} not in (select {_URL} from benchmark_configs where property_url is not null)")
def join15_not_configured(spark, folder):
    known = table(spark, folder, "benchmark_configs").select(canonical_url("property_url").alias("property_url"))
    return _offers(spark, folder).select(canonical_url("property_url").alias("property_url")).distinct().join(known, "property_url", "left_anti")


# What each part of the similarity weighs.
_WEIGHTS = {"size": 0.18, "beds": 0.15, "review": 0.17, "stars": 0.12, "tokens": 0.16, "type": 0.22}


@query(
    f"""with {_TOKENS_SQL}, c as (select s.*, t.tokens from client_specs s join tok t using (spec_id) where {_USABLE}),
    pairs as (select a.spec_id as a, b.spec_id as b,
      case when trim(a.property_type) <> '' and trim(b.property_type) <> '' then (lower(trim(a.property_type)) = lower(trim(b.property_type)))::int end as ty,
      greatest(0, 1 - least(abs(a.room_size_sqm - b.room_size_sqm) / greatest(abs(a.room_size_sqm), abs(b.room_size_sqm), 1.0), 1.0)) as sz, a.room_size_sqm + b.room_size_sqm as sz_ok,
      greatest(0, 1 - least(abs(a.bed_count - b.bed_count) / 4.0, 1.0)) as be, a.bed_count + b.bed_count as be_ok,
      greatest(0, 1 - least(abs(a.review_score - b.review_score) / 10.0, 1.0)) as re, a.review_score + b.review_score as re_ok,
      greatest(0, 1 - least(abs(a.star_rating - b.star_rating) / 5.0, 1.0)) as st, a.star_rating + b.star_rating as st_ok,
      case when len(a.tokens) > 0 and len(b.tokens) > 0 then len(list_intersect(a.tokens, b.tokens))::double / (len(a.tokens) + len(b.tokens) - len(list_intersect(a.tokens, b.tokens))) end as tk
      from c a join c b on a.spec_id < b.spec_id where abs(a.latitude - b.latitude) < 0.01
        and 2 * 6371.0088 * asin(sqrt(least(1.0, pow(sin(radians(b.latitude - a.latitude) / 2), 2) + cos(radians(a.latitude)) * cos(radians(b.latitude)) * pow(sin(radians(b.longitude - a.longitude) / 2), 2)))) <= 1.0),
    w as (select a, b, (case when ty is not null then 0.22 else 0 end + case when sz_ok is not null then 0.18 else 0 end + case when be_ok is not null then 0.15 else 0 end
        + case when re_ok is not null then 0.17 else 0 end + case when st_ok is not null then 0.12 else 0 end + case when tk is not null then 0.16 else 0 end) as wt,
      coalesce(ty * 0.22, 0) + case when sz_ok is not null then sz * 0.18 else 0 end + case when be_ok is not null then be * 0.15 else 0 end
        + case when re_ok is not null then re * 0.17 else 0 end + case when st_ok is not null then st * 0.12 else 0 end + coalesce(tk * 0.16, 0) as v from pairs)
    select a as spec_id_a, b as spec_id_b, round(case when wt > 0 then v / wt else 0 end, 6) as similarity from w"""
)
def biz04_near_peers(spark, folder):
    """Feature similarity of specs within a kilometre of each other."""
    d = table(spark, folder, "client_specs").where(usable(F.col("latitude"), F.col("longitude")))
    pairs = near_pairs(d, "spec_id", "latitude", "longitude", 1.0)
    cols = ["property_type", "room_size_sqm", "bed_count", "review_score", "star_rating"]
    side = lambda s: d.select(F.col("spec_id").alias(s), *[F.col(c).alias(f"{c}_{s}") for c in cols], value_set("amenities", "property_facilities").alias(f"tokens_{s}"))
    j = pairs.join(side("a"), "a").join(side("b"), "b")
    kind = lambda s: F.nullif(F.lower(F.trim(f"property_type_{s}")), F.lit(""))
    ab = lambda c: (F.col(f"{c}_a"), F.col(f"{c}_b"))
    parts = [
        (_WEIGHTS["type"], (kind("a") == kind("b")).cast("double")),
        (_WEIGHTS["size"], fo.numeric_similarity(*ab("room_size_sqm"))),
        (_WEIGHTS["beds"], fo.numeric_similarity(*ab("bed_count"), 4)),
        (_WEIGHTS["review"], fo.numeric_similarity(*ab("review_score"), 10)),
        (_WEIGHTS["stars"], fo.numeric_similarity(*ab("star_rating"), 5)),
        (_WEIGHTS["tokens"], fo.set_overlap(*ab("tokens"))),
    ]
    return j.select(F.col("a").alias("spec_id_a"), F.col("b").alias("spec_id_b"), F.round(fo.weighted_mean(parts), 6).alias("similarity"))


# --- validation, statistics, streams


@query("select l_returnflag, round(quantile_cont(l_extendedprice - l_quantity * 1000, 0.1), 6) as lower, round(quantile_cont(l_extendedprice - l_quantity * 1000, 0.9), 6) as upper from lineitem group by 1")
def ml16_residual_band(spark, folder):
    d = table(spark, folder, "lineitem").withColumn("r", F.col("l_extendedprice") - F.col("l_quantity") * 1000)
    return _rounded(quantiles.group_quantiles(d, ["l_returnflag"], F.col("r"), {"lower": 0.1, "upper": 0.9}).drop("n"))


@query("select 'l_quantity' as feature, round(regr_slope(l_extendedprice, l_quantity), 4) as coefficient from lineitem union all select '(constant)', round(regr_intercept(l_extendedprice, l_quantity), 4) from lineitem")
def ml06_least_squares(spark, folder):
    m = models.least_squares(table(spark, folder, "lineitem"), ["l_quantity"], "l_extendedprice")
    return spark.createDataFrame([(n, round(c, 4)) for n, c in zip(m.names, m.coefficients)], "feature string, coefficient double")


_LINE_FEATURES = ["l_quantity", "l_discount", "l_tax"]


def _log_prices(spark, folder):
    d = table(spark, folder, "lineitem").where(fo.valid_price("l_extendedprice").isNotNull())
    return d.select("l_orderkey", *[F.col(c).cast("double").alias(c) for c in _LINE_FEATURES], F.log("l_extendedprice").alias("y"))


@query()
def ml06_hc3(spark, folder):
    """Coefficients of log price on several features, with HC3 errors."""
    m = models.least_squares(_log_prices(spark, folder), _LINE_FEATURES, "y")
    return spark.createDataFrame([(n, round(c, 9), round(e, 9)) for n, c, e in zip(m.names, m.coefficients, m.errors)], "feature string, coefficient double, error double")


@query()
def ml16_conformal_offsets(spark, folder):
    """The band of four fifths of the log residuals, each of a model that was fitted without the row's order."""
    d = _log_prices(spark, folder)
    d, _ = store(d.join(models.group_folds(d, "l_orderkey", 5), "l_orderkey"), "folded")
    held = []
    for k in range(5):
        m = models.least_squares(d.where(F.col("fold") != k), _LINE_FEATURES, "y")
        held.append(d.where(F.col("fold") == k).select((F.col("y") - m.predict()).alias("r")))
    return _rounded(models.conformal_offsets(reduce(DataFrame.unionByName, held), "r", 0.8))


@query("select spec_id, (star_rating is null or isnan(star_rating))::int as star_rating_missing, case when star_rating is null or isnan(star_rating) then (select quantile_cont(star_rating, 0.5) from client_specs where not isnan(star_rating)) else star_rating end as star_rating from client_specs")
def ml03_imputed(spark, folder):
    d = table(spark, folder, "client_specs").select("spec_id", "star_rating")
    return models.imputed(d, ["star_rating"])


@query("select strftime(time_bucket(interval '1 day', ts), '%Y-%m-%d') as day, event_type, count(*) as n, round(sum(value), 4) as total from events group by 1, 2")
def str01_windowed_events(spark, folder):
    source = spark.read.parquet(f"{folder}/events.parquet")
    stream = spark.readStream.schema(source.schema).option("pathGlobFilter", "events.parquet").parquet(folder)
    stream = stream.withColumn("ts", F.col("ts").cast("timestamp"))
    d = run_once(windowed_counts(stream, "ts", "event_type", "value", "1 day", "2 hours"))
    return d.select(F.date_format("window_start", "yyyy-MM-dd").alias("day"), "event_type", "n", F.round("total", 4).alias("total"))
