"""Queries of validation, contracts, pages, movements and history tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nightledger.functions import offers as fo
from nightledger.functions import pages as fp
from nightledger.functions.text import canonical_url, value_set
from nightledger.operators import features, models, movement, relational, runs, spatial, summaries, validation
from nightledger.sources import files, html
from nightledger.sources.tables import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

_URL = "split_part(split_part(property_url, '?', 1), '#', 1)"
_PRICE = "case when price_per_night > 0 and not isnan(price_per_night) then price_per_night end"


_USABLE_SQL = "latitude is not null and longitude is not null and not isnan(latitude) and not isnan(longitude) and abs(latitude) <= 90 and abs(longitude) <= 180 and not (latitude = 0 and longitude = 0)"


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def _blank(c: str) -> str:
    return f"trim(coalesce({c}::varchar, '')) = ''"


def _rounded(d: DataFrame, digits: int = 6) -> DataFrame:
    return d.select(*[F.round(c, digits).alias(c) if t == "double" else F.col(c) for c, t in d.dtypes])


# --- validation


@query(
    f"""select 'room_inventory_fields' as check, sum(({_blank('room_id')})::int + ({_blank('room_name')})::int) as issues from price_observations
    union all select 'room_inventory_duplicates', count(*) - count(distinct (property_url, room_id)) from price_observations where not ({_blank('room_id')}) and not ({_blank('property_url')})"""
)
def val06_inventory(spark, folder):
    d = table(spark, folder, "price_observations").select("observation_id", "property_url", "room_id", "room_name")
    return validation.issue_counts(validation.inventory_issues(d, "observation_id"))


_NIGHTLY_BAD = "abs(price_per_night - round(current_price_value / stay_length_days, 2)) > greatest(0.01, 1e-9 * greatest(abs(price_per_night), abs(round(current_price_value / stay_length_days, 2))))"


@query(
    f"""select * from (
    select 'price_row_fields' as check, sum(({_blank('checkin')})::int + ({_blank('checkout')})::int + ({_blank('stay_length_days')})::int + ({_blank('captured_at')})::int) as issues from price_observations
    union all select 'price_row_room_identity', count(*) from price_observations where {_blank('room_id')} and {_blank('room_name')}
    union all select 'price_row_positive_price', count(*) from price_observations where not isnan(current_price_value) and current_price_value <= 0
    union all select 'price_per_night_consistency', count(*) from price_observations where stay_length_days > 0 and not isnan(price_per_night) and not isnan(current_price_value) and {_NIGHTLY_BAD})
    where issues > 0"""
)
def val07_price_rows(spark, folder):
    d = table(spark, folder, "price_observations")
    return validation.issue_counts(validation.issues(d, validation.price_row_rules(), F.col("observation_id")))


@query(
    """select * from (select 'room_feature_room_id' as check, count(*) as issues from client_specs where spec_id % 11 = 0
    union all select 'room_feature_duplicates', count(*) - count(distinct (property_url, spec_id // 4)) from client_specs where spec_id % 11 <> 0 and trim(coalesce(property_url, '')) <> ''
    union all select 'room_feature_bounds', sum(coalesce((not isnan(room_size_sqm) and (room_size_sqm <= 0 or room_size_sqm > 60))::int, 0) + coalesce((not isnan(bed_count) and bed_count < 2)::int, 0)) from client_specs) where issues > 0"""
)
def val08_room_features(spark, folder):
    """Rooms are numbered by every fourth spec, every eleventh has none; sizes and beds are scaled so that some are out of bounds."""
    d = table(spark, folder, "client_specs").select(
        "spec_id", "property_url", F.when(F.col("spec_id") % 11 != 0, F.floor(F.col("spec_id") / 4).cast("string")).alias("room_id"),
        (F.col("room_size_sqm") * 1000 / 60).alias("room_size_sqm"), (F.col("bed_count") - 2).alias("bed_count"),
    )
    return validation.issue_counts(validation.room_feature_issues(d, "spec_id"))


@query(
    """select * from (select 'property_feature_property_url' as check, count(*) as issues from client_specs where trim(coalesce(property_url, '')) = ''
    union all select 'property_feature_duplicates', count(*) - count(distinct property_url) from client_specs where trim(coalesce(property_url, '')) <> ''
    union all select 'property_feature_bounds', sum(coalesce((not isnan(star_rating) and star_rating + 1 > 5)::int, 0) + coalesce((not isnan(review_score) and review_score + 1 > 10)::int, 0)
      + coalesce((not isnan(review_score) and review_score + 2 > 10)::int, 0) + coalesce((not isnan(latitude) and latitude < 0)::int, 0)) from client_specs) where issues > 0"""
)
def val09_property_features(spark, folder):
    """Stars and scores moved by one, so that some leave their scales; a subscore and a distance besides."""
    d = table(spark, folder, "client_specs").select(
        "spec_id", "property_url", (F.col("star_rating") + 1).alias("star_rating"), (F.col("review_score") + 1).alias("review_score"),
        F.create_map(F.lit("comfort"), F.col("review_score") + 2).alias("review_subscores"), F.array(F.struct(F.col("latitude").alias("distance"))).alias("nearby_poi"),
    )
    return validation.issue_counts(validation.property_feature_issues(d, "spec_id"))


@query(
    """with f as (select presence_id, failure_reason, case when presence_id % 3 = 0 then 'page-' || (presence_id % 50) || '.html' end as page from offer_presence where lower(trim(availability_status)) <> 'available')
    select * from (select 'failure_category' as check, count(*) as issues from f where trim(coalesce(failure_reason, '')) = ''
    union all select 'failure_snapshot_exists', count(*) from f where page is not null and (presence_id % 50) >= 25) where issues > 0"""
)
def val10_failures(spark, folder):
    d = table(spark, folder, "offer_presence").where(F.lower(F.trim("availability_status")) != "available")
    page = F.concat(F.lit("page-"), F.col("presence_id") % 50, F.lit(".html"))
    d = d.select("presence_id", F.col("failure_reason").alias("category"), F.when(F.col("presence_id") % 3 == 0, page).alias("snapshot_filename"))
    pages = spark.range(25).select(F.concat(F.lit("page-"), F.col("id"), F.lit(".html")).alias("name"))
    return validation.issue_counts(validation.failure_issues(d, pages, "presence_id"))


@query(
    f"""with bad as (select run_id, ({_blank('checkin')})::int + ({_blank('checkout')})::int + ({_blank('stay_length_days')})::int + ({_blank('captured_at')})::int as a, coalesce(({_blank('room_id')} and {_blank('room_name')})::int, 0) as b,
      coalesce((not isnan(current_price_value) and current_price_value <= 0)::int, 0) as c,
      coalesce((stay_length_days > 0 and not isnan(price_per_night) and not isnan(current_price_value) and {_NIGHTLY_BAD})::int, 0) as d from price_observations),
    n as (select run_id, sum(a + b + c + d) as issues, (sum(a) > 0)::int + (sum(b) > 0)::int + (sum(c) > 0)::int + (sum(d) > 0)::int as failed_checks from bad group by 1)
    select run_id, issues, failed_checks, issues = 0 as valid from n"""
)
def val11_run_reports(spark, folder):
    """Every run with its issues and whether it's valid; runs without an issue too."""
    d = table(spark, folder, "price_observations")
    found = validation.issues(d, validation.price_row_rules(), F.col("run_id"))
    every = d.select(F.col("run_id").alias("location")).distinct()
    return validation.run_report(every.join(found, "location", "left"), F.col("location"))


def _contract_sql(source: str, not_null: list[str], not_blank: list[str], rules: dict[str, str]) -> str:
    checks = {**{f"{c} has nulls": f"{c} is null" for c in not_null}, **{f"{c} has blanks": f"trim({c}::varchar) = ''" for c in not_blank}, **rules}
    return "select * from (" + " union all ".join(f"select '{m.replace(chr(39), chr(39) * 2)}' as violation, count(*) filter (where {f}) as rows from {source}" for m, f in checks.items()) + ") where rows > 0"


_SEARCH_SQL = {
    "checkout isn't after checkin": "checkout <= checkin",
    **{f"{c} is negative": f"{c} < 0" for c in ("lead_time_days", "children")},
    **{f"{c} isn't positive": f"{c} <= 0" for c in ("stay_length_days", "adults", "rooms")},
}


@query(
    _contract_sql(
        "price_observations",
        "snapshot_date captured_at run_id property_url property_name room_id room_name block_id checkin checkout lead_time_days stay_length_days adults children rooms currency market price_per_night current_price_value property_type".split(),
        "run_id property_url property_name room_id room_name block_id currency market property_type".split(),
        {**_SEARCH_SQL, **{f"{c} isn't positive": f"not isnan({c}) and {c} <= 0" for c in ("price_per_night", "current_price_value")}},
    )
)
def val02_observations(spark, folder):
    return validation.violations(table(spark, folder, "price_observations"), validation.observation_contract())


@query(
    _contract_sql(
        "offer_presence",
        "snapshot_date captured_at run_id property_url property_name checkin checkout lead_time_days stay_length_days adults children rooms currency market property_type availability_status".split(),
        "run_id property_url property_name currency market property_type availability_status".split(),
        {**_SEARCH_SQL, "availability_status is unknown": "availability_status not in ('available', 'no_available_offer', 'scrape_failed')"},
    )
)
def val03_presence(spark, folder):
    return validation.violations(table(spark, folder, "offer_presence"), validation.presence_contract())


@query(_contract_sql("price_observations", "property_name property_url checkin checkout lead_time_days stay_length_days block_id current_price_value price_per_night".split(), [], {}))
def val01_modelling_table(spark, folder):
    return validation.violations(table(spark, folder, "price_observations"), validation.modelling_contract())


# --- pages


_STATUS = "case doc_id % 6 when 0 then 202 when 1 then 503 when 2 then 429 else 200 end"
_HAS = lambda ps: "(" + " or ".join("contains(t, '" + p.replace("'", "''") + "')" for p in ps) + ")"


@query(
    f"""with d as (select doc_id, {_STATUS} as status, doc_id % 10 = 9 as moved, doc_id % 17 = 0 as there,
      trim(regexp_replace(replace(replace(lower(coalesce(text, '')), '’', ''''), '‘', ''''), '[\\s\\p{{Z}}\\x0b\\x{{0085}}\\x1c-\\x1f]+', ' ', 'g')) as t from documents)
    select case when there then null when {_HAS(fp.BLOCKED)} or status in (202, 403, 429) then 'blocked_challenge' when status >= 500 then 'temporary_booking_error' when moved then 'redirect'
      when {_HAS(fp.EMPTY)} then 'empty_availability' when {_HAS(fp.TEMPORARY)} then 'temporary_booking_error'
      when length(t) < 500 or (contains(t, '<html') and not contains(t, '</html>')) then 'partial_load' when {_HAS(fp.PROPERTY)} then 'selector_drift' else 'partial_load' end as category, count(*) as n
    from d group by 1"""
)
def prd09_page_failures(spark, folder):
    """Documents as pages: statuses, redirects and found selectors by number."""
    i = F.col("doc_id")
    status = F.when(i % 6 == 0, 202).when(i % 6 == 1, 503).when(i % 6 == 2, 429).otherwise(200)
    asked = F.concat(F.lit("https://Hotels.example/p/"), i, F.lit("/?q=1"))
    got = F.when(i % 10 == 9, F.lit("https://hotels.example/gone")).when(i % 10 < 8, F.concat(F.lit("https://hotels.example/p/"), i, F.lit("#top")))
    d = table(spark, folder, "documents").select(F.when(i % 17 == 0, 3).otherwise(0).alias("expected"), fp.page_text("text").alias("t"), got.alias("final"), asked.alias("asked"), status.alias("status"))
    category = fp.page_failure(F.col("t"), F.col("final"), F.col("asked"), F.col("expected"), F.lit(0), F.col("status"))
    return d.groupBy(category.alias("category")).agg(F.count("*").alias("n"))


@query()
def sca16_visible_text(spark, folder):
    d = table(spark, folder, "documents").select("doc_id", "text")
    return html.visible_text(d, "text", "shown").select("doc_id", "shown")


@query(
    r"""select spec_id as page, 1 as position, trim(regexp_replace(property_name, '[\s\p{Z}]+', ' ', 'g')) as name, 'https://hotels.example/hotel/gr/p' || spec_id || '.html' as url, '€ ' || bed_count::int as price_text
    from client_specs where trim(regexp_replace(property_name, '[\s\p{Z}]+', ' ', 'g')) <> '' and not contains(property_name, '<') and not contains(property_name, '&')"""
)
def src16_listings(spark, folder):
    """Cards made of the specs, the second of each a repeat, the third without an address; read back."""
    d = table(spark, folder, "client_specs").where(~F.contains("property_name", F.lit("<")) & ~F.contains("property_name", F.lit("&")))
    card = lambda href: F.concat(
        F.lit("<div data-testid='property-card'><a data-testid='title-link' href='"), href, F.lit("'><div data-testid=title><b>"), F.col("property_name"),
        F.lit("</b></div></a><br><span data-testid='price-and-discounted-price'>"), F.coalesce(F.concat(F.lit("€ "), F.col("bed_count").cast("int")), F.lit("")), F.lit("</span></div>"),
    )
    url = F.concat(F.lit("https://hotels.example/hotel/gr/p"), F.col("spec_id"), F.lit(".html?label=x#y"))
    pages = d.select("spec_id", F.concat(F.lit("<html><script>var x = '<a>';</script>"), card(url), card(url), card(F.lit("/about"))).alias("html"))
    return html.listings(pages, "spec_id", "html").select("page", "position", "name", "url", "price_text")


_CLEAN_SQL = r"trim(regexp_replace(v, '[\s\p{Z}\x0b\x{0085}\x1c-\x1f]+', ' ', 'g'))"


@query(
    f"""with a as (select spec_id, list_filter(list_transform(list_filter(coalesce(amenities, []), lambda v: v is not null), lambda v: {_CLEAN_SQL}), lambda v: v <> '') as am from client_specs)
    select s.spec_id as page, s.spec_id::varchar as room_id, case when not isnan(room_size_sqm) then round(room_size_sqm, 1) end as room_size_sqm, case when not isnan(bed_count) then bed_count::int end as bed_count,
      case when spec_id % 2 = 0 then 4 else 3 end as max_persons, array_to_string(am, '|') as amenities from client_specs s join a using (spec_id)"""
)
def udf03_room_features(spark, folder):
    """Pages made of the specs, read back: each room twice, the second time under another name."""
    d = table(spark, folder, "client_specs").withColumn("i", F.col("spec_id"))
    safe = lambda v: F.replace(F.replace(v, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
    some = F.filter(F.coalesce("amenities", F.array().cast("array<string>")), lambda v: v.isNotNull())
    items = F.array_join(F.transform(some, lambda v: F.concat(F.lit("<li class='hprt-facilities-facility'>"), safe(v), F.lit("</li>"))), "")
    size = F.when(~F.isnan("room_size_sqm"), F.concat(F.lit("<b class='size hprt-facilities-facility'>"), F.round("room_size_sqm", 1).cast("string"), F.lit(" m²</b>")))
    beds = F.when(~F.isnan("bed_count"), F.concat(F.lit("<i class='rt-bed-type'>"), F.col("bed_count").cast("int").cast("string"), F.lit(" beds</i>")))
    sleeps = F.when(F.col("i") % 2 == 0, "Sleeps: 1 - 4 guests").otherwise("Max persons: 3")
    row = lambda name, more: F.concat(
        F.lit("<tr class='js-rt-block-row' data-block-id='"), F.col("i"), F.lit("_1'><th class='hprt-table-cell-roomtype'><a class='hprt-roomtype-link'>" + name + "</a>"), more,
        F.lit("</th><td class='hprt-table-cell-occupancy'>"), sleeps, F.lit("</td></tr>"),
    )
    page = F.concat(F.lit("<table>"), row("Suite", F.concat(F.coalesce(beds, F.lit("")), items, F.coalesce(size, F.lit("")))), row("Again", F.lit("")), F.lit("</table>"))
    out = html.room_features(d.select("spec_id", page.alias("html")), "spec_id", "html")
    listed = F.filter(F.coalesce("amenities", F.array().cast("array<string>")), lambda t: ~t.rlike("^[0-9.]+ m²$"))
    return out.select("page", "room_id", "room_size_sqm", "bed_count", "max_persons", F.array_join(listed, "|").alias("amenities"))


@query(
    f"""select spec_id as page, case when not isnan(star_rating) and star_rating > 0 and star_rating <= 5 then star_rating end as star_rating, case when not isnan(review_score) then round(review_score, 1) end as review_score,
      case when {_USABLE_SQL} then latitude end as latitude, case when {_USABLE_SQL} then longitude end as longitude, 'Villa' as property_type, (spec_id * 1000 + 7)::int as review_count from client_specs"""
)
def udf04_property_features(spark, folder):
    """Property pages made of the specs, read back."""
    d = table(spark, folder, "client_specs")
    text = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    ok = spatial.usable(F.col("latitude"), F.col("longitude"))
    score = F.when(~F.isnan("review_score"), F.concat(F.lit("Scored "), F.round("review_score", 1).cast("string"), F.lit(" ")))
    page = F.concat(
        F.lit("<i data-testid='rating-stars' aria-label='"), F.coalesce(F.when(~F.isnan("star_rating"), F.concat(F.col("star_rating").cast("string"), F.lit(" out of five"))), F.lit("none")), F.lit("'></i><a data-atlas-latlng='"),
        F.coalesce(F.when(ok, F.concat(text(F.col("latitude")), F.lit(","), text(F.col("longitude")))), F.lit("x")), F.lit("'></a><p data-testid='breadcrumb-current'>A (new) home (VILLA) (Greece)</p>"),
    )
    badge = F.concat(F.lit("<div data-testid='review-score-right-component'>"), F.coalesce(score, F.lit("")), F.format_number(F.col("spec_id") * 1000 + 7, 0), F.lit(" reviews</div>"))
    out = html.property_features(d.select("spec_id", "review_score", F.concat(page, badge).alias("html")), "spec_id", "html")
    none = d.select(F.col("spec_id").alias("page"), (F.col("review_score").isNull() | F.isnan("review_score")).alias("unscored"))
    # without a score the badge's first number is the count's
    out = out.join(none, "page").withColumn("review_score", F.when(~F.col("unscored"), F.col("review_score")))
    return out.select("page", "star_rating", "review_score", "latitude", "longitude", "property_type", "review_count")


@query("select case when p is null then 'an unclear position relative to' when p >= 90 then 'at the very top of' when p >= 75 then 'well above the middle of' when p >= 55 then 'above the middle of' when p > 45 then 'around the middle of' when p > 25 then 'below the middle of' when p > 10 then 'well below the middle of' else 'at the very bottom of' end as band, count(*) as n from (select case when not isnan(review_score) then review_score * 10 end as p from client_specs) group by 1")
def prd02_bands(spark, folder):
    p = F.when(~F.isnan("review_score"), F.col("review_score") * 10)
    return table(spark, folder, "client_specs").groupBy(fp.percentile_band(p).alias("band")).agg(F.count("*").alias("n"))


@query("with m as (select spec_id, price_per_night / 150 - 1 as r from client_specs where price_per_night is null or not isnan(price_per_night)) select case when r is null then 'insufficient' when r > 0.15 then 'unjustified_premium' when r > 0.05 then 'mixed_premium' when r >= -0.05 then 'fair' else 'underpriced' end as position, count(*) as n from m group by 1")
def prd03_positions(spark, folder):
    d = table(spark, folder, "client_specs").where(F.col("price_per_night").isNull() | ~F.isnan("price_per_night"))
    return d.groupBy(fp.position_class(F.col("price_per_night") / 150 - 1).alias("position")).agg(F.count("*").alias("n"))


# --- movements


_MOVE_KEY = ["snapshot_date", "property_url", "lead_time_days", "stay_length_days", "adults", "children", "rooms", "currency", "market"]


@query(
    f"""select strftime(snapshot_date, '%Y-%m-%d') as snapshot_date, {_URL} as u, lead_time_days, stay_length_days, adults, children, rooms, currency, market,
      strftime(max(captured_at), '%Y-%m-%d %H:%M:%S') as captured_at, arg_max(run_id, observation_id) as run_id, arg_max(room_name, observation_id) filter (where room_name is not null) as room_name, 'available' as availability_status
    from price_observations group by snapshot_date, u, lead_time_days, stay_length_days, adults, children, rooms, currency, market"""
)
def agg13_presence_from_offers(spark, folder):
    d = table(spark, folder, "price_observations").withColumn("property_url", canonical_url("property_url"))
    out = movement.presence_from_offers(d, _MOVE_KEY, "observation_id", ["run_id", "room_name"]).drop("failure_reason").withColumnRenamed("property_url", "u")
    return out.withColumns({"snapshot_date": F.date_format("snapshot_date", "yyyy-MM-dd"), "captured_at": F.date_format("captured_at", "yyyy-MM-dd HH:mm:ss")})


@query(
    f"""with p as (select snapshot_date, lead_time_days, stay_length_days, currency, market, {_URL} as u, quantile_cont({_PRICE}, 0.5) as price from price_observations group by all),
    m as (select snapshot_date, lead_time_days, stay_length_days, currency, market, quantile_cont(price, 0.5) as median, count(price) as n from p where price is not null group by all)
    select strftime(p.snapshot_date, '%Y-%m-%d') as snapshot_date, p.lead_time_days, p.stay_length_days, p.currency, p.market, u as property_url, round(price, 6) as price, round(median, 6) as market_median, m.n as market_prices,
      round(price - median, 6) as market_gap, round((price - median) / median, 6) as market_gap_share,
      case when price is not null then rank() over (partition by p.snapshot_date, p.lead_time_days, p.stay_length_days, p.currency, p.market order by price desc nulls last) end as price_rank
    from p left join m on p.snapshot_date = m.snapshot_date and p.lead_time_days is not distinct from m.lead_time_days and p.stay_length_days is not distinct from m.stay_length_days and p.currency = m.currency and p.market = m.market"""
)
def join03_market(spark, folder):
    d = table(spark, folder, "price_observations").withColumn("property_url", canonical_url("property_url"))
    key = [*movement.MARKET_KEY, "property_url"]
    own = movement.medians(d, key, fo.valid_price("price_per_night"), "price").drop("n")
    every = d.select(*key).distinct()
    on = F.lit(True)
    for k in key:
        on = on & every[k].eqNullSafe(own[k])
    rows = every.join(own, on, "left").select(*[every[k] for k in key], "price")
    return _rounded(movement.with_market(rows, "property_url", "price").withColumn("snapshot_date", F.date_format("snapshot_date", "yyyy-MM-dd")))


@query(
    f"""with o as (select snapshot_date, {_URL} as u, {_PRICE} as v from price_observations), days as (select distinct snapshot_date from o where snapshot_date is not null),
    own as (select u, snapshot_date, quantile_cont(v, 0.5) as price from o where v is not null group by all)
    select e.u as property_url, strftime(d.snapshot_date, '%Y-%m-%d') as snapshot_date, round(own.price, 6) as price
    from (select distinct u from o where u is not null) e, days d left join own on own.u = e.u and own.snapshot_date = d.snapshot_date"""
)
def agg20_price_series(spark, folder):
    d = table(spark, folder, "price_observations").withColumn("property_url", canonical_url("property_url"))
    return _rounded(movement.price_series(d, "property_url", "snapshot_date", fo.valid_price("price_per_night")).withColumn("snapshot_date", F.date_format("snapshot_date", "yyyy-MM-dd")))


@query(
    f"""with o as (select snapshot_date, contains({_URL}, 'mirtolana-bay-resort') as mine, {_PRICE} as v from price_observations)
    select strftime(snapshot_date, '%Y-%m-%d') as snapshot_date, round(quantile_cont(v, 0.5) filter (where mine and v is not null), 6) as subject_price, round(quantile_cont(v, 0.5) filter (where not mine and v is not null), 6) as peer_median,
      count(v) filter (where not mine) as peer_prices from o where snapshot_date is not null group by 1"""
)
def agg19_timeline(spark, folder):
    d = table(spark, folder, "price_observations").select("snapshot_date", "property_url", fo.valid_price("price_per_night").alias("price"))
    mine = F.coalesce(F.col("property_url").contains("mirtolana-bay-resort"), F.lit(False))
    return _rounded(movement.timeline(d, "snapshot_date", mine, "price").withColumn("snapshot_date", F.date_format("snapshot_date", "yyyy-MM-dd")))


@query(f"select u as property_url, count(*) as rows from (select {_URL} as u from price_observations) where trim(u) <> '' group by 1 order by 2 desc, 1 limit 1")
def agg17_default_subject(spark, folder):
    d = table(spark, folder, "price_observations").select(canonical_url("property_url").alias("property_url"))
    return summaries.default_subject(d, "property_url")


@query(
    """with o as (select market, trim(property_type) as t, price_per_night as p from price_observations),
    m as (select market, t, row_number() over (partition by market order by count(*) desc, t) as r from o where t <> '' group by 1, 2)
    select o.market, any_value(m.t) as usual_text, round(quantile_cont(p, 0.5) filter (where p is not null and not isnan(p)), 6) as usual_number from o left join m on m.market is not distinct from o.market and m.r = 1 group by 1"""
)
def agg03_usual_values(spark, folder):
    d = table(spark, folder, "price_observations").select("market", "property_type", "price_per_night")
    return _rounded(summaries.usual_values(d, ["market"], "property_type", "price_per_night"))


@query("select observation_id, price_per_night from price_observations where price_per_night is not null and not isnan(price_per_night) order by abs(price_per_night) desc, observation_id limit 20")
def srt03_largest(spark, folder):
    d = table(spark, folder, "price_observations").select("observation_id", "price_per_night")
    return relational.largest_by_magnitude(d, "price_per_night", "observation_id", 20)


@query(f"select u as property_url from (select distinct {_URL} as u from price_observations) where u is not null and u not in (select {_URL} from offer_presence where lower(trim(availability_status)) = 'available' and property_url is not null and lead_time_days = 7) order by 1 limit 10")
def srt05_next_batch(spark, folder):
    u = canonical_url("property_url").alias("property_url")
    targets = table(spark, folder, "price_observations").select(u).where("property_url is not null").distinct()
    attempted = table(spark, folder, "offer_presence").where((F.lower(F.trim("availability_status")) == "available") & (F.col("lead_time_days") == 7)).select(u)
    return relational.next_batch(targets, attempted, ["property_url"], ["property_url"], 10)


# --- history tables and features


_STORAGE_KEY = ["snapshot_date", "property_url", "checkin", "checkout", "adults", "children", "rooms", "currency", "market", "room_id", "block_id"]


@query(f"select observation_id from (select observation_id, row_number() over (partition by {', '.join(_STORAGE_KEY)} order by run_id >= '20310608', observation_id) as r, count(*) over (partition by {', '.join(_STORAGE_KEY)}) as n from price_observations) where r = n")
def snk03_observation_upsert(spark, folder):
    """The later half of the runs upserted into the earlier: one row a storage key, the later one."""
    d = table(spark, folder, "price_observations").select("run_id", "observation_id", *_STORAGE_KEY)
    late = F.col("run_id") >= "20310608"
    return relational.upsert(d.where(~late), d.where(late), _STORAGE_KEY, ["observation_id"]).select("observation_id")


_PRESENCE_KEY = ["snapshot_date", "property_url", "checkin", "checkout", "adults", "children", "rooms", "currency", "market"]
_PRIORITY = "case lower(trim(availability_status)) when 'available' then 0 when 'no_available_offer' then 1 when 'scrape_failed' then 2 else 3 end"


@query(f"select presence_id from (select presence_id, row_number() over (partition by {', '.join(_PRESENCE_KEY)} order by {_PRIORITY}, run_id >= '20310608', presence_id) as r from offer_presence) where r = 1")
def snk04_presence_upsert(spark, folder):
    """As snk03, but the better status wins, then the earlier row."""
    d = table(spark, folder, "offer_presence").select("run_id", "presence_id", "availability_status", *_PRESENCE_KEY)
    s = fo.clean_status("availability_status")
    rank = F.when(s == "available", 0).when(s == "no_available_offer", 1).when(s == "scrape_failed", 2).otherwise(3)
    late = F.col("run_id") >= "20310608"
    return relational.upsert(d.where(~late), d.where(late), _PRESENCE_KEY, ["presence_id"], rank).select("presence_id")


@query(
    """with c as (select checkin, market, arg_max(adults, presence_id) as event_flag from offer_presence where checkin is not null and market is not null group by 1, 2)
    select o.observation_id, c.event_flag as cov_event_flag from price_observations o left join c on c.checkin = o.checkin and c.market = o.market"""
)
def join08_covariates(spark, folder):
    """Presence rows stand in for the covariates: the last of each checkin and market counts."""
    cov = table(spark, folder, "offer_presence").select("checkin", "market", F.col("adults").alias("event_flag"), "presence_id")
    rows = table(spark, folder, "price_observations").select("observation_id", "checkin", "market")
    return features.covariates_for(rows, cov, "presence_id").select("observation_id", "cov_event_flag")


@query(
    """with r as (select property_url, room_id, arg_max(room_name, observation_id) as room_label from price_observations where property_url is not null and room_id is not null and room_name is not null group by 1, 2),
    p as (select property_url, arg_max(star_rating, spec_id) as star_rating from client_specs where property_url is not null and star_rating is not null and not isnan(star_rating) group by 1)
    select o.observation_id, r.room_label, p.star_rating from price_observations o left join r using (property_url, room_id) left join p using (property_url)"""
)
def join04_features(spark, folder):
    """Offers with the last features of their room and of their property."""
    offers = table(spark, folder, "price_observations").select("observation_id", "property_url", "room_id", "room_name")
    rooms = features.last_wins(offers.where("room_name is not null").withColumnRenamed("room_name", "room_label"), ["property_url", "room_id"], "observation_id")
    specs = table(spark, folder, "client_specs").where(F.col("star_rating").isNotNull() & ~F.isnan("star_rating")).select("spec_id", "property_url", "star_rating")
    props = features.last_wins(specs, ["property_url"], "spec_id")
    return offers.select("observation_id", "property_url", "room_id").join(rooms, ["property_url", "room_id"], "left").join(props, "property_url", "left").select("observation_id", "room_label", "star_rating")


_HAV = "2 * 6371.0088 * asin(sqrt(least(1.0, pow(sin(radians(latitude - {la}) / 2), 2) + cos(radians({la})) * cos(radians(latitude)) * pow(sin(radians(longitude - {lo}) / 2), 2))))"
_USABLE = "latitude is not null and longitude is not null and not isnan(latitude) and not isnan(longitude) and abs(latitude) <= 90 and abs(longitude) <= 180 and not (latitude = 0 and longitude = 0)"


@query(
    f"""select spec_id, round(least(case when {_USABLE} then least({_HAV.format(la=35.51, lo=24.02)}, {_HAV.format(la=35.3, lo=24.9)}) end, least(case when not isnan(bed_count) then bed_count * 250 / 1000 end, review_score)), 6) as beach_km,
    round(case when {_USABLE} then {_HAV.format(la=35.53, lo=24.15)} end, 6) as airport_km from (select * replace (case when not isnan(review_score) then review_score end as review_score) from client_specs)"""
)
def sca22_places(spark, folder):
    """Distances to fixed places and to the row's own points of interest, in metres and kilometres."""
    near = lambda c, unit: F.struct(F.lit("Sandy Beach").alias("category"), c.alias("distance"), F.lit(unit).alias("unit"))
    fine = lambda c: F.when(~F.isnan(c), F.col(c))
    d = table(spark, folder, "client_specs").withColumn("nearby_poi", F.array(near(fine("bed_count") * 250, "m"), near(fine("review_score"), "km")))
    out = features.place_distances(d, "latitude", "longitude", {"beach": [(35.51, 24.02), (35.3, 24.9)], "airport": [(35.53, 24.15)]}, {"beach": "beach"})
    return _rounded(out.select("spec_id", "beach_km", "airport_km"))


@query("select spec_id, amenities is null as no_list, coalesce(len(amenities), 0) as n from client_specs")
def prj06_nested_round_trip(spark, folder):
    """Nested columns as text and back."""
    d = table(spark, folder, "client_specs").select("spec_id", "amenities")
    back = files.decode_nested(files.encode_nested(d), {"amenities": d.schema["amenities"].dataType})
    return back.select("spec_id", F.col("amenities").isNull().alias("no_list"), F.coalesce(F.array_size("amenities"), F.lit(0)).cast("long").alias("n"))


@query(
    """with r as (select run_id, max(captured_at) as finished_at, count(distinct room_id) as rooms, count(distinct property_url) as properties from price_observations group by 1)
    select run_id, datediff('day', finished_at::date, date '2031-06-30')::int as age_days, datediff('day', finished_at::date, date '2031-06-30') > 7 as stale from r where rooms > 0 and properties > 0 order by finished_at desc, run_id desc limit 1"""
)
def agg25_freshness(spark, folder):
    from datetime import date

    runs_of = table(spark, folder, "price_observations").groupBy("run_id").agg(
        F.max("captured_at").alias("finished_at"), F.create_map(F.lit("room_inventory"), F.count_distinct("room_id"), F.lit("property_features"), F.count_distinct("property_url")).alias("artifact_counts")
    )
    return runs.freshness(runs_of.withColumn("status", F.lit("completed")), date(2031, 6, 30))


@query()
def ml05_folds(spark, folder):
    d = table(spark, folder, "price_observations").select(canonical_url("property_url").alias("property_url"))
    folds = models.group_folds(d, "property_url", 5)
    return d.join(folds, "property_url").groupBy("fold").agg(F.count("*").alias("rows"), F.count_distinct("property_url").alias("groups"))


# --- points in regions


_REGIONS = {"north": [(34.0, 19.0), (48.0, 19.0), (48.0, 30.0), (34.0, 30.0)], "date line": [(-40.0, 150.0), (40.0, 150.0), (40.0, -120.0), (-40.0, -120.0)], "small": [(35.4, 23.9), (35.6, 23.9), (35.6, 24.2), (35.4, 24.2)]}


@query(
    f"""with p as (select distinct latitude, longitude from price_observations where {_USABLE})
    select region, latitude, longitude from p, (values ('north'), ('date line'), ('small')) r(region)
    where case region when 'north' then latitude between 34 and 48 and longitude between 19 and 30 when 'small' then latitude between 35.4 and 35.6 and longitude between 23.9 and 24.2
      else latitude between -40 and 40 and (longitude >= 150 or longitude <= -120) end"""
)
def p2_regions(spark, folder):
    """Distinct places of the offers with the regions that hold them; one region lies over the date line."""
    d = table(spark, folder, "price_observations").select("latitude", "longitude").distinct()
    rows = [(n, [{"lat": a, "lon": b} for a, b in ring]) for n, ring in _REGIONS.items()]
    regions = spark.createDataFrame(rows, "region string, ring array<struct<lat: double, lon: double>>")
    return spatial.points_in_regions(d, "latitude", "longitude", regions, "region", "ring").select("region", "latitude", "longitude")


_TOKENS = r"""tok as (select spec_id, list_sort(list_distinct(list_filter(list_transform(list_filter(list_concat(coalesce(amenities, []), coalesce(property_facilities, [])), lambda v: v is not null),
  lambda v: lower(trim(regexp_replace(v, '[\s\p{Z}]+', ' ', 'g')))), lambda v: v <> ''))) as tokens from client_specs)"""


@query(f"with {_TOKENS} select distinct t as token, 'am_' || coalesce(nullif(left(lower(trim(regexp_replace(t, '[^0-9a-zA-Z]+', '_', 'g'), '_')), 80), ''), 'value') as feature from (select unnest(tokens) as t from tok)")
def sca08_feature_names(spark, folder):
    d = table(spark, folder, "client_specs").select(F.explode(value_set("amenities", "property_facilities")).alias("token")).distinct()
    return d.select("token", fp.feature_name("am_", "token").alias("feature"))
