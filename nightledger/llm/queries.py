"""Queries of the problems tagged llm, and the SQL that those are held against which SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nightledger.functions.text import canonical_url, compared_value, compared_values, value_set
from nightledger.llm import percentiles as pc
from nightledger.llm import leakage, linkage, set_pairs, subjects, terms, tokenizer, top_n
from nightledger.sources.tables import table

SET_THRESHOLD = 0.8
LEAST_VALUES = 5
RARE_AT_MOST = 2
COMMON_ABOVE = 0.5
DEFAULT_PEERS = 25
QUANTILES = (0.1, 0.25, 0.5, 0.75, 0.9)


def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    specs = table(spark, folder, "client_specs")
    pairs = set_pairs.similar_records(specs, "spec_id", value_set("amenities", "property_facilities"), SET_THRESHOLD, LEAST_VALUES)
    return pairs.select(F.col("id_a").alias("spec_id_a"), F.col("id_b").alias("spec_id_b"))


def p1_classes(spark: SparkSession, folder: str) -> DataFrame:
    specs = table(spark, folder, "client_specs")
    d = set_pairs.classes_with_links(specs, "spec_id", value_set("amenities", "property_facilities"), SET_THRESHOLD, LEAST_VALUES)
    return d.select(F.col("id").alias("spec_id"), "set_id", "links")


_VALUES_SQL = r"""
values_of as (
  select spec_id, lower(trim(regexp_replace(v, '[\s\p{Z}\x0b\x{0085}]+', ' ', 'g'))) as token
  from (select spec_id, unnest(list_concat(coalesce(amenities, []), coalesce(property_facilities, []))) as v from client_specs)
  where v is not null
), kept as (select * from values_of where token <> '')
"""

_PAIRS_SQL = (
    "with"
    + _VALUES_SQL
    + """, rows_of as (select distinct spec_id, token from kept),
sized as (select spec_id, count(*) as n from rows_of group by 1 having count(*) >= 5),
shared as (
  select a.spec_id as x, b.spec_id as y, count(*) as k from rows_of a join rows_of b on a.token = b.token and a.spec_id < b.spec_id
  where a.spec_id in (select spec_id from sized) and b.spec_id in (select spec_id from sized) group by all
), pairs as (
  select x, y from shared join sized sa on sa.spec_id = x join sized sb on sb.spec_id = y
  where k::double / (sa.n + sb.n - k) >= 0.8
)"""
)

P1_SQL = _PAIRS_SQL + " select x as spec_id_a, y as spec_id_b from pairs"

P1_CLASSES_SQL = (
    _PAIRS_SQL
    + """, sets as (
  select spec_id, md5(string_agg(token, chr(31) order by token)) as set_id from rows_of where spec_id in (select spec_id from sized) group by 1
), links as (
  select set_id, count(distinct other) as links from (
    select a.set_id, b.set_id as other from pairs join sets a on a.spec_id = x join sets b on b.spec_id = y where a.set_id <> b.set_id
    union all
    select b.set_id, a.set_id from pairs join sets a on a.spec_id = x join sets b on b.spec_id = y where a.set_id <> b.set_id
  ) group by 1
)
select s.spec_id, s.set_id, coalesce(l.links, 0) as links from sets s left join links l using (set_id)"""
)


def p6_term_counts(spark: SparkSession, folder: str) -> DataFrame:
    specs = table(spark, folder, "client_specs")
    return terms.marked_terms(specs, compared_values("amenities", "property_facilities"), RARE_AT_MOST, COMMON_ABOVE)


def p6_found(spark: SparkSession, folder: str) -> DataFrame:
    return p6_term_counts(spark, folder).where("mark is not null").select("token", "mark")


P6_COUNTS_SQL = (
    "with"
    + _VALUES_SQL
    + """, counts as (select token, count(*) as occurrences, count(distinct spec_id) as records from kept group by 1)
select token, occurrences, records,
  case when records <= 2 then 'rare' when records > 0.5 * (select count(distinct spec_id) from kept) then 'common' end as mark
from counts"""
)
P6_SQL = f"select token, mark from ({P6_COUNTS_SQL}) where mark is not null"


def p7_found(spark: SparkSession, folder: str) -> DataFrame:
    peers = table(spark, folder, "peer_candidates").select(canonical_url("property_url").alias("property_url"), canonical_url("peer_url").alias("peer_url"), "overall_similarity", "distance_km")
    peers = peers.where(F.col("overall_similarity").isNotNull() & ~F.isnan("overall_similarity"))
    configs = table(spark, folder, "benchmark_configs").where("max_peers > 0")
    last = configs.groupBy(canonical_url("property_url").alias("property_url")).agg(F.max(F.struct("config_id", "max_peers")).alias("last"))
    limits = last.select("property_url", F.col("last.max_peers").alias("max_peers"))
    best = top_n.top_n(peers, "property_url", "peer_url", [("overall_similarity", True), ("distance_km", False)], limits, "max_peers", DEFAULT_PEERS)
    return best.select("property_url", "peer_url")


P7_SQL = """
with peers as (
  select split_part(split_part(property_url, '?', 1), '#', 1) as property_url, split_part(split_part(peer_url, '?', 1), '#', 1) as peer_url,
    overall_similarity as s, case when not isnan(distance_km) then distance_km end as d
  from peer_candidates where overall_similarity is not null and not isnan(overall_similarity) and property_url is not null and peer_url is not null
), best as (
  select *, row_number() over (partition by property_url, peer_url order by s desc, d asc nulls last) as rn from peers
), ranked as (
  select property_url, peer_url, row_number() over (partition by property_url order by s desc, d asc nulls last, peer_url asc) as r from best where rn = 1
), cfg as (
  select split_part(split_part(property_url, '?', 1), '#', 1) as property_url, arg_max(max_peers, config_id) as n
  from benchmark_configs where max_peers > 0 group by 1
)
select r.property_url, r.peer_url from ranked r left join cfg using (property_url) where r.r <= coalesce(cfg.n, 25)
"""

_DIMENSIONS = ("market", "property_type")
_MEASURES = ("price_per_night", "lead_time_days", "stay_length_days")


def _daily_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Value counts of each measure by snapshot date, market and property type."""
    d = table(spark, folder, "price_observations")
    price = F.col("price_per_night")
    each = F.array(
        F.struct(F.lit(_MEASURES[0]).alias("measure"), F.when((price > 0) & ~F.isnan(price), price).alias("v")),
        *[F.struct(F.lit(m).alias("measure"), F.col(m).cast("double").alias("v")) for m in _MEASURES[1:]],
    )
    d = d.select("snapshot_date", F.coalesce("market", F.lit("(none)")).alias("market"), F.coalesce(compared_value("property_type"), F.lit("(none)")).alias("property_type"), F.inline(each))
    return pc.value_counts(d, ["snapshot_date", *_DIMENSIONS, "measure"], F.col("v"))


def _by_dimension(counts: DataFrame) -> DataFrame:
    each = F.array(*[F.struct(F.lit(x).alias("dimension"), F.col(x).alias("grp")) for x in _DIMENSIONS])
    return counts.select("snapshot_date", "measure", "value", "n", F.inline(each))


def p4_percentiles(spark: SparkSession, folder: str) -> DataFrame:
    """Over all snapshot dates: the days' tables put together."""
    group = ["dimension", "grp", "measure"]
    return pc.percentiles(pc.combine(_by_dimension(_daily_counts(spark, folder)), group), group, QUANTILES)


def p4_percentiles_by_date(spark: SparkSession, folder: str) -> DataFrame:
    group = ["snapshot_date", "dimension", "grp", "measure"]
    d = pc.percentiles(pc.combine(_by_dimension(_daily_counts(spark, folder)), group), group, QUANTILES)
    return d.withColumn("snapshot_date", F.date_format("snapshot_date", "yyyy-MM-dd"))


def _p4_sql(extra: str) -> str:
    return f"""
with offers as (
  select strftime(snapshot_date, '%Y-%m-%d') as snapshot_date, coalesce(market, '(none)') as market,
    coalesce(nullif(lower(trim(regexp_replace(property_type, '[\\s\\p{{Z}}]+', ' ', 'g'))), ''), '(none)') as property_type,
    case when price_per_night > 0 and not isnan(price_per_night) then price_per_night end as price_per_night,
    lead_time_days::double as lead_time_days, stay_length_days::double as stay_length_days
  from price_observations
), long_rows as (
  select {extra} d.dimension, case d.dimension when 'market' then market else property_type end as grp, m.measure,
    case m.measure when 'price_per_night' then price_per_night when 'lead_time_days' then lead_time_days else stay_length_days end as value
  from offers, (values ('market'), ('property_type')) d(dimension),
    (values ('price_per_night'), ('lead_time_days'), ('stay_length_days')) m(measure)
), ranked as (
  select *, row_number() over (partition by {extra} dimension, grp, measure order by value) as r,
    count(*) over (partition by {extra} dimension, grp, measure) as n
  from long_rows where value is not null
)
select {extra} dimension, grp, measure, q.q, value, n
from ranked join (values (0.1::double), (0.25::double), (0.5::double), (0.75::double), (0.9::double)) q(q)
  on r = greatest(ceil(n * q.q - 1e-9), 1)
"""


def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    linker = linkage.link_batches(table(spark, folder, "price_observations"), "run_id")
    linker.forget()
    return linker.repeats().select(F.col("id").alias("observation_id"))


_P3_KEYED = """keyed as (
  select observation_id as id, snapshot_date, split_part(split_part(property_url, '?', 1), '#', 1) as u, checkin, checkout, adults, children,
    rooms, currency, market, ltrim(case when room_id is not null then regexp_replace(room_id, '[^0-9]', '', 'g')
      else regexp_extract(block_id, '[0-9]+') end, '0') as room, regexp_replace(block_id, '[^0-9]', '', 'g') as code
  from price_observations
), pairs as (
  select a.id as later, b.id as earlier from keyed a join keyed b
    on a.snapshot_date = b.snapshot_date and a.u = b.u and a.checkin = b.checkin and a.checkout = b.checkout and a.adults = b.adults
    and a.children = b.children and a.rooms = b.rooms and a.currency = b.currency and a.market = b.market and a.room = b.room and b.id < a.id
  where levenshtein(a.code, b.code) <= 2
)"""
P3_SQL = f"with {_P3_KEYED} select distinct later as observation_id from pairs"

P3_CLUSTERS_SQL = f"""with recursive {_P3_KEYED}, edges as (
  select later as x, earlier as y from pairs union select earlier, later from pairs
), reached as (
  select observation_id as id, observation_id as other from price_observations
  union select r.id, e.y from reached r join edges e on e.x = r.other
)
select id as observation_id, min(other) as representative from reached group by 1"""


def p3_clusters(spark: SparkSession, folder: str) -> DataFrame:
    """Every observation with the first one of its cluster."""
    linker = linkage.link_batches(table(spark, folder, "price_observations"), "run_id")
    return linker.clusters().select(F.col("id").alias("observation_id"), "representative")


def p3_scores(spark: SparkSession, folder: str) -> DataFrame:
    """Links between codes with what the weights learned from all batches say of them."""
    linker = linkage.link_batches(table(spark, folder, "price_observations"), "run_id")
    d = linker.scored_links().withColumn("match", F.col("score") >= 0)
    return d.select(F.col("id").alias("observation_id"), F.col("other").alias("earlier_id"), "edits", F.round("score", 6).alias("score"), F.round("probability", 6).alias("probability"), "match")


def p8_ids(spark: SparkSession, folder: str) -> DataFrame:
    return tokenizer.encode_column(table(spark, folder, "documents"), "doc_id", "text")


def p9_passages(spark: SparkSession, folder: str) -> DataFrame:
    return leakage.leaks(table(spark, folder, "documents"), "doc_id", "text", table(spark, folder, "eval_items"), "item_id", "text")


# words as the problem has them: NFC, five characters left out, lower case, runs of letters and digits
_WORDS_SQL = "regexp_extract_all(lower(regexp_replace(nfc_normalize(text), '[\\x{00AD}\\x{200B}-\\x{200D}\\x{FEFF}]', '', 'g')), '[\\p{L}\\p{N}]+')"

P9_SQL = f"""
with docs as (select doc_id, {_WORDS_SQL} as ws from documents where text is not null),
items as (select item_id, {_WORDS_SQL} as ws from eval_items where text is not null and item_id is not null),
sizes as (select distinct least(len(ws), 12) as size from items where len(ws) > 0),
of_items as (select distinct item_id, least(len(ws), 12) as size, array_to_string(ws[k:k + least(len(ws), 12) - 1], ' ') as passage
  from (select *, unnest(range(1, greatest(len(ws) - 11, 1) + 1)) as k from items where len(ws) > 0)),
of_docs as (select doc_id, size, array_to_string(ws[k:k + size - 1], ' ') as passage
  from (select doc_id, ws, size, unnest(range(1, len(ws) - size + 2)) as k from docs, sizes where len(ws) >= size))
select distinct doc_id, item_id from of_docs join of_items using (size, passage)
"""


def p9_found(spark: SparkSession, folder: str) -> DataFrame:
    return p9_passages(spark, folder).select("doc_id", "item_id").distinct()


def p10_shares(spark: SparkSession, folder: str) -> DataFrame:
    docs, areas, labels = (table(spark, folder, n) for n in ("documents", "subject_areas", "subject_labels"))
    return subjects.subjects(docs, "doc_id", "text", areas, labels, "doc_id", "subject")


def p10_found(spark: SparkSession, folder: str) -> DataFrame:
    return p10_shares(spark, folder).select("doc_id", "subject").distinct()


QUERIES = {
    "p1_found": p1_found,
    "p1_classes": p1_classes,
    "p3_found": p3_found,
    "p3_clusters": p3_clusters,
    "p3_scores": p3_scores,
    "p4_percentiles": p4_percentiles,
    "p4_percentiles_by_date": p4_percentiles_by_date,
    "p6_found": p6_found,
    "p6_term_counts": p6_term_counts,
    "p7_found": p7_found,
    "p8_ids": p8_ids,
    "p9_found": p9_found,
    "p9_passages": p9_passages,
    "p10_found": p10_found,
    "p10_shares": p10_shares,
}
SQL = {
    "p1_found": P1_SQL,
    "p1_classes": P1_CLASSES_SQL,
    "p3_found": P3_SQL,
    "p3_clusters": P3_CLUSTERS_SQL,
    "p4_percentiles": _p4_sql(""),
    "p4_percentiles_by_date": _p4_sql("snapshot_date,"),
    "p6_found": P6_SQL,
    "p6_term_counts": P6_COUNTS_SQL,
    "p7_found": P7_SQL,
    "p9_found": P9_SQL,
}
