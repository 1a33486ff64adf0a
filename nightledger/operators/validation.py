"""Contracts of tables and checks of delivered runs: issues as rows, and errors for what must not pass."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from nightledger.session import list_names

# The columns of each table, the files of a run, and what counts as equal a night.
SNAPSHOT_COLUMNS = ("snapshot_date", "captured_at", "run_id", "property_url", "property_name")
SEARCH_COLUMNS = ("checkin", "checkout", "lead_time_days", "stay_length_days", "adults", "children", "rooms", "currency", "market")
PLACE_COLUMNS = ("property_type", "latitude", "longitude")
OBSERVATION_COLUMNS = (*SNAPSHOT_COLUMNS, "room_id", "room_name", "block_id", *SEARCH_COLUMNS, "price_per_night", "current_price_value", *PLACE_COLUMNS)
PRESENCE_COLUMNS = (*SNAPSHOT_COLUMNS, *SEARCH_COLUMNS, *PLACE_COLUMNS, "availability_status", "failure_reason")
MODELLING_COLUMNS = ("property_name", "property_url", "checkin", "checkout", "lead_time_days", "stay_length_days", "block_id", "current_price_value", "price_per_night", *PLACE_COLUMNS)
COVARIATE_COLUMNS = ("date", "checkin", "market")
RUN_FILES = ("room_inventory.jsonl", "price_rows.jsonl", "failures.jsonl", "scrape_debug.log")
STATUSES = ("available", "no_available_offer", "scrape_failed")
NIGHTLY_TOLERANCE = 0.01


@dataclass(frozen=True)
class Rule:
    """A check that a row fails where ``fails`` is true (null counts as passed)."""

    check: str
    fails: Column
    message: str


def blank(c: str) -> Column:
    return F.coalesce(F.trim(F.col(c).cast("string")), F.lit("")) == ""


def issues(rows: DataFrame, rules: Sequence[Rule], location: Column) -> DataFrame:
    """(check, message, location) for every failed rule of every row, all rules in one pass."""
    found = F.array_compact(F.array(*[F.when(r.fails, F.struct(F.lit(r.check).alias("check"), F.lit(r.message).alias("message"))) for r in rules]))
    return rows.select(location.cast("string").alias("location"), F.inline(found)).select("check", "message", "location")


def duplicate_issues(rows: DataFrame, key: Sequence[str], check: str) -> DataFrame:
    """One issue for each key that occurs more than once."""
    many = rows.groupBy(*key).agg(F.count("*").alias("n")).where("n > 1")
    return many.select(F.lit(check).alias("check"), F.concat(F.lit("occurs "), F.col("n"), F.lit(" times")).alias("message"), F.concat_ws("|", *key).alias("location"))


def repeat_issues(rows: DataFrame, key: Sequence[str], order: str, check: str, message: str) -> DataFrame:
    """An issue for each row but the first of its key by ``order``; blank and null keys don't count."""
    d = rows.where(reduce(lambda a, b: a & b, [~blank(k) for k in key])).select(order, *key)
    first = d.groupBy(*key).agg(F.min(order).alias("first_"))
    return d.join(first, list(key)).where(F.col(order) > F.col("first_")).select(F.lit(check).alias("check"), F.lit(message).alias("message"), F.col(order).cast("string").alias("location"))


def issue_counts(found: DataFrame) -> DataFrame:
    return found.groupBy("check").agg(F.count("*").alias("issues"))


def run_report(found: DataFrame, run: Column | None = None) -> DataFrame:
    """One row (a run, if its column is given): issues, checks that failed, and whether the run is valid."""
    aggs = (F.count("check").alias("issues"), F.count_distinct("check").alias("failed_checks"), (F.count("check") == 0).alias("valid"))
    return found.groupBy(run.alias("run_id")).agg(*aggs) if run is not None else found.agg(*aggs)


def file_issues(spark: SparkSession, folder: str, required: Sequence[str] = RUN_FILES) -> DataFrame:
    """An issue for each file that a run's folder lacks."""
    there = set(list_names(spark, folder))
    gone = [("required_files", f"required file is missing: {f}", f"{folder}/{f}") for f in required if f not in there]
    return spark.createDataFrame(gone, "check string, message string, location string")


def inventory_issues(rows: DataFrame, order: str) -> DataFrame:
    """Room inventory: both room columns there, no room of a property listed twice."""
    rules = [Rule("room_inventory_fields", blank(c), f"{c} is missing") for c in ("room_id", "room_name")]
    return issues(rows, rules, F.col(order)).unionByName(repeat_issues(rows, ["property_url", "room_id"], order, "room_inventory_duplicates", "the room is listed before"))


def price_row_rules(price_text: Column | None = None) -> list[Rule]:
    """What every captured price row must meet. ``price_text`` is the text that the price was read from, if there is one."""
    price, nightly, nights = F.col("current_price_value"), F.col("price_per_night"), F.col("stay_length_days")
    expected = F.when(nights > 0, F.round(F.try_divide(price, nights), 2))
    close = F.greatest(F.lit(NIGHTLY_TOLERANCE), 1e-9 * F.greatest(F.abs(nightly), F.abs(expected)))
    shown = F.lit(True) if price_text is None else F.coalesce(F.trim(price_text), F.lit("")) != ""
    return [
        *[Rule("price_row_fields", blank(c), f"{c} is missing") for c in ("checkin", "checkout", "stay_length_days", "captured_at")],
        Rule("price_row_room_identity", blank("room_id") & blank("room_name"), "there is neither room_id nor room_name"),
        Rule("price_row_positive_price", shown & ~F.isnan(price) & (price <= 0), "current_price_value isn't positive"),
        Rule("price_per_night_consistency", ~F.isnan(price) & ~F.isnan(nightly) & (F.abs(nightly - expected) > close), "price_per_night isn't the total a night"),
    ]


def _outside(c: str, low: float, high: float | None, low_counts: bool = True) -> Rule:
    """Null and NaN are missing, not outside."""
    v = F.col(c)
    bad = (v < low) if low_counts else (v <= low)
    if high is not None:
        bad = bad | (v > high)
    return Rule("bounds", ~F.isnan(v.cast("double")) & bad, f"{c} is out of its bounds")


def _renamed(rules: Sequence[Rule], check: str) -> list[Rule]:
    return [Rule(check, r.fails, r.message) for r in rules]


def room_feature_issues(rows: DataFrame, order: str) -> DataFrame:
    """Room features: a room id, each room of a property once, sane sizes. Columns that aren't there aren't checked."""
    bounds = [r for c, r in {"room_size_sqm": _outside("room_size_sqm", 0, 1000, False), "max_persons": _outside("max_persons", 1, 30), "bed_count": _outside("bed_count", 0, None)}.items() if c in rows.columns]
    rules = [Rule("room_feature_room_id", blank("room_id"), "room_id is missing"), *_renamed(bounds, "room_feature_bounds")]
    return issues(rows, rules, F.col(order)).unionByName(repeat_issues(rows, ["property_url", "room_id"], order, "room_feature_duplicates", "the room is described before"))


def property_feature_issues(rows: DataFrame, order: str) -> DataFrame:
    """Property features: an address, each once; stars, scores, counts and distances within their scales."""
    bounds = {"star_rating": _outside("star_rating", 0, 5, False), "review_score": _outside("review_score", 0, 10), "review_count": _outside("review_count", 0, None), "photo_count": _outside("photo_count", 0, None)}
    rules = [Rule("property_feature_property_url", blank("property_url"), "property_url is missing"), *_renamed([r for c, r in bounds.items() if c in rows.columns], "property_feature_bounds")]
    out = issues(rows, rules, F.col(order)).unionByName(repeat_issues(rows, ["property_url"], order, "property_feature_duplicates", "the property is described before"))
    nested = []  # one issue for each subscore and distance
    if "review_subscores" in rows.columns:
        nested.append(("a review subscore is outside 0 to 10", F.explode(F.map_values("review_subscores")), lambda v: (v < 0) | (v > 10)))
    if "nearby_poi" in rows.columns:
        nested.append(("a distance is negative", F.explode("nearby_poi.distance"), lambda v: v < 0))
    for message, each, bad in nested:
        d = rows.select(F.col(order).cast("string").alias("location"), each.alias("v")).where(bad(F.col("v")) & ~F.isnan(F.col("v").cast("double")))
        out = out.unionByName(d.select(F.lit("property_feature_bounds").alias("check"), F.lit(message).alias("message"), "location"))
    return out


def failure_issues(rows: DataFrame, files: DataFrame, order: str) -> DataFrame:
    """Failures: a category, and the page file it names must be among ``files`` (column ``name``)."""
    named = rows.where(~blank("snapshot_filename")).join(files.select(F.col("name").alias("snapshot_filename")).distinct(), "snapshot_filename", "left_anti")
    gone = named.select(F.lit("failure_snapshot_exists").alias("check"), F.lit("the page file doesn't exist").alias("message"), F.col(order).cast("string").alias("location"))
    return issues(rows, [Rule("failure_category", blank("category"), "category is missing")], F.col(order)).unionByName(gone)


class ContractError(ValueError):
    pass


@dataclass(frozen=True)
class Contract:
    """Columns that must be there, those without nulls, those without blanks, and rules over whole rows."""

    columns: tuple[str, ...]
    not_null: tuple[str, ...] = ()
    not_blank: tuple[str, ...] = ()
    rules: tuple[Rule, ...] = ()

    def checks(self) -> list[tuple[str, Column]]:
        return [
            *[(f"{c} has nulls", F.col(c).isNull()) for c in self.not_null],
            *[(f"{c} has blanks", F.trim(F.col(c).cast("string")) == "") for c in self.not_blank],
            *[(r.message, r.fails) for r in self.rules],
        ]


def _search_rules() -> tuple[Rule, ...]:
    return (
        Rule("dates", F.col("checkout") <= F.col("checkin"), "checkout isn't after checkin"),
        *[Rule("search", F.col(c) < 0, f"{c} is negative") for c in ("lead_time_days", "children")],
        *[Rule("search", F.col(c) <= 0, f"{c} isn't positive") for c in ("stay_length_days", "adults", "rooms")],
    )


def observation_contract() -> Contract:
    names = ("run_id", "property_url", "property_name", "room_id", "room_name", "block_id", "currency", "market", "property_type")
    prices = tuple(Rule("price", ~F.isnan(c) & (F.col(c) <= 0), f"{c} isn't positive") for c in ("price_per_night", "current_price_value"))
    return Contract(OBSERVATION_COLUMNS, tuple(c for c in OBSERVATION_COLUMNS if c not in ("latitude", "longitude")), names, (*_search_rules(), *prices))


def presence_contract() -> Contract:
    names = ("run_id", "property_url", "property_name", "currency", "market", "property_type", "availability_status")
    status = Rule("status", ~F.col("availability_status").isin(*STATUSES), "availability_status is unknown")
    return Contract(PRESENCE_COLUMNS, tuple(c for c in PRESENCE_COLUMNS if c not in ("latitude", "longitude", "failure_reason")), names, (*_search_rules(), status))


def modelling_contract() -> Contract:
    return Contract(MODELLING_COLUMNS, MODELLING_COLUMNS[:9], (), ())


def covariate_contract() -> Contract:
    return Contract(COVARIATE_COLUMNS, COVARIATE_COLUMNS, ("market",), ())


def violations(rows: DataFrame, contract: Contract) -> DataFrame:
    """(violation, rows) of each check that some row fails, in one pass; missing columns are an error."""
    _columns_there(rows, contract.columns)
    checks = contract.checks()
    if not checks:
        return rows.sparkSession.createDataFrame([], "violation string, rows long")
    one = rows.agg(*[F.count_if(f).alias(f"x{i}") for i, (_, f) in enumerate(checks)])
    each = F.array(*[F.struct(F.lit(m).alias("violation"), F.col(f"x{i}").alias("rows")) for i, (m, _) in enumerate(checks)])
    return one.select(F.inline(each)).where("rows > 0")


def _columns_there(rows: DataFrame, columns: Sequence[str]) -> None:
    absent = [c for c in columns if c not in rows.columns]
    if absent:
        raise ContractError(f"columns are missing: {', '.join(absent)}")


def enforce(rows: DataFrame, contract: Contract, allow_empty: bool = True) -> DataFrame:
    """The rows, if they meet the contract; else an error that names what is broken."""
    broken = violations(rows, contract).collect()
    if broken:
        raise ContractError("; ".join(f"{r['violation']}: {r['rows']} rows" for r in broken))
    if not allow_empty and rows.isEmpty():
        raise ContractError("the table is empty")
    return rows


def require(rows: DataFrame, columns: Sequence[str], not_null: Sequence[str] = (), rules: Sequence[Rule] = (), allow_empty: bool = True) -> DataFrame:
    return enforce(rows, Contract(tuple(columns), tuple(not_null), (), tuple(rules)), allow_empty)
