"""Column builders for offers: prices, rooms, stays, conditions, amenities."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from nightledger.functions.text import col_of, collapse_space

# Labels, phrases and thresholds that results depend on.
SELF_CATERING = ("Apartment", "Aparthotel", "Holiday home", "Villa")
GUEST_HOUSE = "Guest house"
MEAL_PLANS = (("all_inclusive", 4, ("all inclusive", "all-inclusive")), ("full_board", 3, ("full board",)), ("half_board", 2, ("half board",)), ("breakfast", 1, ("breakfast",)))
QUALITY_PHRASES = {
    "pool": ("pool",),
    "sea_view": ("sea view", "ocean view"),
    "beachfront": ("beachfront", "private beach"),
    "balcony_or_terrace": ("balcony", "terrace", "patio"),
    "parking": ("parking",),
    "kitchen": ("kitchen", "kitchenette"),
    "washing_machine": ("washing machine",),
    "private_entrance": ("private entrance",),
    "air_conditioning": ("air conditioning", "air conditioner"),
    "hot_tub": ("hot tub", "jacuzzi"),
    "garden": ("garden",),
}
SEASON_MONTHS = {"peak": (7, 8), "shoulder": (5, 6, 9, 10)}
STATUS_PRIORITY = ("available", "no_available_offer", "scrape_failed")


def in_segment(c: str | Column, include_guest_house: bool = False) -> Column:
    """Whether a property type, blanks at its ends aside, is a self-catering one; null isn't."""
    labels = [*SELF_CATERING, *([GUEST_HOUSE] if include_guest_house else [])]
    return F.coalesce(F.trim(col_of(c)).isin(labels), F.lit(False))


def valid_price(c: str | Column) -> Column:
    """The price if it's positive and a number, else null."""
    c = col_of(c)
    return F.when((c > 0) & ~F.isnan(c), c)


def parse_price(c: str | Column) -> Column:
    """A localised price text as a number.

    Of two kinds of separators the rightmost is the decimal one. A single kind groups thousands if three
    characters follow each of its occurrences, else it is the decimal separator. What then is no number, such
    as text with two decimal separators or without digits, gives null.
    """
    clean = F.regexp_replace(col_of(c), r"[^0-9,.\-]", "")

    def number(t: Column) -> Column:
        grouped = t.rlike(r"^[^,.]*(?:(?:,[^,.]{3})+|(?:\.[^,.]{3})+)$")
        return F.when(grouped, F.translate(t, ",.", "")).when(t.rlike(r",[^.]*$"), F.translate(t, ",.", ".")).otherwise(F.translate(t, ",", "")).try_cast("double")

    # bound by the lambda, so that the text is cleaned once
    return F.get(F.transform(F.array(clean), number), F.lit(0))


def nightly(total: str | Column, nights: str | Column) -> Column:
    """Total a night to two digits; null without a total or a positive number of nights."""
    return F.when(col_of(nights) > 0, F.round(F.try_divide(col_of(total), col_of(nights)), 2))


def room_of_block(c: str | Column) -> Column:
    """The leading digits of a block id that an underscore follows."""
    r = F.regexp_extract(col_of(c), r"^([0-9]+)_", 1)
    return F.when(r != "", r)


def slug(c: str | Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(col_of(c)), r"[^a-z0-9]+", "_"), r"^_+|_+$", "")


def is_room_size(c: str | Column) -> Column:
    return col_of(c).rlike(r"(?i)^[0-9]+(?:[.,][0-9]+)?\s*m(?:²|2)$")


def meal_plan(c: str | Column) -> tuple[Column, Column]:
    """Label and rank of the most inclusive plan a conditions text names; room only if none."""
    text = F.lower(F.coalesce(col_of(c), F.lit("")))
    label, rank = F.lit("room_only"), F.lit(0)
    for name, n, phrases in reversed(MEAL_PLANS):
        named = reduce(lambda a, b: a | b, [text.contains(p) for p in phrases])
        label, rank = F.when(named, name).otherwise(label), F.when(named, n).otherwise(rank)
    return label, rank


def cancellation(c: str | Column) -> tuple[Column, Column, Column]:
    """Free, non-refundable, and their rank: 1, 0, or null if the text names neither."""
    text = F.lower(F.coalesce(col_of(c), F.lit("")))
    free, fixed = text.contains("free cancellation"), text.contains("non-refundable") | text.contains("non refundable")
    return free, fixed, F.when(free, 1).when(fixed, 0)


def quality_flags(tokens: str | Column) -> dict[str, Column]:
    """0/1 for each feature that any token names: one of its phrases stands in the token as whole words."""
    named = lambda phrases: F.exists(tokens, lambda t: reduce(lambda a, b: a | b, [t.rlike(rf"\b{p}\b") for p in phrases]))
    tokens = F.filter(col_of(tokens), lambda t: t.isNotNull())
    return {f"hq__{name}": F.coalesce(named(phrases), F.lit(False)).cast("int") for name, phrases in QUALITY_PHRASES.items()}


def calendar(day: str | Column) -> dict[str, Column]:
    """Month, ISO week, weekday from Monday 0, weekend and season of a date; all null without one."""
    d = col_of(day)
    month = F.month(d)
    season = F.when(month.isin(*SEASON_MONTHS["peak"]), "peak").when(month.isin(*SEASON_MONTHS["shoulder"]), "shoulder").when(month.isNotNull(), "off")
    return {"checkin_month": month, "checkin_iso_week": F.weekofyear(d), "checkin_day_of_week": F.weekday(d), "checkin_is_weekend": F.weekday(d) >= 5, "season": season}


def stay(base: str | Column, lead: str | Column, nights: str | Column) -> tuple[Column, Column]:
    checkin = F.date_add(col_of(base), col_of(lead))
    return checkin, F.date_add(checkin, col_of(nights))


def numeric_similarity(a: Column, b: Column, scale: float | None = None, missing: str = "skip") -> Column:
    """1 for equal numbers, falling to 0 at ``scale`` apart (the larger magnitude, at least 1, if none is given).

    Where either is missing the result is null (``skip``) or 0 (``zero``).
    """
    a, b = F.when(~F.isnan(a), a), F.when(~F.isnan(b), b)
    by = F.lit(float(scale)) if scale else F.greatest(F.abs(a), F.abs(b), F.lit(1.0))
    s = F.when(a.isNotNull() & b.isNotNull(), F.greatest(F.lit(0.0), 1 - F.least(F.abs(a - b) / by, F.lit(1.0))))
    return s if missing == "skip" else F.coalesce(s, F.lit(0.0))


def set_overlap(a: Column, b: Column) -> Column:
    """Intersection over union of two arrays of distinct values; null if either is empty or null."""
    shared = F.size(F.array_intersect(a, b))
    return F.when((F.size(a) > 0) & (F.size(b) > 0), shared / (F.size(a) + F.size(b) - shared))


def weighted_mean(parts: list[tuple[float, Column]]) -> Column:
    """The mean of the parts that are there, weighted; 0 if none is."""
    zero = F.lit(0.0)
    weight = reduce(lambda s, p: s + F.when(p[1].isNotNull(), p[0]).otherwise(0.0), parts, zero)
    value = reduce(lambda s, p: s + F.coalesce(p[1] * p[0], zero), parts, zero)
    return F.when(weight > 0, value / weight).otherwise(zero)


def multi_hot(tokens: Column, vocabulary: list[str], prefix: str) -> dict[str, Column]:
    """0/1 columns for a vocabulary; two tokens whose names come out alike get numbered ones."""
    import re

    out: dict[str, Column] = {}
    for t in vocabulary:
        base = prefix + (re.sub(r"[^0-9a-z]+", "_", t.lower()).strip("_")[:80] or "value")
        name, k = base, 2
        while name in out:
            name, k = f"{base}_{k}", k + 1
        out[name] = F.coalesce(F.array_contains(tokens, t), F.lit(False)).cast("int")
    return out


def boolean_of(c: str | Column) -> Column:
    """Flag text as a boolean; null is false, anything unknown an error."""
    t = F.lower(F.trim(col_of(c).cast("string")))
    return (
        F.when(t.isNull() | t.isin("false", "f", "no", "n", "0", "0.0", ""), False)
        .when(t.isin("true", "t", "yes", "y", "1", "1.0"), True)
        .otherwise(F.raise_error(F.concat(F.lit("not a flag: "), t)).cast("boolean"))
    )


def availability_state(now: Column, before: Column) -> Column:
    """What became of an offer between two snapshots.

    Only passages between an offer and its absence are known; any other status on either side, a failed
    capture or none at all gives ``unknown``.
    """
    on, off, _ = STATUS_PRIORITY
    known = {(on, on): "available", (off, on): "newly_available", (on, off): "disappeared", (off, off): "still_unavailable"}
    state = F.lit("unknown")
    for (was, is_), name in known.items():
        state = F.when((before == was) & (now == is_), name).otherwise(state)
    return state


def clean_status(c: str | Column) -> Column:
    return F.lower(collapse_space(c))


def with_query(url: str | Column, **params: str | Column) -> Column:
    """The canonical address with the given query parameters, encoded, in the order given."""
    from nightledger.functions.text import canonical_url

    pairs = [F.concat(F.lit(f"{k}="), F.url_encode(col_of(v).cast("string") if isinstance(v, Column) else F.lit(str(v)))) for k, v in params.items()]
    return F.concat(canonical_url(url), F.lit("?"), F.concat_ws("&", *pairs))
