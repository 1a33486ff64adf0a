"""Column builders for captured pages: why a page gave nothing, and labels for reports."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from nightledger.functions.text import col_of

# Phrases that tell what a page is, and statuses that stand for a block.
BLOCKED_STATUSES = (202, 403, 429)
BLOCKED = ("captcha", "security check", "verify you are human", "verify you're human", "access denied", "unusual traffic", "are you a human", "bot detection", "px-captcha", "cf-chl")
EMPTY = (
    "no availability", "not available for your dates", "not available on our site", "sold out", "fully booked", "change your dates", "try different dates", "no rooms available",
    "we're sorry, but it is not possible", "isn't taking reservations", "not taking reservations", "not possible to make reservations",
)
TEMPORARY = ("temporarily unavailable", "temporary error", "technical issue", "server error", "service unavailable", "bad gateway", "gateway timeout")
PROPERTY = ("booking.com", "property highlights", "availability", "room type", "select rooms", "guest reviews", "facilities", "hprt-table", "hp_availability", "availability_target")
LEAST_TEXT = 500
PERCENTILE_BANDS = (
    (">=", 90, "at the very top of"), (">=", 75, "well above the middle of"), (">=", 55, "above the middle of"), (">", 45, "around the middle of"),
    (">", 25, "below the middle of"), (">", 10, "well below the middle of"),
)
NO_BAND, LAST_BAND = "an unclear position relative to", "at the very bottom of"


def page_text(shown: str | Column) -> Column:
    """Text of a page as it is compared: lower case, straight apostrophes, white space collapsed; null is empty."""
    t = F.translate(F.coalesce(col_of(shown), F.lit("")), "’‘", "''")
    return F.lower(F.trim(F.regexp_replace(t, r"(?U)\s+", " ")))


def names_any(text: Column, phrases: tuple[str, ...]) -> Column:
    return reduce(lambda a, b: a | b, [text.contains(p) for p in phrases])


def host_and_path(url: Column) -> Column:
    """Host in lower case and path without slashes at its end: what tells a redirect."""
    rest = F.regexp_replace(url, r"^[A-Za-z][A-Za-z0-9+.\-]*:", "")
    host = F.lower(F.regexp_extract(rest, r"^//([^/?#]*)", 1))
    path = F.rtrim(F.regexp_extract(F.regexp_replace(rest, r"^//[^/?#]*", ""), r"^([^?#]*)", 1), F.lit("/"))
    return F.concat(host, F.lit(" "), path)


def page_failure(text: Column, final_url: Column, requested_url: Column, expected: Column, fallback: Column, status: Column) -> Column:
    """The category of a page on which nothing was found; null for one on which the expected selector was.

    ``text`` is ``page_text``. A challenge goes before all else, then the status, a redirect, an empty offer, a
    temporary error, too little text; what is left is a page whose layout changed, or a part of one.
    """
    blocked = names_any(text, BLOCKED) | F.coalesce(status.isin(*BLOCKED_STATUSES), F.lit(False))
    moved = final_url.isNotNull() & (host_and_path(final_url) != host_and_path(requested_url))
    partial = (F.length(text) < LEAST_TEXT) | (text.contains("<html") & ~text.contains("</html>"))
    return (
        F.when(expected > 0, F.lit(None).cast("string"))
        .when(blocked, "blocked_challenge")
        .when(status >= 500, "temporary_booking_error")
        .when(moved, "redirect")
        .when(names_any(text, EMPTY), "empty_availability")
        .when(names_any(text, TEMPORARY), "temporary_booking_error")
        .when(partial, "partial_load")
        .when((fallback > 0) | names_any(text, PROPERTY), "selector_drift")
        .otherwise("partial_load")
    )


def percentile_band(percentile: Column) -> Column:
    """Where a percentile stands, in words."""
    out = F.when(percentile.isNull(), NO_BAND)
    for op, bound, words in PERCENTILE_BANDS:
        out = out.when(percentile >= bound if op == ">=" else percentile > bound, words)
    return out.otherwise(LAST_BAND)


def position_class(residual: Column) -> Column:
    """How a price stands to that of like offers, by its excess as a share of theirs."""
    return (
        F.when(residual.isNull(), "insufficient").when(residual > 0.15, "unjustified_premium").when(residual > 0.05, "mixed_premium")
        .when(residual >= -0.05, "fair").otherwise("underpriced")
    )


def feature_name(prefix: str, token: str | Column) -> Column:
    """A token as a column name: letters and digits, at most 80 characters."""
    t = F.lower(F.regexp_replace(F.regexp_replace(col_of(token), "[^0-9a-zA-Z]+", "_"), "^_+|_+$", ""))
    return F.concat(F.lit(prefix), F.when(t == "", "value").otherwise(F.substring(t, 1, 80)))
