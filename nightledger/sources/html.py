"""Rows from captured pages. Markup in the wild is broken, so the standard library's tolerant parser reads it.

A page becomes a list of events, one for each tag and piece of text, and everything here is read off that list.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from html.parser import HTMLParser

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nightledger.functions import page_features
from nightledger.functions.offers import room_of_block
from nightledger.session import ship_package

# What marks a listing's card and its parts, an offer's row and its parts, a room's link.
CARD = ("data-testid", "property-card")
CARD_PARTS = {"name": ("data-testid", "title"), "price_text": ("data-testid", "price-and-discounted-price"), "review_score_text": ("data-testid", "review-score"), "recommended_unit_text": ("data-testid", "recommended-units")}
OFFER_ROW, ROOM_CELL, ROOM_LINK = "js-rt-block-row", "hprt-table-cell-roomtype", "hprt-roomtype-link"
OFFER_PARTS = {
    "current_price_text": "bui-price-display__value", "original_price_text": "bui-price-display__original",
    "occupancy_text": "hprt-table-cell-occupancy", "conditions_text": "hprt-table-cell-conditions", "scarcity_text": "only_x_left",
}
ROOM_FACILITY, BED_TYPE = "hprt-facilities-facility", "rt-bed-type"
RATINGS = ("rating-stars", "rating-squares", "rating-circles")
PHOTOS = ("gallery-cta-count", "PropertyGalleryGridButton")
_GROUPS = "array<struct<heading: string, items: array<string>>>"
PROPERTY_TEXTS = (
    f"rating_labels array<string>, review_badge string, subscores array<string>, place string, breadcrumb string, facility_groups {_GROUPS}, poi_blocks {_GROUPS}, "
    "sections array<string>, photo_texts array<string>, sustainability string"
)
_HIDDEN = re.compile(r"(?is)<(script|style|noscript)\b.*?(?:</\1\s*>|\Z)")
_ROOM = re.compile(r"#RD([0-9]+)")
_HOTEL = re.compile(r"(?i)/hotel/[a-z]{2}/[^/]+\.html$")
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}


class _Reader(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.events: list[tuple[str, str, dict]] = []

    def handle_starttag(self, tag, attrs):
        self.events.append(("open", tag, dict(attrs)))

    def handle_endtag(self, tag):
        self.events.append(("close", tag, {}))

    def handle_data(self, data):
        self.events.append(("text", data, {}))


def events(html: str | None) -> list[tuple[str, str, dict]]:
    """(open, tag, attributes), (close, tag, -) and (text, data, -), scripts and styles left out."""
    reader = _Reader()
    reader.feed(_HIDDEN.sub(" ", html or ""))
    reader.close()
    return reader.events


def _clean(parts: list[str]) -> str | None:
    return " ".join(" ".join(parts).split()) or None


def text_of(html: str | None) -> str | None:
    """What a page shows, or where it shows nothing its source: lower case, white space collapsed, straight apostrophes."""
    if html is None:
        return None
    shown = _clean([data for kind, data, _ in events(html) if kind == "text"]) or html
    return " ".join(shown.replace("’", "'").replace("‘", "'").split()).lower()


def _element(evs: list, at: int) -> list:
    """The events from an opening tag to the one that closes it, or to the end."""
    tag = evs[at][1]
    if tag in _VOID:
        return evs[at : at + 1]
    depth = 0
    for k in range(at, len(evs)):
        if evs[k][1] == tag and evs[k][0] != "text":
            depth += 1 if evs[k][0] == "open" else -1
            if depth == 0:
                return evs[at : k + 1]
    return evs[at:]


def _first(evs: list, wanted: Callable[[str, dict], bool]) -> list | None:
    at = next((k for k, (kind, tag, attrs) in enumerate(evs) if kind == "open" and wanted(tag, attrs)), None)
    return None if at is None else _element(evs, at)


def _shown(evs: list | None) -> str | None:
    return None if evs is None else _clean([data for kind, data, _ in evs if kind == "text"])


def _classed(name: str) -> Callable[[str, dict], bool]:
    return lambda tag, attrs: name in (attrs.get("class") or "").split()


def links_of(html: str | None) -> list[tuple[str, str]]:
    """(href, text) of each closed link, in order."""
    evs = events(html)
    out = []
    for k, (kind, tag, attrs) in enumerate(evs):
        if kind == "open" and tag == "a" and attrs.get("href"):
            whole = _element(evs, k)
            if whole[-1][0] == "close":
                out.append((attrs["href"], " ".join("".join(d for kind, d, _ in whole if kind == "text").split())))
    return out


def listings_of(html: str | None) -> list[tuple]:
    """(name, url, price_text, review_score_text, recommended_unit_text) of each card with a name and a hotel's address, the first of each address."""
    evs = events(html)
    seen: dict[str, tuple] = {}
    for k, (kind, _, attrs) in enumerate(evs):
        if kind != "open" or attrs.get(CARD[0]) != CARD[1]:
            continue
        card = _element(evs, k)
        hrefs = [a["href"] for kind, tag, a in card if kind == "open" and tag == "a" and a.get("href") and a.get("data-testid") == "title-link"]
        hrefs += [a["href"] for kind, tag, a in card if kind == "open" and tag == "a" and "/hotel/" in (a.get("href") or "")]
        url = re.split("[?#]", hrefs[0].strip(), maxsplit=1)[0] if hrefs else ""
        parts = {name: _shown(_first(card, lambda tag, a, m=mark: a.get(m[0]) == m[1])) for name, mark in CARD_PARTS.items()}
        if parts["name"] and _HOTEL.search(url):
            seen.setdefault(url, (parts.pop("name"), url, *parts.values()))
    return list(seen.values())


def offers_of(html: str | None) -> list[tuple]:
    """(room_id, room_name, block_id, texts of ``OFFER_PARTS``, quantity options) of each offer's row.

    A row without a room's cell belongs to the room of the last row that had one.
    """
    evs = events(html)
    out = []
    room = (None, None, None)
    for k, (kind, tag, attrs) in enumerate(evs):
        if kind != "open" or tag != "tr" or not _classed(OFFER_ROW)(tag, attrs):
            continue
        row = _element(evs, k)
        cell = _first(row, lambda tag, a: tag == "th" and _classed(ROOM_CELL)(tag, a))
        if cell is not None:
            link = _first(cell, _classed(ROOM_LINK))
            room = (link[0][2].get("data-room-id") if link else None, _shown(link), _shown(_first(cell, _classed(OFFER_PARTS["scarcity_text"]))))
        texts = [_shown(_first(row, _classed(c))) for name, c in OFFER_PARTS.items() if name != "scarcity_text"]
        options = [t for j, (kind, tag, _) in enumerate(row) if kind == "open" and tag == "option" and (t := _shown(_element(row, j)))]
        out.append((room[0], room[1], attrs.get("data-block-id"), *texts, room[2], options))
    return out


def _all_shown(evs: list, wanted: Callable[[str, dict], bool]) -> list[str]:
    return [t for k, (kind, tag, attrs) in enumerate(evs) if kind == "open" and wanted(tag, attrs) and (t := _shown(_element(evs, k)))]


def _marked(mark: str) -> Callable[[str, dict], bool]:
    return lambda tag, attrs: attrs.get("data-testid") == mark


def rooms_of(html: str | None) -> list[tuple]:
    """(room_id, block_id, room_name, facilities, bed_types, occupancy_text) of each offer's row that has a room's cell."""
    evs = events(html)
    out = []
    for k, (kind, tag, attrs) in enumerate(evs):
        if kind != "open" or tag != "tr" or not _classed(OFFER_ROW)(tag, attrs):
            continue
        row = _element(evs, k)
        cell = _first(row, lambda tag, a: tag == "th" and _classed(ROOM_CELL)(tag, a))
        if cell is None:
            continue
        link = _first(cell, _classed(ROOM_LINK))
        occupancy = _first(row, lambda tag, a: tag == "td" and _classed(OFFER_PARTS["occupancy_text"])(tag, a))
        out.append((link[0][2].get("data-room-id") if link else None, attrs.get("data-block-id"), _shown(link), _all_shown(cell, _classed(ROOM_FACILITY)), _all_shown(cell, _classed(BED_TYPE)), _shown(occupancy)))
    return out


def _groups(evs: list, mark: str) -> list[dict]:
    """Heading and list items of each element with the mark."""
    whole = [_element(evs, k) for k, (kind, tag, attrs) in enumerate(evs) if kind == "open" and attrs.get("data-testid") == mark]
    return [{"heading": _shown(_first(g, lambda tag, _: tag == "h3")), "items": _all_shown(g, lambda tag, _: tag == "li")} for g in whole]


def property_of(html: str | None) -> list[tuple]:
    """The raw texts of a property's page, in the order of ``PROPERTY_TEXTS``: one row, nulls and empty lists where the page has none."""
    evs = events(html)
    opened = [attrs for kind, _, attrs in evs if kind == "open"]
    labels = [a["aria-label"] for mark in RATINGS for a in opened if a.get("data-testid") == mark and a.get("aria-label")]
    photos = [t for mark in PHOTOS for t in [*_all_shown(evs, _marked(mark)), *[a["aria-label"] for a in opened if a.get("data-testid") == mark and a.get("aria-label")]]]
    places = [a["data-atlas-latlng"] for a in opened if a.get("data-atlas-latlng")]
    one = lambda mark: _shown(_first(evs, _marked(mark)))
    return [(
        labels, one("review-score-right-component"), _all_shown(evs, _marked("review-subscore")), places[0] if places else None, one("breadcrumb-current"),
        _groups(evs, "facility-group-container"), _groups(evs, "poi-block"), _all_shown(evs, _marked("property-section--content")), photos, one("sustainability-property-badge"),
    )]


def _parsed(pages: DataFrame, page: str, html: str, rows_of: Callable[[str | None], list[tuple]], schema: str) -> DataFrame:
    """(page, position, ...): the rows of each page, numbered from 1, by Arrow batches."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    ship_package(pages.sparkSession)
    whole = f"page {pages.schema[page].dataType.simpleString()}, position int, {schema}"
    arrow = to_arrow_schema(StructType.fromDDL(whole))

    def parse(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for b in batches:
            rows = [(i, n, *r) for i, h in zip(b.column(0).to_pylist(), b.column(1).to_pylist()) for n, r in enumerate(rows_of(h), 1)]
            cols = list(zip(*rows)) if rows else [[]] * len(arrow)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, arrow)], schema=arrow)

    return pages.select(F.col(page).alias("page"), F.col(html).alias("html")).mapInArrow(parse, whole)


def visible_text(pages: DataFrame, html: str, name: str) -> DataFrame:
    """Adds the shown text of each page, by Arrow batches."""
    import pandas as pd
    from pyspark.sql.functions import pandas_udf

    def shown(col: pd.Series) -> pd.Series:
        return col.map(text_of)

    ship_package(pages.sparkSession)
    shown.__annotations__ = {"col": pd.Series, "return": pd.Series}
    return pages.withColumn(name, pandas_udf(shown, "string")(F.col(html)))


def links(pages: DataFrame, page: str, html: str) -> DataFrame:
    """(page, position, href, text): each page's links, the first of each target.

    Targets are cut before query and fragment, but those within the page (``#...``) are whole.
    """

    def rows_of(h: str | None) -> list[tuple]:
        seen: dict[str, str] = {}
        for href, text in links_of(h):
            seen.setdefault(href if href.startswith("#") else href.split("?")[0].split("#")[0], text)
        return list(seen.items())

    return _parsed(pages, page, html, rows_of, "href string, text string")


def room_inventory(pages: DataFrame, page: str, html: str) -> DataFrame:
    """(page, position, room_id, room_name): a row for each distinct ``#RD<digits>`` link of a page.

    The first link of a room that shows a name counts; links without any are left out.
    """

    def rows_of(h: str | None) -> list[tuple]:
        seen: dict[str, str] = {}
        for href, text in links_of(h):
            if text and (m := _ROOM.match(href)):
                seen.setdefault(m[1], text)
        return list(seen.items())

    return _parsed(pages, page, html, rows_of, "room_id string, room_name string")


def listings(pages: DataFrame, page: str, html: str) -> DataFrame:
    """(page, position, name, url, price_text, review_score_text, recommended_unit_text): the cards of results pages."""
    return _parsed(pages, page, html, listings_of, "name string, url string, price_text string, review_score_text string, recommended_unit_text string")


def price_rows(pages: DataFrame, page: str, html: str) -> DataFrame:
    """(page, position, room_id, room_name, block_id, texts, quantity_options): the offers of property pages.

    Where no room's cell gave a room id, the block id's leading digits do.
    """
    names = [n for n in OFFER_PARTS if n != "scarcity_text"] + ["scarcity_text"]
    d = _parsed(pages, page, html, offers_of, f"room_id string, room_name string, block_id string, {', '.join(f'{n} string' for n in names)}, quantity_options array<string>")
    return d.withColumn("room_id", F.coalesce("room_id", room_of_block("block_id")))


def room_features(pages: DataFrame, page: str, html: str) -> DataFrame:
    """(page, room_id, features): each room of a page once, by its first header; rooms without an id are left out."""
    d = _parsed(pages, page, html, rooms_of, "room_id string, block_id string, room_name string, facilities array<string>, bed_types array<string>, occupancy_text string")
    d = d.withColumn("room_id", F.coalesce("room_id", room_of_block("block_id"))).where("room_id is not null")
    first = d.groupBy("page", "room_id").agg(F.min_by(F.struct("room_name", "facilities", "bed_types", "occupancy_text"), "position").alias("r")).select("page", "room_id", "r.*")
    return first.select("page", "room_id", *[c.alias(n) for n, c in page_features.of_room().items()])


def property_features(pages: DataFrame, page: str, html: str) -> DataFrame:
    """(page, features): one row a page."""
    d = _parsed(pages, page, html, property_of, PROPERTY_TEXTS)
    return d.select("page", *[c.alias(n) for n, c in page_features.of_property().items()])
