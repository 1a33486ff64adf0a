"""Features of rooms and properties from the raw texts of their pages; what a text doesn't say is null."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Room classes, those that contain others first, and the types of property that a page may name.
ROOM_CLASSES = (
    "Junior Suite", "Presidential Suite", "Executive Suite", "Suite", "Penthouse", "Deluxe", "Superior", "Executive", "Classic", "Standard", "Economy", "Comfort", "Family", "Studio",
    "Villa", "Bungalow", "Apartment", "Maisonette", "Twin", "Double", "Single",
)
PROPERTY_TYPES = (
    "Aparthotel", "Apartment", "Bed and breakfast", "Boat", "Campsite", "Capsule hotel", "Chalet", "Country house", "Farm stay", "Guest house", "Holiday home", "Homestay", "Hostel", "Hotel",
    "Inn", "Lodge", "Luxury tent", "Motel", "Resort", "Riad", "Ryokan", "Villa",
)
LANGUAGES = "languages spoken"
# How pages word their facts.
SIZE = r"(?i)([0-9]+(?:[.,][0-9]+)?)\s*m(?:²|2)"
LEADING_NUMBER = r"^\s*([0-9]+)"
PERSONS = (r"(?i)Max persons:\s*([0-9]+)", r"(?i)Sleeps:\s*[0-9]+\s*[-–]\s*([0-9]+)", r"(?i)Sleeps:\s*([0-9]+)")
STARS = r"([0-9](?:\.[0-9])?)"
SCORE = r"([0-9]+(?:\.[0-9]+)?)"
REVIEWS = r"(?i)([0-9,]+)\s+reviews?"
SUBSCORE = r"^(.+?)\s+([0-9]+(?:\.[0-9]+)?)$"
IN_PARENTHESES = r"\(([^)]+)\)"
DISTANCE = r"(?i)^(.+?)\s+([0-9.,]+)\s*(km|m)$"
SPAN = r"\s+From\s+([0-9]{1,2}:[0-9]{2})\s+to\s+([0-9]{1,2}:[0-9]{2})"
CANCELLATION = r"Cancellation/?\s*prepayment\s+(.*?)(?:\s+(?:Children|Child|Pets|Cards|Age|Deposit|Smoking|Parties|Quiet|Internet|Parking)\b|$)"
PHOTOS = r"([0-9][0-9,]*)"


def found(text: Column, pattern: str, group: int = 1) -> Column:
    """The group of the pattern's first match, null if there is none."""
    return F.when(text.rlike(pattern), F.regexp_extract(text, pattern, group))


def _first_found(texts: Column, pattern: str) -> Column:
    return F.get(F.filter(F.transform(texts, lambda t: found(t, pattern)), lambda x: x.isNotNull()), F.lit(0))


def _some(values: Column) -> Column:
    """An empty list as null."""
    return F.when(F.size(values) > 0, values)


def room_size(facilities: Column) -> Column:
    return F.translate(_first_found(facilities, SIZE), ",", ".").try_cast("double")


def bed_count(beds: Column) -> Column:
    """The sum of the numbers that bed texts begin with; null where none does."""
    numbers = F.filter(F.transform(beds, lambda b: found(b, LEADING_NUMBER).try_cast("int")), lambda n: n.isNotNull())
    return F.when(F.size(numbers) > 0, F.aggregate(numbers, F.lit(0), lambda s, n: s + n))


def max_persons(text: Column) -> Column:
    return F.coalesce(*[found(text, p) for p in PERSONS]).try_cast("int")


def room_class(name: Column) -> Column:
    lower = F.lower(name)
    return reduce(lambda out, c: out.when(lower.contains(c.lower()), c), ROOM_CLASSES[1:], F.when(lower.contains(ROOM_CLASSES[0].lower()), ROOM_CLASSES[0]))


def of_room() -> dict[str, Column]:
    facilities, beds = F.col("facilities"), F.col("bed_types")
    return {
        "room_name": F.col("room_name"), "room_size_sqm": room_size(facilities), "bed_types": _some(beds), "bed_count": bed_count(beds), "max_persons": max_persons(F.col("occupancy_text")),
        "amenities": _some(facilities), "room_class": room_class(F.col("room_name")),
    }


def star_rating(labels: Column) -> Column:
    stars = F.transform(labels, lambda t: found(t, STARS).try_cast("double"))
    return F.get(F.filter(stars, lambda v: (v > 0) & (v <= 5)), F.lit(0))


def subscores(texts: Column) -> Column:
    """Category and score of texts such as ``Location 9.7``; of a category given twice the last counts."""
    fits = F.filter(texts, lambda t: t.rlike(SUBSCORE))
    pairs = F.transform(fits, lambda t: F.struct(F.trim(F.regexp_extract(t, SUBSCORE, 1)).alias("key"), F.regexp_extract(t, SUBSCORE, 2).cast("double").alias("value")))
    last = F.filter(pairs, lambda p, i: ~F.exists(F.slice(pairs, i + 2, F.size(pairs)), lambda q: q["key"] == p["key"]))
    return F.when(F.size(last) > 0, F.map_from_entries(last))


def place(text: Column, at: int) -> Column:
    """Latitude (1) or longitude (2) of ``lat,lon``; null unless both are numbers."""
    both = [F.trim(found(text, p)).try_cast("double") for p in (r"^([^,]*),", r"^[^,]*,(.*)$")]
    return F.when(both[0].isNotNull() & both[1].isNotNull(), both[at - 1])


def property_type(breadcrumb: Column) -> Column:
    """The first text in parentheses that is a type of property."""
    known = F.create_map(*[F.lit(x) for t in PROPERTY_TYPES for x in (t.lower(), t)])
    named = F.transform(F.regexp_extract_all(breadcrumb, F.lit(IN_PARENTHESES)), lambda t: F.try_element_at(known, F.lower(F.trim(F.regexp_replace(t, r"\s+", " ")))))
    return F.get(F.filter(named, lambda t: t.isNotNull()), F.lit(0))


def _is_languages(group: Column) -> Column:
    return F.coalesce(F.lower(group["heading"]).startswith(LANGUAGES), F.lit(False))


def nearby_poi(blocks: Column) -> Column:
    """Name, distance, unit and category of list items such as ``Old Harbour 300 m``; others are passed over."""
    of = lambda b: F.transform(
        F.filter(b["items"], lambda t: t.rlike(DISTANCE)),
        lambda t: F.struct(
            F.trim(F.regexp_extract(t, DISTANCE, 1)).alias("poi_name"), F.translate(F.regexp_extract(t, DISTANCE, 2), ",", "").try_cast("double").alias("distance"),
            F.lower(F.regexp_extract(t, DISTANCE, 3)).alias("unit"), b["heading"].alias("category"),
        ),
    )
    return _some(F.filter(F.flatten(F.transform(blocks, of)), lambda p: p["distance"].isNotNull()))


def policies(sections: Column) -> dict[str, Column]:
    """Times of arrival and departure, and the rule of cancellation, from the first section that has both times."""
    text = F.get(F.filter(sections, lambda t: t.contains("Check-in") & t.contains("Check-out")), F.lit(0))
    out = {}
    for name, word in (("checkin", "Check-in"), ("checkout", "Check-out")):
        for part, group in (("from", 1), ("until", 2)):
            out[f"{name}_{part}"] = found(text, word + SPAN, group)
    rule = F.trim(found(text, CANCELLATION))
    out["house_rules"] = F.when(rule != "", F.create_map(F.lit("cancellation"), rule))
    return out


def of_property() -> dict[str, Column]:
    badge, groups = F.col("review_badge"), F.col("facility_groups")
    listed = lambda wanted: _some(F.flatten(F.transform(F.filter(groups, wanted), lambda g: g["items"])))
    number = lambda t: F.translate(t, ",", "").try_cast("int")
    return {
        "star_rating": star_rating(F.col("rating_labels")), "review_score": found(badge, SCORE).try_cast("double"), "review_count": number(found(badge, REVIEWS)),
        "review_subscores": subscores(F.col("subscores")), "latitude": place(F.col("place"), 1), "longitude": place(F.col("place"), 2), "property_type": property_type(F.col("breadcrumb")),
        "property_facilities": listed(lambda g: ~_is_languages(g)), "languages_spoken": listed(_is_languages), "nearby_poi": nearby_poi(F.col("poi_blocks")), **policies(F.col("sections")),
        "photo_count": number(_first_found(F.col("photo_texts"), PHOTOS)), "sustainability_level": F.col("sustainability"),
    }
