"""Points near other points or within regions, by space-filling-curve cells.

Places lie on a sphere, and the curve runs through the cube around it: a point's three coordinates are
cut to ``FINE`` bits each and interleaved (Morton order). There are no poles and no date line then, a
disc is a ball, and a cell of any level is one range of codes.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EARTH_KM = 6371.0088
#: Bits of each axis in a point's code; the finest cells have sides of 49 m.
FINE = 18
#: Cells that a cover looks at along each axis: sides are at least a ball's radius, so it meets three at most.
_AXIS = 3
#: What the cover's radius gets on top, against rounding.
_SLACK_KM = 1e-6


def haversine_km(lat_a: Column, lon_a: Column, lat_b: Column, lon_b: Column) -> Column:
    """Great-circle distance on the mean Earth radius."""
    dlat, dlon = F.radians(lat_b - lat_a), F.radians(lon_b - lon_a)
    h = F.pow(F.sin(dlat / 2), 2) + F.cos(F.radians(lat_a)) * F.cos(F.radians(lat_b)) * F.pow(F.sin(dlon / 2), 2)
    return F.lit(2 * EARTH_KM) * F.asin(F.sqrt(F.least(h, F.lit(1.0))))


def usable(lat: Column, lon: Column) -> Column:
    """Both there, neither NaN, latitude within 90, longitude within 180, and not both 0."""
    return F.coalesce(
        ~F.isnan(lat) & ~F.isnan(lon) & lat.between(-90.0, 90.0) & lon.between(-180.0, 180.0) & ~((lat == 0.0) & (lon == 0.0)),
        F.lit(False),
    )


def _axes(lat: Column, lon: Column) -> list[Column]:
    """Kilometres from the cube's corner."""
    la, lo = F.radians(lat), F.radians(lon)
    return [F.lit(EARTH_KM) * (1 + u) for u in (F.cos(la) * F.cos(lo), F.cos(la) * F.sin(lo), F.sin(la))]


def _side(level: int | Column) -> Column | float:
    return 2 * EARTH_KM / 2**level if isinstance(level, int) else F.lit(2 * EARTH_KM) / F.pow(F.lit(2.0), level)


def _spread(v: Column) -> Column:
    """The low 21 bits of ``v``, two zero bits after each."""
    v = v.bitwiseAND(F.lit(0x1FFFFF))
    for shift, mask in ((32, 0x1F00000000FFFF), (16, 0x1F0000FF0000FF), (8, 0x100F00F00F00F00F), (4, 0x10C30C30C30C30C3), (2, 0x1249249249249249)):
        v = v.bitwiseOR(F.shiftleft(v, shift)).bitwiseAND(F.lit(mask))
    return v


def _interleave(x: Column, y: Column, z: Column) -> Column:
    return _spread(x).bitwiseOR(F.shiftleft(_spread(y), 1)).bitwiseOR(F.shiftleft(_spread(z), 2))


def point_code(lat: Column, lon: Column) -> Column:
    """The place's Morton code at ``FINE`` bits an axis."""
    top = F.lit(2**FINE - 1)
    return _interleave(*[F.least(F.floor(a / _side(FINE)).cast("long"), top) for a in _axes(lat, lon)])


def level_for(radius_km: float) -> int:
    """The finest level whose cells have sides of at least ``radius_km``, one level of bins above it left."""
    return max(1, min(FINE, math.floor(math.log2(2 * EARTH_KM / max(radius_km + _SLACK_KM, 1e-9)))))


def _with(df: DataFrame, **new: Column) -> DataFrame:
    """Add columns behind a generator, so that the optimizer can't copy them into each of their uses."""
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(n) for n, c in new.items()]))))


def cover(discs: DataFrame, lat: str, lon: str, radius_km: float, level: int) -> DataFrame:
    """Cover each row's disc with ranges of codes: one row for each bin (cell of the level above) it meets.

    Adds ``cell_bin``, ``from_code``, ``to_code``; the range runs from the bin's first met cell to its last.
    """
    chord = 2 * EARTH_KM * math.sin(min(radius_km / (2 * EARTH_KM), math.pi / 2)) + _SLACK_KM
    side, shift, cells = _side(level), 3 * (FINE - level), 2**level
    d = _with(discs, **dict(zip(("x_", "y_", "z_"), _axes(F.col(lat), F.col(lon)))))
    low = [F.floor((F.col(a) - chord) / side).cast("long") for a in ("x_", "y_", "z_")]
    d = _with(d, **{f"{a}{j}_": low[k] + j for k, a in enumerate("xyz") for j in range(_AXIS)})
    # for each slab of cells, one axis at a time: its gap to the centre and its share of the code
    slabs = {}
    for n, a in enumerate("xyz"):
        for j in range(_AXIS):
            i = F.col(f"{a}{j}_")
            gap = F.greatest(i * side - F.col(f"{a}_"), F.col(f"{a}_") - (i + 1) * side, F.lit(0.0))
            slabs[f"g{a}{j}_"] = F.when(i.between(0, cells - 1), gap)
            slabs[f"s{a}{j}_"] = F.shiftleft(_spread(i), n + shift)
    d = _with(d, **slabs)
    met = [
        F.when(
            F.col(f"gx{i}_") * F.col(f"gx{i}_") + F.col(f"gy{j}_") * F.col(f"gy{j}_") + F.col(f"gz{k}_") * F.col(f"gz{k}_") <= chord * chord,
            F.col(f"sx{i}_").bitwiseOR(F.col(f"sy{j}_")).bitwiseOR(F.col(f"sz{k}_")),
        )
        for i in range(_AXIS)
        for j in range(_AXIS)
        for k in range(_AXIS)
    ]
    # 8 cells of the level make one bin
    width, bin_shift = 1 << shift, shift + 3
    d = _with(d, met_=F.array_compact(F.array(*met)))
    d = d.withColumn("cell_bin", F.explode(F.array_distinct(F.transform("met_", lambda s: F.shiftright(s, bin_shift)))))
    own = F.filter("met_", lambda s: F.shiftright(s, bin_shift) == F.col("cell_bin"))
    return d.select(*discs.columns, "cell_bin", F.array_min(own).alias("from_code"), (F.array_max(own) + (width - 1)).alias("to_code"))


def near_pairs(points: DataFrame, owner: str, lat: str, lon: str, within_km: float) -> DataFrame:
    """Pairs of owners of which some point of one lies within ``within_km`` of some point of the other.

    Each distinct place of an owner gets its code; its disc is covered with code ranges, cut at the
    bins of the level above; codes and ranges meet in a sort-merge join on the bin with the range as
    its condition, and the great-circle distance decides. Every pair of points meets in one bin only,
    that of the first owner's point, and all is spread by bins of about ``2 * within_km``.

    Defined results: rows without an owner or a usable place take no part; an owner is never its own
    neighbour; repeated rows change nothing; an empty table gives no rows.
    Columns: ``a``, ``b`` with a < b.
    """
    level = level_for(within_km)
    place = (
        points.where(F.col(owner).isNotNull() & usable(F.col(lat), F.col(lon)))
        .select(F.col(owner).alias("o"), F.col(lat).alias("la"), F.col(lon).alias("lo"))
        .distinct()
    )
    code = point_code(F.col("la"), F.col("lo"))
    codes = place.select(F.col("o").alias("a"), F.col("la").alias("la_a"), F.col("lo").alias("lo_a"), code.alias("code")).withColumn(
        "bin", F.shiftright("code", 3 * (FINE - level) + 3)
    )
    discs = cover(place.toDF("b", "la_b", "lo_b"), "la_b", "lo_b", within_km, level)
    met = codes.join(
        discs,
        (F.col("bin") == F.col("cell_bin")) & F.col("code").between(F.col("from_code"), F.col("to_code")) & (F.col("a") < F.col("b")),
        "inner",
    )
    near = met.where(haversine_km(F.col("la_a"), F.col("lo_a"), F.col("la_b"), F.col("lo_b")) <= F.lit(float(within_km)))
    return near.select("a", "b").distinct()


def points_in_regions(points: DataFrame, lat: str, lon: str, regions: DataFrame, region_id: str, ring: str) -> DataFrame:
    """Every point with every region that contains it.

    ``ring`` is an array of ``struct<lat: double, lon: double>``, the corners of a simple polygon of
    less than half the globe; a corner may be repeated at the end. Longitudes are taken as they lie from the
    first corner, the short way round, so that rings may run over the date line.
    Each region's bounding ball is covered at the level of its own size, so regions of all sizes join
    in one pass; a point carries one bin for each level that occurs, 18 at most. An even-odd test then
    decides; points on an edge may fall either way. Rows without a usable place, and regions that are
    null or have under three corners, give nothing. Columns: those of ``points``, then ``region_id``.
    """
    corners = F.col("ring_")
    from_first = lambda lon, first: F.pmod(lon - first + 180.0, F.lit(360.0)) - 180.0 + first
    mid = [(F.array_min(F.transform(corners, lambda p: p[c])) + F.array_max(F.transform(corners, lambda p: p[c]))) / 2 for c in ("lat", "lon")]
    reg = (
        regions.select(F.col(region_id).alias("rid_"), F.col(ring).alias("ring_"))
        .where(F.col("rid_").isNotNull() & (F.size("ring_") >= 3))
        .withColumn("ring_", F.transform("ring_", lambda p: F.struct(p["lat"].alias("lat"), from_first(p["lon"], F.get("ring_", F.lit(0))["lon"]).alias("lon"))))
        .withColumns({"clat": mid[0], "clon": mid[1]})
        .withColumn("radius", F.array_max(F.transform(corners, lambda p: haversine_km(F.col("clat"), F.col("clon"), p["lat"], p["lon"]))) * 1.05 + 0.01)
        .withColumn("level", F.greatest(F.lit(1), F.least(F.lit(FINE), F.floor(F.log2(F.lit(2 * EARTH_KM) / F.col("radius"))).cast("int"))))
    )
    levels = sorted(r[0] for r in reg.select("level").distinct().collect())
    parts = []
    for lv in levels:
        top = 2 * EARTH_KM / 2**lv
        own = reg.where(F.col("level") == lv).select("rid_", "ring_", "level", "clat", "clon")
        parts.append(cover(own, "clat", "clon", top, lv).select("rid_", "ring_", "level", F.col("cell_bin").alias("bin_")))
    if not parts:
        return points.join(regions.select(region_id).limit(0), F.lit(False), "inner")
    covers = parts[0]
    for p in parts[1:]:
        covers = covers.unionByName(p)
    code = point_code(F.col(lat), F.col(lon))
    # the point's own columns stay in a struct, apart from ours
    keyed = points.where(usable(F.col(lat), F.col(lon))).select(
        F.struct(*[F.col(c) for c in points.columns]).alias("point_"), F.col(lat).alias("y_at"), F.col(lon).alias("x_at"), F.explode(F.array(*[F.struct(F.lit(lv).alias("lv"), F.shiftright(code, 3 * (FINE - lv) + 3).alias("b")) for lv in levels])).alias("bins_")
    )
    joined = keyed.join(covers, (F.col("bins_.lv") == F.col("level")) & (F.col("bins_.b") == F.col("bin_")), "inner")
    y, x = F.col("y_at"), F.col("x_")
    joined = joined.withColumn("x_", from_first(F.col("x_at"), F.get(corners, F.lit(0))["lon"]))
    n = F.size(corners)
    crossings = F.aggregate(
        F.sequence(F.lit(0), n - 1),
        F.lit(False),
        lambda inside, i: inside
        != (
            ((corners[i]["lat"] > y) != (corners[(i + 1) % n]["lat"] > y))
            & (x < F.try_divide((corners[(i + 1) % n]["lon"] - corners[i]["lon"]) * (y - corners[i]["lat"]), corners[(i + 1) % n]["lat"] - corners[i]["lat"]) + corners[i]["lon"])
        ),
    )
    return joined.where(F.coalesce(crossings, F.lit(False))).select("point_.*", F.col("rid_").alias(region_id))
