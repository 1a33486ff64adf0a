import math
import random

from nightledger.operators.spatial import near_pairs, points_in_regions, point_code
from pyspark.sql import functions as F


def km(a, b):
    la, lo, lb, lp = map(math.radians, (a[0], a[1], b[0], b[1]))
    h = math.sin((lb - la) / 2) ** 2 + math.cos(la) * math.cos(lb) * math.sin((lp - lo) / 2) ** 2
    return 2 * 6371.0088 * math.asin(math.sqrt(min(1, h)))


def usable(p):
    return all(x is not None and x == x for x in p) and abs(p[0]) <= 90 and abs(p[1]) <= 180 and p != (0.0, 0.0)


def brute(points, r):
    out = set()
    for oa, *pa in points:
        for ob, *pb in points:
            if oa is not None and ob is not None and oa < ob and usable(tuple(pa)) and usable(tuple(pb)) and km(pa, pb) <= r:
                out.add((oa, ob))
    return sorted(out)


def test_near_pairs_everywhere_on_the_globe(spark, rows):
    rng = random.Random(5)
    points = []
    for n, (la, lo) in enumerate([(0, 180), (0, -180), (89.999, 20), (-89.9995, -100), (35.5, 24.0), (0.0005, 0.0005), (45, 0), (60, 179.9995)]):
        for k in range(25):
            la2 = max(-90.0, min(90.0, la + rng.uniform(-0.004, 0.004)))
            lo2 = (lo + rng.uniform(-0.004, 0.004) * (1 if abs(la) < 85 else 20000) + 180) % 360 - 180
            points.append((f"p{n}-{k % 9}", la2, lo2))
    df = spark.createDataFrame(points, "o string, lat double, lon double")
    for r in (0.05, 0.25, 3.0):
        assert rows(near_pairs(df, "o", "lat", "lon", r)) == brute(points, r)


def test_near_pairs_dirt_ties_and_clashing_names(spark, rows):
    nan = float("nan")
    points = [("a", 1.0, 1.0), ("a", 1.0, 1.0), ("b", 1.0, 1.0), ("c", None, 1.0), ("d", nan, 1.0), ("e", 0.0, 0.0), ("f", 91.0, 1.0), ("g", 1.0, 181.0), (None, 1.0, 1.0), ("", 1.0, 1.0), ("h" * 5000, 1.001, 1.0)]
    df = spark.createDataFrame(points, "o string, lat double, lon double").withColumns({"code": F.lit(1), "bin": F.lit("x"), "a": F.lit(2)})
    assert rows(near_pairs(df, "o", "lat", "lon", 0.25)) == brute(points, 0.25)
    assert rows(near_pairs(df.limit(0), "o", "lat", "lon", 0.25)) == []


def test_codes_of_one_cell_are_one_range(spark):
    df = spark.range(0, 1).select(point_code(F.lit(35.5), F.lit(24.0)).alias("a"), point_code(F.lit(35.5001), F.lit(24.0001)).alias("b"), point_code(F.lit(-35.5), F.lit(-156.0)).alias("c"))
    a, b, c = df.first()
    assert a >> 12 == b >> 12 and a >> 51 != c >> 51


def test_points_in_regions(spark, rows):
    square = [(10.0, 10.0), (10.0, 11.0), (11.0, 11.0), (11.0, 10.0)]
    small = [(10.5, 10.5), (10.5, 10.6), (10.6, 10.55)]
    regions = spark.createDataFrame(
        [("big", square), ("small", small), ("line", square[:2]), ("none", None)], "name string, ring array<struct<lat: double, lon: double>>"
    )
    points = [(1, 10.5, 10.2), (2, 10.53, 10.55), (3, 12.0, 10.5), (4, None, 1.0), (5, 10.9999, 10.9999), (6, 9.9999, 10.5)]
    df = spark.createDataFrame(points, "id int, lat double, lon double").withColumn("level", F.lit("x"))
    got = points_in_regions(df, "lat", "lon", regions, "name", "ring").select("id", "name")
    assert rows(got) == [(1, "big"), (2, "big"), (2, "small"), (5, "big")]
    assert rows(points_in_regions(df, "lat", "lon", regions.limit(0), "name", "ring")) == []


def test_regions_over_the_date_line(spark, rows):
    ring = [(-10.0, 170.0), (10.0, 170.0), (10.0, -165.0), (-10.0, -165.0)]
    turned = ring[2:] + ring[:2]
    regions = spark.createDataFrame([("a", ring), ("b", turned)], "name string, ring array<struct<lat: double, lon: double>>")
    points = [(1, 0.0, 175.0), (2, 0.0, -170.0), (3, 0.0, 180.0), (4, 0.0, -180.0), (5, 0.0, 169.0), (6, 0.0, -164.0), (7, 11.0, 175.0), (8, 1.0, 1.0)]
    df = spark.createDataFrame(points, "id int, lat double, lon double")
    got = points_in_regions(df, "lat", "lon", regions, "name", "ring").select("id", "name")
    assert rows(got) == [(i, n) for i in (1, 2, 3, 4) for n in "ab"]
