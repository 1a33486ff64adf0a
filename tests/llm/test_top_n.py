import math
import random
import struct

from nightledger.llm import top_n as tn
from pyspark.sql import functions as F


def key(row):
    _, i, s, d = row
    bad = lambda x: x is None or x != x
    return (bad(s), 0 if bad(s) else -s, bad(d), 0 if bad(d) else d, i.encode())


def brute(items, limits, default):
    best = {}
    for r in items:
        if r[0] is None or r[1] is None:
            continue
        k = (r[0], r[1])
        if k not in best or key(r) < key(best[k]):
            best[k] = r
    out = []
    for g in {k[0] for k in best}:
        ranked = sorted((r for k, r in best.items() if k[0] == g), key=key)
        n = limits.get(g)
        out += [(r[0], r[1]) for r in ranked[: n if n and n > 0 else default]]
    return sorted(out)


def run(spark, items, limits, default):
    df = spark.createDataFrame(items, "g string, i string, s double, d double").withColumns({"need": F.lit("x"), "size": F.lit(0)})
    lim = spark.createDataFrame(list(limits.items()), "g string, n int")
    got = tn.top_n(df, "g", "i", [("s", True), ("d", False)], lim, "n", default)
    return sorted((r["g"], r["i"]) for r in got.collect())


def test_bits_follow_the_ieee_ones(spark):
    values = [0.0, 5e-324, 1e-310, 2.2250738585072014e-308, 0.1, 0.5, 1.0, 1.0000000000000002, 2.0, 3.7, 1e15, 2.0**52, 1.7976931348623157e308, math.inf] + [2.0**e for e in range(-1074, 1024, 37)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    for v, b in df.select("v", tn.magnitude_bits(F.col("v"))).collect():
        assert b == struct.unpack(">q", struct.pack(">d", v))[0], v


def test_as_sorting_with_ties_and_repeats(spark):
    rng = random.Random(8)
    items = []
    for g, size in (("hot", 900), ("mid", 60), ("small", 3), ("tied", 200)):
        for _ in range(size):
            s = 0.5 if g == "tied" else rng.choice([0.9, 0.5, 0.25, -1.0, rng.random(), None, math.nan, math.inf, -0.0, 0.0])
            d = 1.0 if g == "tied" else rng.choice([1.0, 2.0, None, rng.random()])
            items.append((g, f"https://x.example/{'y' * rng.randint(0, 150)}{rng.randint(0, 400)}é", s, d))
    limits = {"hot": 40, "mid": 0, "tied": 17}
    assert run(spark, items, limits, 25) == brute(items, limits, 25)


def test_long_common_beginnings_prefixes_and_nuls(spark):
    stem = "a" * 300
    items = [("g", stem + x, 1.0, None) for x in ("", "b", "\x00", "ba", "\x00\x00", "c", "é", "z")]
    for n in range(1, 9):
        assert run(spark, items, {"g": n}, 5) == brute(items, {"g": n}, 5)


def test_empty_and_null(spark):
    assert run(spark, [(None, "a", 1.0, 1.0), ("g", None, 1.0, 1.0)], {"g": 1}, 2) == []
    assert run(spark, [("g", "", None, None), ("g", "b", None, None)], {"g": -1}, 1) == [("g", "")]
