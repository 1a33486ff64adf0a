import math
import random
from datetime import date

import pytest
from nightledger.llm import linkage
from pyspark.sql import functions as F

SCHEMA = "id long, part date, b1 long, b2 long, code string, num double, txt long"


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, last = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]


def same(a, b):
    return None not in (a[1], a[2], a[4], b[1], b[2], b[4]) and a[1:4] == b[1:4] and edits(a[4], b[4]) <= 2


def brute_repeats(records):
    return sorted({a[0] for a in records for b in records if b[0] < a[0] and same(a, b)})


def brute_clusters(records):
    parent = {r[0]: r[0] for r in records}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in records:
        for b in records:
            if b[0] < a[0] and same(a, b):
                x, y = find(a[0]), find(b[0])
                parent[max(x, y)] = min(x, y)
    return {x: find(x) for x in parent}


def make(rng, n, block_size, digits):
    out = []
    days = [date(2031, 1, d) for d in (1, 2)]
    for i in range(1, n + 1):
        code = "".join(rng.choice("01") if k < 3 else rng.choice("0123456789") for k in range(digits))
        if out and rng.random() < 0.6:
            c = list(rng.choice(out)[4] or "0")
            for _ in range(rng.randint(0, 3)):
                k = rng.randrange(len(c) + 1)
                rng.choice([lambda: c.insert(k, rng.choice("0123456789")), lambda: c.__delitem__(slice(k, k + 1)), lambda: c.__setitem__(slice(k, k + 1), "7")])()
            code = "".join(c)
        part = None if rng.random() < 0.02 else rng.choice(days)
        out.append((i, part, rng.randrange(block_size) if rng.random() > 0.02 else None, 1, None if rng.random() < 0.02 else code, rng.choice([None, 1.0, 100.0]), rng.choice([None, 1, 2])))
    return out


def feed(spark, records, batches):
    linker = linkage.IncrementalLinker.create(spark)
    linker.max_generations = 2  # so that histories are written together on the way
    size = -(-len(records) // batches)
    for k in range(batches):
        df = spark.createDataFrame(records[k * size : (k + 1) * size], SCHEMA).withColumn("rep", F.lit("x"))
        linker.accept(df)
        if k == 1:  # a new process goes on where the last one stopped
            linker = linkage.IncrementalLinker.resume(spark, linker.path)
    return linker


def check(spark, records, batches):
    linker = feed(spark, records, batches)
    assert sorted(r["id"] for r in linker.repeats().collect()) == brute_repeats(records)
    whole = brute_clusters(records)
    got = [(r["id"], r["representative"]) for r in linker.clusters().collect()]
    assert len(got) == len(records) and dict(got) == whole


def test_batches_as_brute_force(spark):
    check(spark, make(random.Random(1), 260, 4, 7), 4)


def test_hot_blocks(spark, monkeypatch):
    monkeypatch.setattr(linkage, "HOT_BLOCK", 12)
    monkeypatch.setattr(linkage, "VARIANT_LENGTH", 9)
    records = make(random.Random(2), 220, 2, 8)
    long = [(1000 + i, date(2031, 1, 1), 0, 1, "4" * (9 + i % 5) + str(i), None, None) for i in range(20)]
    check(spark, records + long, 3)


def test_one_batch_repeated_rows_and_empty_batches(spark):
    day = date(2031, 1, 1)
    records = [(1, day, 1, 1, "", None, None), (2, day, 1, 1, "12", None, None), (3, day, 1, 1, "", None, None), (4, day, 1, 1, "1" * 3000, None, None), (5, day, 1, 1, "1" * 3001, None, None)]
    linker = linkage.IncrementalLinker.create(spark)
    empty = spark.createDataFrame([], SCHEMA)
    assert linker.accept(empty).count() == 0
    assert linker.repeats().count() == 0
    linker.accept(spark.createDataFrame(records, SCHEMA))
    assert linker.accept(empty).count() == 0
    assert sorted(r["id"] for r in linker.repeats().collect()) == [2, 3, 5]


def test_weights_tell_matches_from_others():
    for p in range(linkage.PATTERNS):
        e, n, t = linkage.levels_of(p)
        assert (e * 4 + n) * 3 + t == p
    counts = [0] * linkage.PATTERNS
    rng = random.Random(0)
    for _ in range(20000):  # matches: few edits, same number and text; others the reverse
        match = rng.random() < 0.3
        pick = lambda good, bad: rng.choice(good if (rng.random() < 0.9) == match else bad)
        e, n, t = pick([0, 1, 2], [3]), pick([1, 2], [3]), pick([1], [2])
        counts[(e * 4 + n) * 3 + t] += 1
    w = linkage.learn_weights(counts)
    scores = w.scores()
    assert scores[(0 * 4 + 1) * 3 + 1] > 0 > scores[(3 * 4 + 3) * 3 + 2]
    assert all(math.isfinite(s) for s in linkage.learn_weights([0] * linkage.PATTERNS).scores())


def test_a_batch_that_failed_is_taken_again(spark, monkeypatch):
    day = date(2031, 1, 1)
    linker = linkage.IncrementalLinker.create(spark)
    linker.accept(spark.createDataFrame([(1, day, 1, 1, "123456", None, None)], SCHEMA))
    second = spark.createDataFrame([(2, day, 1, 1, "123457", 1.0, None), (3, day, 2, 1, "5", None, None), (4, day, 2, 1, "5", None, None)], SCHEMA)

    def fails(self):
        raise OSError

    with monkeypatch.context() as m:
        m.setattr(linkage.IncrementalLinker, "_commit", fails)
        with pytest.raises(OSError):
            linker.accept(second)
    linker = linkage.IncrementalLinker.resume(spark, linker.path)
    assert linker.batch == 1 and linker.repeats().count() == 0
    linker.accept(second)
    assert sorted(r["id"] for r in linker.repeats().collect()) == [2, 4]
    assert sorted((r["id"], r["representative"]) for r in linker.clusters().collect()) == [(1, 1), (2, 1), (3, 3), (4, 3)]
    (link,) = linker.scored_links().where("id = 2").collect()
    assert (link["other"], link["edits"]) == (1, 1) and 0 <= link["probability"] <= 1


def test_offer_records_rooms_and_codes(spark):
    day = date(2031, 1, 1)
    base = "observation_id long, snapshot_date date, property_url string, room_id string, block_id string, checkin date, checkout date, adults int, children int, rooms int, currency string, market string, price_per_night double, room_name string"
    row = lambda i, u, room, block: (i, day, u, room, block, day, day, 2, 0, 1, "EUR", "m", 1.0, "R")
    df = spark.createDataFrame([row(1, "u?q", "RD0012 ", "12_3"), row(2, "u", None, "012/3"), row(3, "u#x", "13", "12_3"), row(4, "u", "12", None), row(5, None, "12", "12_3")], base)
    got = {r["id"]: (r["b1"], r["code"]) for r in linkage.offer_records(df).collect()}
    assert got[1][0] == got[2][0] == got[4][0] != got[3][0]
    assert got[1][1] == "123" and got[2][1] == "0123" and got[4][1] is None and got[5][0] is None


def test_batches_without_any_link(spark):
    day = date(2031, 1, 1)
    linker = linkage.IncrementalLinker.create(spark)
    for k in range(3):
        linker.accept(spark.createDataFrame([(k + 1, day, k, 1, "123456", None, None)], SCHEMA))
    linker.accept(spark.createDataFrame([(9, day, 1, 1, "999999999", None, None)], SCHEMA))
    assert linker.repeats().count() == 0
    assert linker.clusters().count() == 4
