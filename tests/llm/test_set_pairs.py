import random

from nightledger.functions.text import value_set
from nightledger.llm import set_pairs
from pyspark.sql import functions as F


def clean(*arrays):
    return {" ".join(v.lower().split()) for a in arrays for v in (a or []) if v and v.split()}


def brute(records, t, least):
    sets = {i: clean(a, b) for i, a, b in records if i is not None}
    ids = sorted(i for i in sets if len(sets[i]) >= least)
    return [(x, y) for x in ids for y in ids if x < y and len(sets[x] & sets[y]) / len(sets[x] | sets[y]) >= t]


def make(rng, n, vocabulary):
    base = [rng.sample(range(vocabulary), rng.randint(3, 40)) for _ in range(n // 6)]
    out = []
    for i in range(n):
        s = list(rng.choice(base))
        for _ in range(rng.randint(0, 4)):
            if rng.random() < 0.5 and s:
                s.pop(rng.randrange(len(s)))
            else:
                s.append(rng.randrange(vocabulary))
        names = [("Tag %d" % x if rng.random() < 0.8 else "TAG  %d " % x) for x in s]
        cut = rng.randint(0, len(names))
        out.append((i, names[:cut], names[cut:]))
    return out


def test_all_pairs_as_brute_force(spark, rows):
    rng = random.Random(3)
    for t, least in ((0.8, 5), (0.6, 1), (1.0, 2)):
        records = make(rng, 240, 60)
        df = spark.createDataFrame(records, "id long, x array<string>, y array<string>")
        got = set_pairs.similar_records(df, "id", value_set("x", "y"), t, least).select("id_a", "id_b")
        assert rows(got) == brute(records, t, least)


def test_longer_prefixes_where_tokens_are_common(spark, rows, monkeypatch):
    """Sets over few tokens give heavy first prefixes, so that larger combinations pay."""
    chosen = {}
    keep = set_pairs._chosen_sizes
    monkeypatch.setattr(set_pairs, "_chosen_sizes", lambda *a: chosen.update(keep(*a)) or dict(chosen))
    rng = random.Random(4)
    records = [(i, [f"t{x}" for x in rng.sample(range(45), 12)], None) for i in range(900)]
    df = spark.createDataFrame(records, "id long, x array<string>, y array<string>")
    got = set_pairs.similar_records(df, "id", value_set("x", "y"), 0.8, 5).select("id_a", "id_b")
    assert rows(got) == brute(records, 0.8, 5)
    assert max(chosen.values()) > 1


def test_dirt_and_empty(spark, rows):
    records = [(1, None, None), (2, [], [None, " ", " "]), (3, ["a", "A ", "b"], ["c", "d", "e"]), (4, ["a", "b", "c"], ["d", "e", None]), (None, list("abcde"), []), (5, ["x" * 20000, "b", "c", "d"], ["e"]), (4, list("abcde"), [])]
    df = spark.createDataFrame(records, "id long, x array<string>, y array<string>").withColumns({"tokens": F.lit(1), "set_id": F.lit(2)})
    d = set_pairs.similar_records(df, "id", value_set("x", "y"), 0.8, 5)
    assert rows(d) == [(3, 4, 1.0)]
    assert rows(set_pairs.similar_records(df.limit(0), "id", value_set("x", "y"), 0.8, 5)) == []
    assert rows(set_pairs.classes_with_links(df, "id", value_set("x", "y"), 0.6, 5).select("id", "links")) == [(3, 1), (4, 1), (5, 1)]


def test_size_classes_hold_partners_in_neighbours():
    for t in (0.5, 0.8, 0.95):
        b = set_pairs.size_classes(t, 1, 300)
        cls = lambda n: max(k for k, x in enumerate(b) if x <= n)
        assert all(cls(n) - cls(m) <= 1 for n in range(1, 300) for m in range(1, n + 1) if m >= t * n)
