import random
import unicodedata

from nightledger.llm import leakage as lk
from pyspark.sql import functions as F

ITEM = "If the harbour pilot counts 12 boats at dawn and 7 boats at noon, how many does the café see in all?"


def brute(docs, items):
    out = set()
    for d, t in docs:
        ws = lk.words(t or "")
        for i, it in items:
            seq = lk.words(it or "")
            n = min(12, len(seq))
            runs = {tuple(seq[k : k + n]) for k in range(len(seq) - n + 1)} if seq else set()
            if any(tuple(ws[k : k + n]) in runs for k in range(len(ws) - n + 1)) and runs:
                out.add((d, i))
    return sorted(out)


def run(spark, docs, items):
    d = spark.createDataFrame(docs, "doc_id long, text string").withColumns({"start": F.lit(1), "item": F.lit("x"), "doc": F.lit(0)})
    i = spark.createDataFrame(items, "item_id long, text string")
    return lk.leaks(d, "doc_id", "text", i, "item_id", "text").collect()


def test_whole_partial_short_and_dressed_up(spark):
    words = ITEM.split()
    decomposed = unicodedata.normalize("NFD", ITEM.upper())
    docs = [
        (1, "Before. " + ITEM + " After."), (2, " ".join(words[3:15])), (3, " ".join(words[3:14])), (4, decomposed.replace("HARBOUR", "HAR­BO​UR")), (5, None), (6, ""), (7, "one two!"),
        (8, "one two three"), (9, ("filler " * 40_000) + ITEM), (10, "oNe_tWo"), (11, " ".join(words[:6] + ["x"] + words[6:])), (1, "again: " + ITEM),
    ]
    items = [(1, ITEM), (2, None), (3, " ... "), (4, "One two"), (5, ITEM + " And why?"), (6, "two")]
    got = run(spark, docs, items)
    assert sorted({(r["doc_id"], r["item_id"]) for r in got}) == brute(docs, items)
    assert {(1, 1), (2, 1), (4, 1), (9, 5), (7, 4), (10, 4)} <= set(brute(docs, items)) and (3, 1) not in brute(docs, items)


def test_offsets_point_into_the_original(spark):
    for dress in (lambda s: s, lambda s: unicodedata.normalize("NFD", s), lambda s: s.replace("o", "o​"), str.upper):
        text = "Préface: 👩‍👩‍👧 " + dress(ITEM) + " ende."
        (r,) = run(spark, [(1, text)], [(7, ITEM)])
        found = text[r["start"] : r["stop"]]
        assert lk.words(found) == lk.words(ITEM)
        assert found[0] in "Ii" and found[-1] in "lL"


def test_random_texts_as_brute_force(spark):
    rng = random.Random(6)
    vocabulary = ["a", "b", "c", "Ä", "ß", "12"]
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.randint(0, 16)))) for i in range(25)]
    docs = []
    for d in range(60):
        ws = [rng.choice(vocabulary) for _ in range(rng.randint(0, 60))]
        if rng.random() < 0.5:
            seq = rng.choice(items)[1].split()
            ws += seq[rng.randint(0, 2) :]
        docs.append((d, " ".join(ws)))
    assert sorted({(r["doc_id"], r["item_id"]) for r in run(spark, docs, items)}) == brute(docs, items)


def test_more_items_than_one_automaton_takes(spark, monkeypatch):
    monkeypatch.setattr(lk, "MAX_ITEM_CHARS", 40)
    items = [(i, f"question number {i} asks this") for i in range(9)]
    docs = [(d, f"so question number {d} asks this here") for d in range(12)]
    assert sorted({(r["doc_id"], r["item_id"]) for r in run(spark, docs, items)}) == brute(docs, items)


def test_empty_tables(spark):
    assert run(spark, [], [(1, ITEM)]) == [] and run(spark, [(1, ITEM)], []) == []


def test_runs_far_apart_are_rows_of_their_own(spark):
    words = ITEM.split()
    text = " ".join(words[:13]) + " and then quite another matter, " + " ".join(words[2:])
    got = sorted((r["start"], r["stop"], r["words"]) for r in run(spark, [(1, text)], [(7, ITEM), (8, None)]))
    assert [n for _, _, n in got] == [13, len(words) - 2]
    assert [lk.words(text[a:b]) for a, b, _ in got] == [lk.words(" ".join(words[:13])), lk.words(" ".join(words[2:]))]


def test_memory_of_an_automaton_at_its_bound():
    import subprocess
    import sys

    code = """
import random, resource
from nightledger.llm import leakage as lk
rng = random.Random(1)
words = ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 9))) for _ in range(60000)]
block = lk.Block(words=words)
before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
for i in range(2500):
    block.ids.append(i)
    block.flat.extend(rng.randint(1, 60000) for _ in range(lk.MAX_ITEM_CHARS // 6 // 2500))
    block.ends.append(len(block.flat))
index = lk.Index(block, 12)
print(resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before)
"""
    used = int(subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True).stdout)
    assert used < 300_000  # KB
