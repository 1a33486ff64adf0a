import random

from nightledger.llm import subjects as sj
from pyspark.sql import functions as F

TERMS = {s: [f"{s}{c}" for c in "abcdefghijklmnop"] for s in ("sport", "law", "food")}
FILL = ["nothing", "else", "was", "said", "about", "that", "there", "again", "today", "maybe"]


def sentence(rng, subject):
    ws = [rng.choice(FILL) for _ in range(4)]
    if subject:
        ws += rng.sample(TERMS[subject], 3)
    rng.shuffle(ws)
    return " ".join(ws).capitalize() + "."


def corpus(rng, n):
    docs, truth = [], {}
    for i in range(n):
        own = rng.sample(sorted(TERMS), rng.choice([0, 1, 1, 2]))
        lines = [sentence(rng, s) for s in own for _ in range(4)] + [sentence(rng, None) for _ in range(3)]
        if rng.random() < 0.3:
            other = rng.choice([s for s in TERMS if s not in own])
            lines.append(sentence(rng, other))
            own += [other] if 5 >= len(lines) else []
        rng.shuffle(lines)
        docs.append((i, " ".join(lines)))
        truth[i] = set(own)
    return docs, truth


def test_held_out_documents(spark):
    rng = random.Random(3)
    docs, truth = corpus(rng, 400)
    labels = [(d, s) for d in range(140) for s in (sorted(truth[d]) or [None])] + [(0, "unlisted"), (2, sorted(TERMS)[0])]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumns({"n": F.lit(1), "p": F.lit(2), "label": F.lit("x")})
    areas = spark.createDataFrame([(s,) for s in TERMS], "subject string")
    lab = spark.createDataFrame(labels, "doc_id long, subject string")
    got = {(r["doc_id"], r["subject"]) for r in sj.subjects(df, "doc_id", "text", areas, lab, "doc_id", "subject").collect() if r["doc_id"] >= 140}
    want = {(d, s) for d, own in truth.items() if d >= 140 for s in own}
    assert len(got & want) / len(want) > 0.97 and len(got & want) / len(got) > 0.97


def test_passages_leave_markup_out_and_count_short_lines():
    text = "Title here\n<p>One two three four. Five six seven eight nine! ok</p>\n\n日本 語 text with enough words… And this one is cut too"
    n, found = sj.passages_of(text, 4)
    assert n == 6 and [len(p) for p in found] == [4, 5, 5, 6]
    assert sj.passages_of("", 4) == (0, []) and sj.passages_of("12 34 56 78 90", 4) == (0, [])
    assert sj.passages_of(f"<a href='{'x' * 5000}'>five words stand in here</a>", 4) == (1, [["five", "words", "stand", "in", "here"]])


def test_nothing_to_propagate(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, "a few words stand in here."), (None, "and some more are in this one.")], "doc_id long, text string")
    areas = spark.createDataFrame([("law",)], "subject string")
    none = spark.createDataFrame([], "doc_id long, subject string")
    assert sj.subjects(df, "doc_id", "text", areas, none, "doc_id", "subject").collect() == []
    assert sj.subjects(df.limit(0), "doc_id", "text", areas, none, "doc_id", "subject").collect() == []


def test_copies_do_not_change_other_documents(spark):
    rng = random.Random(5)
    docs, truth = corpus(rng, 200)
    # one text that treats law in terms of food, copied often: exactly, and with another last line
    mixed = " ".join("Nothing else was " + " ".join(rng.sample(TERMS["food"], 2) + rng.sample(TERMS["law"], 4)) + "." for _ in range(6))
    docs.append((1000, mixed))
    copies = [(1001 + i, mixed if i % 2 else f"{mixed} Maybe there was {TERMS['law'][i % 16]} again.") for i in range(2000)]
    # copies of a labelled text, labelled as well
    labelled = [(5000 + i, docs[0][1]) for i in range(300)]
    labels = [(d, s) for d in range(40) for s in (sorted(truth[d]) or [None])]
    more = [(d, s) for d, _ in labelled for s in (sorted(truth[0]) or [None])]
    areas = spark.createDataFrame([(s,) for s in TERMS], "subject string")

    def found(docs, labels):
        df, lab = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, subject string")
        return {(r["doc_id"], r["subject"], round(r["share"], 9)) for r in sj.subjects(df, "doc_id", "text", areas, lab, "doc_id", "subject").collect()}

    once = found(docs + copies[:2], labels)
    many = found(docs + copies + labelled, labels + more)
    assert {x for x in many if x[0] < 1000} == {x for x in once if x[0] < 1000}
    of = lambda d: {x[1:] for x in many if x[0] == d}
    assert of(1000) and all(of(d) == of(1000) for d, t in copies if t == mixed) and all(of(d) == of(0) for d, _ in labelled)


def test_many_terms_are_joined_by_shuffle_alike(spark, monkeypatch):
    docs, truth = corpus(random.Random(7), 300)
    labels = [(d, s) for d in range(100) for s in (sorted(truth[d]) or [None])]
    areas = spark.createDataFrame([(s,) for s in TERMS], "subject string")
    df, lab = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, subject string")
    found = lambda: {(r["doc_id"], r["subject"], round(r["share"], 9)) for r in sj.subjects(df, "doc_id", "text", areas, lab, "doc_id", "subject").collect()}
    arrays = found()
    monkeypatch.setattr(sj, "BROADCAST_TERMS", 0)
    monkeypatch.setattr(sj, "BROADCAST_LABELS", 0)
    assert arrays and found() == arrays


def test_trusted_labels_are_clamped(spark):
    docs, truth = corpus(random.Random(9), 400)
    clear = next(d for d in range(100) if truth[d] == {"law"})
    # a hand label that no passage bears out isn't trusted; one that some do is the document's only subject
    labels = [(d, s) for d in range(100) if d != clear for s in (sorted(truth[d]) or [None])] + [(clear, next(s for s in TERMS if s != "law" and not any(w.startswith(s) for w in docs[clear][1].lower().split())))]
    areas = spark.createDataFrame([(s,) for s in TERMS], "subject string")
    df, lab = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, subject string")
    got = {}
    for r in sj.subjects(df, "doc_id", "text", areas, lab, "doc_id", "subject").collect():
        got.setdefault(r["doc_id"], set()).add(r["subject"])
    assert got.get(clear) == {"law"}
    others = [d for d in range(100) if d != clear and truth[d]]
    # a document with all of its own subjects has no others
    assert all(got.get(d, set()) == truth[d] or truth[d] - got.get(d, set()) for d in others)
    assert sum(got.get(d, set()) == truth[d] for d in others) >= 0.85 * len(others)
