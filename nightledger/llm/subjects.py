"""Subject areas of documents, by labels propagated over the graph of passages and the terms they share.

Two passages (sentences, lines) are similar through the terms they have in common, so labels pass from passages
to terms and from terms to passages, round by round until the terms settle; no pair of documents is ever built.
Only terms whose spread over the subjects is verified to be no chance (likelihood ratio) are nodes. Seeds are the
hand labels, and they are clamped: a passage of a labelled document can teach only the labels of that document,
and a labelled document whose labels the graph supports keeps them and no others.

Every distinct passage is one node, however many documents hold it, so that copies of a text, exact or nearly
so, have one vote together; its label goes back to all documents that hold it.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from nightledger.session import remove_path, ship_package, store

#: The label of passages that treat no subject; documents labelled with null seed it.
NONE = "(none)"
#: Verified terms up to this many are handed to every task (about 100 bytes each with ten subjects); more are
#: joined by shuffle.
BROADCAST_TERMS = 200_000
#: Label rows up to this many are broadcast.
BROADCAST_LABELS = 200_000
#: Texts cut at once, so that a worker holds few of them as words, and words whose hashes it remembers.
_SLICE, _REMEMBERED = 500, 200_000
_TAG = re.compile(r"<[^<>]*>")
_END = re.compile(r"(?<=[.!?…。！？])[\"»”’)\]]*\s+|\n+")
_WORD = re.compile(r"[^\W\d_]{2,}")


@dataclass(frozen=True)
class Rules:
    max_rounds: int = 10  # should the terms not have settled by then
    settled: float = 0.01  # the share of terms whose subject may still change in the last round
    least_words: int = 4  # of a passage that can carry a label; shorter lines only count
    least_term_count: float = 3.0
    least_ratio: float = 18.0  # likelihood ratio of a term's spread over the subjects
    least_purity: float = 0.35  # a term's share in its main subject
    least_part: float = 0.25  # a term's share in any other subject that it speaks for
    smoothing: float = 2.0
    label_score: float = 0.6  # from which a passage carries its best subject; a term of that subject only gives 1
    teach_score: float = 0.75  # from which it teaches its terms
    least_coverage: float = 0.5  # the share of a term's passages that carry a label; words of any passage stay below
    share: float = 0.2


def passages_of(text: str, least_words: int) -> tuple[int, list[list[str]]]:
    """How many sentences or lines have a word, and the distinct words of each with ``least_words``; markup is left out."""
    n, out = 0, []
    text = text.lower()
    if "<" in text:
        text = _TAG.sub("\n", text)
    for part in _END.split(text):
        ws = _WORD.findall(part)
        n += bool(ws)
        if len(ws) >= least_words:
            out.append(list(dict.fromkeys(ws)))
    return n, out


def passages(documents: DataFrame, doc_id: str, text: str, least_words: int) -> DataFrame:
    """(doc, c, n, p, terms): a row for each passage; c is a hash of the text, n its number of sentences, p a hash of the set of its terms, which are hashes too."""

    def cut(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        from xxhash import xxh3_64_intdigest as digest

        class Memory(dict):
            def __missing__(self, word: str) -> int:
                if len(self) >= _REMEMBERED:
                    self.clear()
                h = self[word] = digest(word.encode("utf-8", "surrogatepass"))
                return h

        memory = Memory()
        for batch in (b.slice(k, _SLICE) for b in batches for k in range(0, b.num_rows, _SLICE)):
            at, texts, counts, ends, flat = [], [], [], [0], []
            for i, raw in enumerate(batch.column(1).to_pylist()):
                n, found = passages_of(raw, least_words)
                at += [i] * len(found)
                counts += [n] * len(found)
                texts += [digest(raw.encode("utf-8", "surrogatepass"))] * len(found)
                for ws in found:
                    flat += map(memory.__getitem__, ws)
                    ends.append(len(flat))
            longs = lambda xs: pa.array(np.asarray(xs, np.uint64).view(np.int64))
            words = np.array(flat, np.uint64)
            # hashes of distinct words, mixed once more and added up: one for each set of words
            mixed = (words ^ (words >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15)
            mixed ^= mixed >> np.uint64(32)
            sets = np.add.reduceat(mixed, np.array(ends[:-1])) if len(ends) > 1 else words
            terms = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), longs(words))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at, pa.int64())), longs(texts), pa.array(counts, pa.int32()), longs(sets), terms], names=["doc", "c", "n", "p", "terms"])

    kind = documents.schema[doc_id].dataType.simpleString()
    d = documents.select(F.col(doc_id).alias("doc"), F.col(text).alias("text")).where("doc is not null and text is not null")
    return d.mapInArrow(cut, f"doc {kind}, c long, n int, p long, terms array<long>")


def _best_labels(offsets, flat, terms, weights):
    """Best label and its score of each passage: the sum of its terms' weights; 0 where no term is known."""
    import numpy as np

    if not len(terms) or not len(flat):
        return np.zeros(len(offsets) - 1, np.int64), np.zeros(len(offsets) - 1)
    at = np.minimum(np.searchsorted(terms, flat), len(terms) - 1)
    known = terms[at] == flat
    owner = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[known]
    met = weights.T[:, at[known]]
    sums = np.stack([np.bincount(owner, weights=w, minlength=len(offsets) - 1) for w in met], axis=1).round(9)
    # of equal scores the later label
    best = sums.shape[1] - 1 - np.argmax(sums[:, ::-1], axis=1)
    return best, sums[np.arange(len(best)), best]


def _columns(batch, names: tuple[str, ...]):
    """A batch's columns with the lists of ``terms`` as offsets and one flat array."""
    import numpy as np

    terms = batch.column("terms")
    offsets = terms.offsets.to_numpy() - terms.offsets[0].as_py()
    return [offsets, terms.flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False), *[batch.column(n) for n in names]]


@dataclass
class _Terms:
    """Verified terms with a weight for each label: as arrays in every task, or as a table if they are too many."""

    table: DataFrame
    path: str
    shared: object = None
    best: dict | None = None


class _Graph:
    """The distinct passages with the labels that they may teach, and the terms as they stand."""

    def __init__(self, nodes: DataFrame, labels: int, rules: Rules):
        self.nodes, self.labels, self.rules, self.spark = nodes, labels, rules, nodes.sparkSession

    def seeded(self) -> DataFrame:
        """(term, label, c) of the labelled passages alone."""
        d = self.nodes.where("own is not null").select(F.explode("terms").alias("term"), "own")
        return d.select("term", F.posexplode("own").alias("label", "c")).where("c > 0")

    def carried(self, terms: _Terms) -> DataFrame:
        """(term, label, c) of the passages that are sure enough of their label.

        Two further labels count the passages that a term stands in, and those of them that carry any label.
        """
        rules, labels = self.rules, self.labels
        none, seen, met = labels - 1, labels, labels + 1
        if terms.shared is None:
            d = self.nodes.join(_labels_by_join(self.nodes, terms.table), "p", "left")
            sure = (F.col("score") > rules.teach_score) & (F.col("own").isNull() | (F.col("label") == none) | (F.get("own", F.col("label")) > 0))
            each = F.array_compact(F.array(F.lit(seen), F.when(F.col("score") > rules.label_score, met), F.when(sure, F.col("label"))))
            return d.select(F.explode("terms").alias("term"), each.alias("each")).select("term", F.explode("each").alias("label"), F.lit(1.0).alias("c"))
        shared = terms.shared

        def teach(batches: Iterator) -> Iterator:
            import numpy as np
            import pyarrow as pa

            known, weights = shared.value
            for batch in batches:
                offsets, flat, own = _columns(batch, ("own",))
                label, score = _best_labels(offsets, flat, known, weights)
                allowed = np.ones((batch.num_rows, labels), bool)
                given = np.flatnonzero(own.is_valid().to_numpy(zero_copy_only=False))
                if len(given):
                    allowed[given] = own.flatten().to_numpy().reshape(-1, labels) > 0
                allowed[:, none] = True
                sure = (score > rules.teach_score) & allowed[np.arange(len(label)), label]
                size = np.diff(offsets)
                word, which = np.unique(flat, return_inverse=True)
                # a column for each label, one for all passages and one for those with any label
                tally = lambda of, on: np.bincount(which[on] * (labels + 2) + of[on], minlength=len(word) * (labels + 2))
                label = np.repeat(np.where(sure, label, -1), size)
                counts = tally(label, label >= 0) + tally(np.full(len(flat), met), np.repeat(score > rules.label_score, size)) + tally(np.full(len(flat), seen), np.ones(len(flat), bool))
                on = np.flatnonzero(counts)
                term, which, c = word[on // (labels + 2)], on % (labels + 2), counts[on]
                yield pa.RecordBatch.from_arrays([pa.array(term, pa.int64()), pa.array(which, pa.int32()), pa.array(c, pa.float64())], names=["term", "label", "c"])

        return self.nodes.select("terms", "own").mapInArrow(teach, "term long, label int, c double")

    def learn(self, taught: DataFrame) -> _Terms:
        """Weights of the terms that are verified by what was taught.

        A weight is the log of how far the label's share exceeds the usual, over what it is for a share of 1.
        """
        rules = self.rules
        sums = [F.sum(F.when(F.col("label") == i, F.col("c")).otherwise(0.0)).alias(f"c{i}") for i in range(self.labels + 2)]
        seen = Observation()
        counts, counts_path = store(taught.groupBy("term").agg(*sums).observe(seen, *[F.sum(f"c{i}").alias(f"c{i}") for i in range(self.labels)]), "term-counts")
        totals = [float(seen.get[f"c{i}"] or 0.0) for i in range(self.labels)]
        whole = sum(totals) or 1.0
        usual = [t / whole for t in totals]
        c, total = [F.col(f"c{i}") for i in range(self.labels)], F.col("total")
        zero = F.lit(0.0)
        ratio, weights = zero, []
        for x, p in zip(c, usual):
            if p == 0:
                weights.append(zero)
                continue
            ratio = ratio + F.when(x > 0, 2 * x * F.log(x / (total * p))).otherwise(0.0)
            w = F.log((x + rules.smoothing * p) / (total + rules.smoothing) / p) / max(-math.log(p), 1e-9)
            weights.append(F.when(x >= total * rules.least_part, F.greatest(w, zero)).otherwise(0.0))
        d = counts.withColumn("total", sum(c[1:], c[0]))
        covered = F.col(f"c{self.labels + 1}") >= F.col(f"c{self.labels}") * rules.least_coverage
        kept = covered & (total >= rules.least_term_count) & (ratio >= rules.least_ratio) & (F.greatest(*c) >= total * rules.least_purity)
        table, path = store(d.where(kept).select("term", F.array(*weights).alias("weights")).where(F.exists("weights", lambda w: w > 0)), "term-weights")
        remove_path(self.spark, counts_path)
        terms = _Terms(table, path)
        if table.count() <= BROADCAST_TERMS:
            import numpy as np

            got = sorted((r["term"], r["weights"]) for r in table.collect())
            known, matrix = np.array([t for t, _ in got], np.int64), np.array([w for _, w in got]).reshape(-1, self.labels)
            terms.shared = self.spark.sparkContext.broadcast((known, matrix))
            terms.best = dict(zip(known.tolist(), matrix.argmax(axis=1).tolist())) if len(known) else {}
        return terms

    def settled(self, before: _Terms, after: _Terms) -> bool:
        if before.best is not None and after.best is not None:
            moved = sum(before.best.get(t) != v for t, v in after.best.items()) + sum(t not in after.best for t in before.best)
            return moved <= self.rules.settled * max(1, len(after.best))
        top = lambda t, name: t.table.select("term", F.array_position("weights", F.array_max("weights")).alias(name))
        both = top(before, "x").join(top(after, "y"), "term", "full_outer").agg(F.count("*").alias("n"), F.count_if(~F.col("x").eqNullSafe(F.col("y"))).alias("moved")).first()
        return both["moved"] <= self.rules.settled * max(1, both["n"])

    def drop(self, terms: _Terms) -> None:
        if terms.shared is not None:
            terms.shared.unpersist()
        remove_path(self.spark, terms.path)


def _labels_by_join(cut: DataFrame, table: DataFrame) -> DataFrame:
    """(p, label, score) of the distinct passages with a verified term, by shuffle joins."""
    met = cut.select("p", F.explode("terms").alias("term")).join(table, "term").select("p", F.posexplode("weights").alias("label", "w")).where("w > 0")
    sums = met.groupBy("p", "label").agg(F.round(F.sum("w"), 9).alias("score"))
    best = sums.groupBy("p").agg(F.max(F.struct("score", "label")).alias("best"))
    return best.select("p", F.col("best.label").cast("int").alias("label"), "best.score")


def _counts_of_documents(held: DataFrame, nodes: DataFrame, terms: _Terms, rules: Rules, none: int) -> DataFrame:
    """(doc, c, n, label, k): how many passages of each text carry each subject; rows may be parts of the sum."""
    if terms.shared is None:
        found = _labels_by_join(nodes, terms.table).where((F.col("score") > rules.label_score) & (F.col("label") != none))
        return held.select("doc", "c", "n", "p").join(found, "p").groupBy("doc", "c", "n", "label").agg(F.count("*").alias("k"))
    shared = terms.shared

    def count(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        known, weights = shared.value
        for batch in batches:
            offsets, flat, doc, c, n = _columns(batch, ("doc", "c", "n"))
            label, score = _best_labels(offsets, flat, known, weights)
            on = np.flatnonzero((score > rules.label_score) & (label != none))
            rows = pa.table({"doc": doc.take(pa.array(on)), "c": c.take(pa.array(on)), "n": n.take(pa.array(on)), "label": pa.array(label[on], pa.int32())})
            yield from rows.group_by(["doc", "c", "n", "label"]).aggregate([([], "count_all")]).rename_columns(["doc", "c", "n", "label", "k"]).to_batches()

    kind = held.schema["doc"].dataType.simpleString()
    return held.select("doc", "c", "n", "terms").mapInArrow(count, f"doc {kind}, c long, n int, label int, k long")


def subjects(
    documents: DataFrame, doc_id: str, text: str, areas: DataFrame, labels: DataFrame, label_doc: str, subject: str, rules: Rules | None = None
) -> DataFrame:
    """Every document with every subject that at least ``rules.share`` of its sentences treat.

    ``areas`` lists the subjects in ``subject``; ``labels`` has documents' subjects, one row each, null for
    none. Labels outside the list are ignored, repeated ones count once. A labelled document is trusted if each
    of its subjects is carried by one of its passages at least: then it has these subjects and no others.

    Defined results: null, empty and wordless texts have no subject; rows of one ``doc_id`` with different
    texts are looked at one by one; without any labels there is nothing to propagate and no rows.
    Columns: ``doc_id``, ``subject``, ``share``.
    """
    rules = rules or Rules()
    spark = documents.sparkSession
    ship_package(spark)
    held, held_path = store(passages(documents, doc_id, text, rules.least_words), "passages")
    names = [*sorted(r[0] for r in areas.select(subject).where(F.col(subject).isNotNull()).distinct().collect()), NONE]
    number = F.array_position(F.array(*[F.lit(x) for x in names]), F.coalesce(subject, F.lit(NONE))).cast("int") - 1
    seeds = labels.select(F.col(label_doc).alias("doc"), number.alias("label")).where("doc is not null and label >= 0")
    seeds, seeds_path = store(seeds.groupBy("doc").agg(F.collect_set("label").alias("own")), "seeds")
    small = (lambda d: F.broadcast(d)) if seeds.count() <= BROADCAST_LABELS else (lambda d: d)
    # a text's labels are averaged over its labelled copies, a passage's over the labelled texts that hold it
    parts = [F.sum(F.when(F.array_contains("own", F.lit(i)), 1 / F.size("own")).otherwise(0.0)) for i in range(len(names))]
    own = held.select("doc", "c").join(small(seeds), "doc").distinct().groupBy("c").agg(F.count("*").alias("docs"), F.array(*parts).alias("s"))
    own = own.select("c", F.transform("s", lambda x: x / F.col("docs")).alias("s"))
    each = held.select("c", "p").join(small(own), "c").distinct().groupBy("p").agg(F.array(*[F.avg(F.get("s", F.lit(i))) for i in range(len(names))]).alias("own"))
    nodes, nodes_path = store(held.select("p", "terms").dropDuplicates(["p"]).join(each, "p", "left"), "nodes")
    graph = _Graph(nodes, len(names), rules)
    terms = graph.learn(graph.seeded())
    for _ in range(rules.max_rounds - 1):
        following = graph.learn(graph.carried(terms))
        done = graph.settled(terms, following)
        graph.drop(terms)
        terms = following
        if done:
            break
    counts = _counts_of_documents(held, nodes, terms, rules, len(names) - 1)
    areas_of = range(len(names) - 1)
    ks = F.array(*[F.sum(F.when(F.col("label") == i, F.col("k")).otherwise(0)) for i in areas_of])
    docs = counts.groupBy("doc", "c", "n").agg(ks.alias("ks")).join(small(seeds), "doc", "left")
    mine = F.filter("own", lambda i: i < len(names) - 1)
    trusted = F.coalesce((F.size(mine) > 0) & F.forall(mine, lambda i: F.get("ks", i) > 0), F.lit(False))
    treated = lambda i: F.when(trusted, F.array_contains("own", F.lit(i))).otherwise(F.get("ks", F.lit(i)) >= F.col("n") * rules.share - 1e-9)
    rows = F.array(*[F.when(treated(i), F.struct(F.lit(names[i]).alias("subject"), (F.get("ks", F.lit(i)) / F.col("n")).alias("share"))) for i in areas_of])
    out, _ = store(docs.select(F.col("doc").alias("doc_id"), F.inline(F.array_compact(rows))), "subjects")
    graph.drop(terms)
    for p in (held_path, nodes_path, seeds_path):
        remove_path(spark, p)
    return out
