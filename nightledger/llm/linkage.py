"""Deduplicating new batches against everything accepted before, without reading all of it again.

The history is a table of blocking keys: one row for each distinct code of a block, with the first record
that bore it, laid down by batch and by the snapshot the records belong to. A batch reads the snapshots that
it has rows of, and only what lies in its own blocks leaves the scan: the batch moves, the history doesn't.
Pairs within blocks are compared field by field; weights learned from all pairs so far score them. Each code
carries the representative that its cluster had when it came; where a batch joins clusters, the absorbed
representatives are entered in a table of merges, and nothing else is touched.

A batch counts once its commit file is written, last of all: what a failed attempt left behind is never read,
and the batch can simply be accepted again.
"""

from __future__ import annotations

import json
import math
from collections import Counter
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from datetime import date

import pandas as pd
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from nightledger.functions.text import canonical_url, digits_only, finite, null_marked
from nightledger.session import list_names, new_table_path, read_bytes, remove_path, ship_package, store, write_bytes

#: Blocks of more codes than this are joined by deletion variants instead of all against all.
HOT_BLOCK = 200
#: Codes up to this long have their variants enumerated; longer ones in a hot block meet by block and length.
VARIANT_LENGTH = 64
#: Blocks of a batch, and groups with links, up to which they are broadcast; more are joined by shuffle.
BROADCAST_ROWS = 200_000
#: Batches whose rows of one snapshot lie side by side before they are written together.
MAX_GENERATIONS = 12
KEY = ["part", "b1", "b2"]
_STATE = "b1 long, b2 long, code string, first_id long, num double, txt long, rep long, part date"
_MERGES = "part date, member long, representative long, batch int"
_ROWS = "id long, member long, repeat boolean"
_LINKS = "id long, other long, pattern int"


def edit_level(a: Column, b: Column) -> Column:
    """0 to 2 edits, 3 for more."""
    d = F.levenshtein(a, b, 2)
    return F.when(a == b, 0).when(F.abs(F.length(a) - F.length(b)) > 2, 3).when(d < 0, 3).otherwise(d)


def number_level(a: Column, b: Column) -> Column:
    """0 missing, 1 equal, 2 within a twentieth, 3 else."""
    gap = F.abs(a - b)
    return F.when(gap.isNull(), 0).when(gap == 0, 1).when(gap <= 0.05 * F.greatest(F.abs(a), F.abs(b)), 2).otherwise(3)


def text_level(a: Column, b: Column) -> Column:
    return F.when(a.isNull() | b.isNull(), 0).when(a == b, 1).otherwise(2)


LEVELS = {"edits": 4, "number": 4, "text": 3}
PATTERNS = math.prod(LEVELS.values())


def pattern_of(levels: dict[str, Column]) -> Column:
    """One number for a combination of levels."""
    out = F.lit(0)
    for name, size in LEVELS.items():
        out = out * size + levels[name]
    return out


def levels_of(pattern: int) -> tuple[int, ...]:
    out = []
    for size in reversed(LEVELS.values()):
        pattern, level = divmod(pattern, size)
        out.append(level)
    return tuple(reversed(out))


@dataclass
class Weights:
    """Log2 odds of each level of each field, and the log2 odds of a match before any field is seen."""

    odds: dict[str, list[float]]
    prior: float

    def scores(self) -> list[float]:
        """The score of each pattern: the sum of its levels' odds and the prior; from 0 on a match is likelier than not."""
        return [self.prior + sum(self.odds[n][v] for n, v in zip(LEVELS, levels_of(p))) for p in range(PATTERNS)]


def learn_weights(counts: Sequence[float], rounds: int = 20) -> Weights:
    """Fellegi-Sunter weights by expectation-maximization over the counts of all patterns.

    There are 48 patterns, whatever the number of pairs, so the counts of all batches add up in one list.
    """
    names = list(LEVELS)
    m = {n: [1.0] * k for n, k in LEVELS.items()}
    u = {n: [1.0] * k for n, k in LEVELS.items()}
    m["edits"], u["edits"] = [8.0, 6.0, 4.0, 1.0], [1.0, 1.0, 1.0, 8.0]
    share = 0.5
    total = sum(counts)
    for d in (m, u):
        for n in names:
            d[n] = [x / sum(d[n]) for x in d[n]]
    for _ in range(rounds if total else 0):
        mm = {n: [0.5] * k for n, k in LEVELS.items()}
        uu = {n: [0.5] * k for n, k in LEVELS.items()}
        hit = 0.0
        for pattern, count in enumerate(counts):
            levels = levels_of(pattern)
            pm, pu = share, 1 - share
            for n, v in zip(names, levels):
                pm, pu = pm * m[n][v], pu * u[n][v]
            p = pm / (pm + pu) if pm + pu else 0.0
            hit += p * count
            for n, v in zip(names, levels):
                mm[n][v] += p * count
                uu[n][v] += (1 - p) * count
        m = {n: [x / sum(mm[n]) for x in mm[n]] for n in names}
        u = {n: [x / sum(uu[n]) for x in uu[n]] for n in names}
        share = min(max(hit / total, 1e-6), 1 - 1e-6)
    odds = {n: [math.log2(a / b) for a, b in zip(m[n], u[n])] for n in names}
    return Weights(odds, math.log2(share / (1 - share)))


def deletion_variants(code: Column) -> Column:
    """Hashes of a code with up to two characters left out: codes within two edits share one."""
    n = F.length(code)
    without = lambda s, i: F.concat(F.substring(s, F.lit(1), i - 1), F.substring(s, i + 1, F.length(s)))
    upto = lambda a, b: F.when(a <= b, F.sequence(a, b)).otherwise(F.array().cast("array<int>"))
    one = F.transform(upto(F.lit(1), n), lambda i: F.struct(i.alias("i"), without(code, i).alias("s")))
    two = F.flatten(F.transform(one, lambda o: F.transform(upto(o["i"], n - 1), lambda j: without(o["s"], j))))
    return F.transform(F.array_distinct(F.concat(F.array(code), F.transform(one, lambda o: o["s"]), two)), lambda s: F.xxhash64(s))


@dataclass
class IncrementalLinker:
    """Takes batches in the order they arrive; everything it knows lies in its folder.

    Batches have the columns ``id`` (long, rising from batch to batch), ``part`` (date), ``b1``, ``b2``
    (the block), ``code``, ``num``, ``txt`` (hash of a text). A record repeats another if both lie in one block and their
    codes are at most ``max_edits`` edits apart, whatever the weights say; these score the links.

    Defined results: records with a null among the block's fields or a null code are never repeats, form
    clusters of their own and don't enter the history; records without an id take no part; an empty batch
    changes nothing; a record delivered twice is a repeat if its ids differ.
    """

    spark: SparkSession
    path: str
    batch: int = 0
    live: dict[str, list[str]] = field(default_factory=dict)  # snapshot: folders of the history that hold rows of it
    merged: list[int] = field(default_factory=list)  # batches that entered merges
    patterns: list[int] = field(default_factory=lambda: [0] * PATTERNS)
    largest: dict[str, int] = field(default_factory=dict)  # snapshot: a bound of the codes in any of its blocks
    max_edits: int = 2
    max_generations: int = MAX_GENERATIONS

    @classmethod
    def create(cls, spark: SparkSession) -> IncrementalLinker:
        return cls(spark, new_table_path(spark, "linkage"))

    @classmethod
    def resume(cls, spark: SparkSession, path: str) -> IncrementalLinker:
        """Go on from a folder, after the last batch that was committed there."""
        commits = [int(n) for n in list_names(spark, f"{path}/commits") if n.isdigit()]
        return cls(spark, path, **(json.loads(read_bytes(spark, f"{path}/commits/{max(commits)}")) if commits else {}))

    @property
    def weights(self) -> Weights:
        """Learned from the pairs of all batches so far."""
        return learn_weights(self.patterns)

    def _commit(self) -> None:
        state = {"batch": self.batch, "live": self.live, "merged": self.merged, "patterns": self.patterns, "largest": self.largest}
        write_bytes(self.spark, f"{self.path}/commits/{self.batch}", json.dumps(state).encode())

    def _history(self, parts: Sequence[str]) -> DataFrame:
        """Committed codes of the given snapshots."""
        folders = [f"{self.path}/history/gen={g}/part={p}" for p in parts for g in self.live.get(p, [])]
        if not folders:
            return self.spark.createDataFrame([], _STATE)
        return self.spark.read.schema(_STATE).option("basePath", f"{self.path}/history").parquet(*folders).drop("gen")

    def accept(self, rows: DataFrame) -> DataFrame | None:
        """Link a batch, take it into the history, and return the ids of its repeats (column ``id``)."""
        ship_package(self.spark)
        rows = rows.where(F.col("id").isNotNull())
        whole = F.col("part").isNotNull() & F.col("b1").isNotNull() & F.col("code").isNotNull()
        groups, groups_path = store(
            # all of fixed width, so that it combines by hash before the shuffle
            rows.where(whole)
            .groupBy(*KEY, "code")
            .agg(F.min("id").alias("first_id"), F.max("id").alias("last_id"), F.count("*").alias("n"), F.min_by("num", "id").alias("num"), F.min_by("txt", "id").alias("txt")),
            "batch-groups",
        )
        # one row for each snapshot that the batch holds rows of
        sizes = groups.groupBy(*KEY).agg(F.count("*").alias("codes"), F.count_if(F.col("n") > 2).alias("many"))
        sizes = sizes.groupBy("part").agg(F.max("codes").alias("codes"), F.count("*").alias("blocks"), F.sum("many").alias("many"))
        found = {r["part"].isoformat(): r for r in sizes.collect()}
        old = [p for p in found if p in self.live]
        members = groups.withColumns({"known": F.lit(False), "rep": F.col("first_id")}).drop("last_id", "n")
        if old:
            blocks = groups.where(F.col("part").isin([date.fromisoformat(p) for p in old])).select(*KEY).distinct()
            if sum(found[p]["blocks"] for p in old) <= BROADCAST_ROWS:
                blocks = F.broadcast(blocks)
            known = self._history(old).join(blocks, KEY, "left_semi")
            members = members.unionByName(known.withColumn("known", F.lit(True)).select(members.columns))
        temporary = [groups_path]
        # a block can't hold more codes than the largest ones of its batches together: most batches need no look
        largest = self.largest | {p: self.largest.get(p, 0) + r["codes"] for p, r in found.items()}
        hot = None
        if max((largest[p] for p in found), default=0) > HOT_BLOCK:
            many = members.groupBy(*KEY).agg(F.count("*").alias("codes")).where(F.col("codes") > HOT_BLOCK).select(*KEY)
            hot, hot_path = store(many, "hot-blocks")
            temporary.append(hot_path)
            hot = None if hot.isEmpty() else hot
        pairs = self._pairs(members, hot)
        levels = {"edits": edit_level(F.col("g.code"), F.col("o.code")), "number": number_level(F.col("g.num"), F.col("o.num")), "text": text_level(F.col("g.txt"), F.col("o.txt"))}
        pairs = pairs.select(*KEY, F.col("g.code").alias("code"), F.col("g.first_id").alias("id"), F.col("o.first_id").alias("other"), F.col("o.rep").alias("rep"), F.col("o.known").alias("known"), (F.col("g.code") == F.col("o.code")).alias("same"), pattern_of(levels).alias("pattern"))
        seen = Observation()
        pairs = pairs.observe(seen, *[F.count_if(F.col("pattern") == k).alias(f"p{k}") for k in range(PATTERNS)])
        near = [k for k in range(PATTERNS) if levels_of(k)[0] <= self.max_edits]  # the exact check
        links, links_path = store(pairs.where(F.col("pattern").isin(near)), "batch-links")
        temporary.append(links_path)
        counts = [int(seen.get[f"p{k}"]) for k in range(PATTERNS)] if found else [0] * PATTERNS
        linked = sum(counts[k] for k in near)
        joined = Observation()
        folded, folded_path = store(self._fold_clusters(links, hot, old).observe(joined, F.count_if(F.col("joins") & F.col("known")).alias("n")), "batch-clusters")
        temporary.append(folded_path)
        reps = folded.where("not known").groupBy(F.col("member").alias("first_id")).agg(F.min("representative").alias("rep"))
        verdict = links.groupBy(*KEY, "code").agg(F.min("id").alias("first_id"), F.min("other").alias("other"), F.min(F.when(F.col("same"), F.col("other"))).alias("same_as"))
        verdict = verdict.join(reps, "first_id", "left").drop("first_id")
        done = groups.join(F.broadcast(verdict) if linked <= BROADCAST_ROWS else verdict, [*KEY, "code"], "left")
        # written once for the jobs below: each of them would join it anew
        done, done_path = store(done.withColumns({"least_id": F.least("first_id", "other"), "member": F.coalesce("same_as", "first_id")}), "batch-verdict")
        temporary.append(done_path)
        fresh = done.where(F.col("same_as").isNull()).select("b1", "b2", "code", "first_id", "num", "txt", F.coalesce("rep", "first_id").alias("rep"), "part")
        row = lambda c: F.struct(F.col(c).alias("id"), F.col("member").alias("member"), (F.col(c) > F.col("least_id")).alias("repeat"))
        # of a code with one or two rows all ids are known; the rows of others are looked up
        out = done.select(F.inline(F.array_compact(F.array(F.when(F.col("other").isNotNull(), row("first_id")), F.when((F.col("n") == 2) & (F.col("last_id") > F.col("first_id")), row("last_id"))))))
        many = sum(r["many"] for r in found.values())
        if many:
            more = done.where("n > 2").select(*KEY, "code", "first_id", "least_id", "member")
            each = rows.where(whole).join(F.broadcast(more) if many <= BROADCAST_ROWS else more, [*KEY, "code"])
            out = out.unionByName(each.where(F.col("id") > F.col("first_id")).select(row("id").alias("r")).select("r.*"))
        out = out.unionByName(rows.where(~whole).select("id", F.col("id").alias("member"), F.lit(False).alias("repeat")))
        to = {k: f"{self.path}/{k}/{name}={self.batch}" for k, name in (("history", "gen"), ("rows", "batch"), ("links", "batch"), ("merges", "batch"))}
        jobs = [lambda: out.write.mode("overwrite").parquet(to["rows"])]
        if found:
            jobs += [lambda: fresh.write.mode("overwrite").partitionBy("part").parquet(to["history"]), lambda: links.select("id", "other", "pattern").write.mode("overwrite").parquet(to["links"])]
        if found and joined.get["n"]:
            merges = self._new_merges(folded.where("known and member <> representative"))
            jobs.append(lambda: merges.write.mode("overwrite").parquet(to["merges"]))
            self.merged = [*self.merged, self.batch]
        with ThreadPoolExecutor(len(jobs)) as several:  # jobs that don't wait for each other
            for j in [several.submit(j) for j in jobs]:
                j.result()
        written = [n.removeprefix("part=") for n in list_names(self.spark, to["history"]) if n.startswith("part=")] if found else []
        self.live = self.live | {p: [*self.live.get(p, []), str(self.batch)] for p in written}
        self.patterns = [a + b for a, b in zip(self.patterns, counts)]
        self.largest = largest
        self.batch += 1
        self._commit()
        for p in temporary:
            remove_path(self.spark, p)
        self._compact()
        return self.spark.read.schema(_ROWS).parquet(to["rows"]).where("repeat").select("id")

    def _compact(self) -> None:
        """Write together what too many batches wrote of a snapshot; the old folders go once that is committed."""
        crowded = [p for p, gens in self.live.items() if len(gens) > self.max_generations]
        if not crowded:
            return
        gen = f"{self.batch - 1}c"
        self._history(crowded).write.mode("overwrite").partitionBy("part").parquet(f"{self.path}/history/gen={gen}")
        gone = [f"{self.path}/history/gen={g}/part={p}" for p in crowded for g in self.live[p]]
        self.live = self.live | {p: [gen] for p in crowded}
        self._commit()
        for p in gone:
            remove_path(self.spark, p)

    def rows(self) -> DataFrame:
        """(id, member, repeat) of all rows but those that stand in the history without a link."""
        if self.batch == 0:
            return self.spark.createDataFrame([], _ROWS)
        return self.spark.read.schema(_ROWS).parquet(*[f"{self.path}/rows/batch={b}" for b in range(self.batch)])

    def repeats(self) -> DataFrame:
        """The ids of the repeats of all batches so far."""
        return self.rows().where("repeat").select("id")

    def scored_links(self) -> DataFrame:
        """(id, other, edits, score, probability): the first row of a code with each linked one's, by today's weights."""
        folders = [f"{self.path}/links/batch={b}" for b in range(self.batch)]
        links = self.spark.read.schema(_LINKS).parquet(*folders) if folders else self.spark.createDataFrame([], _LINKS)
        score = F.get(F.array(*[F.lit(s) for s in self.weights.scores()]), F.col("pattern"))
        edits = F.floor(F.col("pattern") / (PATTERNS // LEVELS["edits"])).cast("int")
        return links.select("id", "other", edits.alias("edits"), score.alias("score"), (1 / (1 + F.pow(F.lit(2.0), -score))).alias("probability"))

    def forget(self) -> None:
        """Remove all but what was decided on rows: for a linker that takes no further batch and lists no clusters."""
        for p in ("history", "links", "merges", "commits"):
            remove_path(self.spark, f"{self.path}/{p}")

    @staticmethod
    def _pairs(members: DataFrame, hot: DataFrame | None) -> DataFrame:
        """Each code of the batch (g) with the known and the earlier ones (o) of its block."""
        cols = ["code", "first_id", "num", "txt", "rep", "known"]
        earlier = F.col("o.known") | (F.col("o.first_id") < F.col("g.first_id")) | ((F.col("o.first_id") == F.col("g.first_id")) & (F.col("o.code") < F.col("g.code")))
        cool = members if hot is None else members.join(hot, KEY, "left_anti")
        # at most HOT_BLOCK members a block, of which those alone in theirs leave at once
        blocks = cool.groupBy(*KEY).agg(F.collect_list(F.struct(*cols)).alias("m")).where((F.size("m") > 1) & F.exists("m", lambda x: ~x["known"]))
        out = blocks.select(*KEY, F.explode(F.filter("m", lambda x: ~x["known"])).alias("g"), "m").select(*KEY, "g", F.explode("m").alias("o")).where(earlier)
        if hot is None:
            return out

        def within(g: DataFrame, o: DataFrame, more: str) -> DataFrame:
            on = earlier
            for k in [*KEY, more]:
                on &= F.col(f"g.{k}") == F.col(f"o.{k}")
            return g.alias("g").join(o.alias("o"), on).select(*[F.col(f"g.{k}").alias(k) for k in KEY], *[F.struct(*[F.col(f"{s}.{c}").alias(c) for c in cols]).alias(s) for s in "go"])

        both = members.join(hot, KEY, "left_semi")
        new = both.where("not known")
        short = F.length("code") <= VARIANT_LENGTH
        keyed = lambda d: d.where(short).withColumn("variant", F.explode(deletion_variants(F.col("code"))))
        near = within(keyed(new), keyed(both), "variant").distinct()
        shifted = lambda d, by: d.where(~short | (F.length("code") > VARIANT_LENGTH - 2)).withColumn("size", F.explode(F.array(*[F.length("code") + k for k in by])))
        long = within(shifted(new, [0]), shifted(both, range(-2, 3)), "size").where((F.length("g.code") > VARIANT_LENGTH) | (F.length("o.code") > VARIANT_LENGTH))
        return out.unionByName(near).unionByName(long)

    def _merges(self) -> DataFrame | None:
        """(part, member, representative): where absorbed representatives went, their last entry each."""
        if not self.merged:
            return None
        log = self.spark.read.schema(_MERGES).parquet(*[f"{self.path}/merges/batch={b}" for b in self.merged])
        return log.groupBy("part", "member").agg(F.max("batch").alias("batch"), F.max_by(-F.col("representative"), F.struct("batch", -F.col("representative"))).alias("minus")).select("part", "member", (-F.col("minus")).alias("representative"))

    def _fold_clusters(self, links: DataFrame, hot: DataFrame | None, parts: Sequence[str]) -> DataFrame:
        """(part, member, known, representative, joins) of what the batch's links touch: new first ids and known representatives.

        ``joins`` says whether more than one known representative may have come together in the cluster.

        Links lie within blocks, so each block's are folded by union-find on their own; blocks too large
        for that go through repeated joins.
        """
        edges = links.select(*KEY, "id", F.when(F.col("known"), F.col("rep")).otherwise(F.col("other")).alias("other"), "known")
        merges = self._merges() if parts else None
        if merges is not None:
            now = merges.select("part", F.col("member").alias("other"), F.col("representative").alias("now"))
            edges = edges.join(now, ["part", "other"], "left").select(*KEY, "id", F.when(F.col("known"), F.coalesce("now", "other")).otherwise(F.col("other")).alias("other"), "known")
        big = None
        if hot is not None:
            big = edges.join(hot, KEY, "left_semi")
            edges = edges.join(hot, KEY, "left_anti")
        blocks = edges.groupBy(*KEY).agg(F.collect_set(F.struct("id", "other", "known")).alias("edges"))
        out = blocks.select("part", F.explode(_fold("edges")).alias("x")).select("part", "x.member", "x.known", "x.representative", "x.joins")
        if big is not None:
            ends = big.select("part", F.col("other").alias("member"), "known").unionByName(big.select("part", F.col("id").alias("member"), F.lit(False).alias("known")))
            labels = _components_by_joins(big.select("id", "other"))
            out = out.unionByName(ends.groupBy("part", "member").agg(F.max("known").alias("known")).join(labels, "member").select("part", "member", "known", "representative", F.lit(True).alias("joins")))
        return out

    def _new_merges(self, merges: DataFrame) -> DataFrame:
        new = merges.select("part", "member", "representative")
        before = self._merges()
        if before is not None:  # what had gone to a representative that is absorbed now goes on with it
            moved = new.select("part", F.col("member").alias("was"), F.col("representative").alias("now"))
            before = before.withColumnRenamed("representative", "was").join(moved, ["part", "was"])
            new = new.unionByName(before.select("part", "member", F.col("now").alias("representative")))
        return new.withColumn("batch", F.lit(self.batch))

    def clusters(self) -> DataFrame:
        """(id, representative): each row that was accepted and the least id of its cluster."""
        codes = self._history(list(self.live)).select("part", F.col("first_id").alias("member"), "rep")
        merges = self._merges()
        if merges is not None:
            now = merges.select("part", F.col("member").alias("rep"), "representative")
            codes = codes.join(now, ["part", "rep"], "left").select("member", F.coalesce("representative", "rep").alias("rep"))
        codes = codes.groupBy("member").agg(F.min("rep").alias("rep"))
        # a row that repeats a code goes with its first row; one without a block stands for itself
        own = codes.select(F.col("member").alias("id"), F.col("rep").alias("representative"))
        others = self.rows().select("id", "member").join(own.select(F.col("id").alias("known")), F.col("id") == F.col("known"), "left_anti")
        return own.unionByName(others.join(codes, "member", "left").select("id", F.coalesce("rep", "member").alias("representative")))


def _fold(edges: str) -> Column:
    """Union-find over one block's edges (at most HOT_BLOCK nodes); representatives are least ids."""

    @F.pandas_udf("array<struct<member: long, known: boolean, representative: long, joins: boolean>>")
    def fold(blocks: pd.Series) -> pd.Series:
        out = []
        for block in blocks:
            parent: dict[int, int] = {}
            known: set[int] = set()

            def find(x: int, parent: dict[int, int] = parent) -> int:
                while parent.setdefault(x, x) != x:
                    parent[x] = parent[parent[x]]
                    x = parent[x]
                return x

            for e in block:
                if e["known"]:
                    known.add(e["other"])
                a, b = find(e["id"]), find(e["other"])
                if a != b:
                    parent[max(a, b)] = min(a, b)
            held = Counter(find(x) for x in known)
            out.append([{"member": x, "known": x in known, "representative": find(x), "joins": held[find(x)] > 1} for x in list(parent)])
        return pd.Series(out)

    return fold(F.col(edges))


def _components_by_joins(edges: DataFrame) -> DataFrame:
    """(member, representative) by passing on the least label until nothing changes."""
    both = edges.unionByName(edges.select(F.col("other").alias("id"), F.col("id").alias("other"))).distinct()
    both, _ = store(both, "edges")
    labels, path = store(both.select(F.col("id").alias("member")).distinct().withColumn("representative", F.col("member")), "labels")
    while True:
        heard = both.join(labels, F.col("other") == F.col("member")).groupBy("id").agg(F.min("representative").alias("heard"))
        nxt = labels.join(heard, F.col("member") == F.col("id")).select("member", F.least("representative", "heard").alias("near"), (F.col("heard") < F.col("representative")).alias("changed"))
        # jump: take over the label of one's label
        far = labels.select(F.col("member").alias("near"), F.col("representative").alias("far"))
        nxt, next_path = store(nxt.join(far, "near", "left").select("member", F.least("near", "far").alias("representative"), "changed"), "labels")
        changed = not nxt.where("changed").isEmpty()
        remove_path(edges.sparkSession, path)
        labels, path = nxt.select("member", "representative"), next_path
        if not changed:
            return labels


#: What two offers must have in common, besides their room.
SAME_SEARCH = ("checkin", "checkout", "adults", "children", "rooms", "currency", "market")


def offer_records(offers: DataFrame, *more: str) -> DataFrame:
    """``price_observations`` in the linker's columns, and the given ones besides."""
    plain = lambda c: F.regexp_replace(c, "^0+", "")
    room = F.when(F.col("room_id").isNotNull(), plain(digits_only("room_id"))).otherwise(plain(F.regexp_extract("block_id", "([0-9]+)", 1)))
    # the texts first, so that each is made once
    texts = offers.select(
        F.col("observation_id").alias("id"), F.col("snapshot_date").alias("part"), canonical_url("property_url").alias("url"), room.alias("room"),
        digits_only("block_id").alias("code"), finite("price_per_night").alias("num"), F.lower("room_name").alias("name"), *SAME_SEARCH, *more,
    )
    block = [F.col(c) for c in ("url", *SAME_SEARCH, "room")]
    whole = F.lit(True)
    for c in block:
        whole = whole & c.isNotNull()
    return texts.select(
        "id",
        "part",
        F.when(whole, F.xxhash64(*block)).alias("b1"),
        F.hash(*null_marked(*block)).cast("long").alias("b2"),
        "code",
        "num",
        F.when(F.col("name").isNotNull(), F.xxhash64("name")).alias("txt"),
        *more,
    )


def link_batches(offers: DataFrame, batch_column: str) -> IncrementalLinker:
    """Feed a table to a new linker batch by batch, in the order of ``batch_column``, null first.

    The table is read once, cut down to the linker's columns and laid down by batch, as deliveries would
    be; each batch then reads its own folder. The list of batches is one value for each delivery.
    """
    linker = IncrementalLinker.create(offers.sparkSession)
    landed, landed_path = store(offer_records(offers, batch_column), "batches", [batch_column])
    batches = sorted((r[0] for r in landed.select(batch_column).distinct().collect()), key=lambda x: (x is not None, x))
    for b in batches:
        linker.accept(landed.where(F.col(batch_column).eqNullSafe(F.lit(b))).drop(batch_column))
    remove_path(offers.sparkSession, landed_path)
    return linker
