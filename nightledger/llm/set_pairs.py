"""All similar pairs between set-valued records, by extended prefixes.

Sets whose intersection / union is at least ``t`` share at least ``l`` tokens among their first
``|s| - o + l`` ones, in any common order of all tokens, where ``o`` is the least intersection that a
partner needs. So they share a combination of ``l`` prefix tokens, and longer prefixes with larger
combinations give fewer candidates. ``l`` is chosen for each class of set sizes by what both would cost.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from nightledger.session import remove_path, ship_package, store

#: Tokens in more than 1 / this of all (set, token) rows get their true frequency as rank. There can't
#: be more than this many of them, so what reaches the tasks has a bound whatever the input is.
RANKED_TOKENS = 100_000
#: What handling one candidate pair costs, in signatures: it is joined twice with its sets and verified.
PAIR_COST = 3.0
MAX_COMBINATION = 4


def size_classes(threshold: float, least: int, largest: int) -> list[int]:
    """The first size of each class: partners lie in the same class or in the next."""
    bounds = [least]
    while bounds[-1] <= largest:
        bounds.append(math.floor(bounds[-1] / threshold + 1e-9) + 1)
    return bounds[:-1] if len(bounds) > 1 else bounds


def _ordered_sets(sets: DataFrame) -> DataFrame:
    """(set_id, n, ts): tokens in rank order, rare ones first, ties by hash."""
    seen = Observation()
    counts = sets.select(F.explode("ts").alias("h")).groupBy("h").agg(F.count("*").alias("n"))
    frequent, path = store(counts.observe(seen, F.sum("n").alias("total")).where("n > 1"), "token-counts")
    floor = max(2, (seen.get["total"] or 0) // RANKED_TOKENS + 1)
    ranks = sorted((r["h"], r["n"]) for r in frequent.where(F.col("n") >= floor).collect())  # RANKED_TOKENS at most
    remove_path(sets.sparkSession, path)
    shared = sets.sparkSession.sparkContext.broadcast(ranks)

    def order(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        known = np.array([h for h, _ in shared.value], np.int64)
        rank = np.array([n for _, n in shared.value], np.int64)
        for b in batches:
            lists = b.column("ts")
            offsets = lists.offsets.to_numpy() - lists.offsets[0].as_py()
            flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False)
            n = np.ones(len(flat), np.int64)
            if len(known):
                at = np.minimum(np.searchsorted(known, flat), len(known) - 1)
                n = np.where(known[at] == flat, rank[at], 1)
            owner = np.repeat(np.arange(b.num_rows), np.diff(offsets))
            ordered = flat[np.lexsort((flat, n, owner))]
            yield pa.RecordBatch.from_arrays([b.column("set_id"), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ordered))], names=["set_id", "ts"])

    return sets.select("set_id", "ts").mapInArrow(order, "set_id long, ts array<long>")


def _combinations(prefix: Column, n: int) -> Column:
    """One hash for each combination of ``n`` of the prefix's tokens, in their order."""
    last = F.size(prefix) - 1
    picked = F.transform(prefix, lambda t, i: F.struct(t.alias("h"), i.alias("i")))
    for _ in range(n - 1):
        picked = F.flatten(
            F.transform(
                picked,
                lambda c: F.transform(
                    F.when(c["i"] < last, F.sequence(c["i"] + 1, last)).otherwise(F.array().cast("array<int>")),
                    lambda j: F.struct(F.xxhash64(c["h"], F.get(prefix, j)).alias("h"), j.alias("i")),
                ),
            )
        )
    return F.transform(picked, lambda c: c["h"])


def _roles(ordered: DataFrame, threshold: float, bounds: list[int]) -> DataFrame:
    """Each set as a member of its own size class and, where it can have larger partners, of the next.

    ``need`` is the least intersection with any partner there.
    """
    n = F.size("ts")
    own = F.lit(0)
    for k, b in enumerate(bounds):
        own = F.when(n >= b, k).otherwise(own)
    first_of_next = F.element_at(F.array(*[F.lit(b) for b in bounds[1:]], F.lit(2**30)), F.col("own") + 1)
    d = ordered.withColumn("own", own).withColumn("next_from", first_of_next)
    need_own = F.ceil(n * threshold - 1e-9).cast("int")
    need_next = F.ceil((n + F.col("next_from")) * (threshold / (1 + threshold)) - 1e-9).cast("int")
    roles = F.array(
        F.struct(F.col("own").alias("home"), need_own.alias("need"), F.lit(True).alias("large")),
        F.when(n >= F.col("next_from") * threshold - 1e-9, F.struct((F.col("own") + 1).alias("home"), need_next.alias("need"), F.lit(False).alias("large"))),
    )
    return d.select("set_id", n.alias("n"), "ts", F.inline(F.array_compact(roles)))


def _signatures(roles: DataFrame, chosen: dict[int, int]) -> DataFrame:
    """(home, large, n, set_id, sig) with the combination size chosen for each home."""
    parts = []
    for l in sorted(set(chosen.values())):
        homes = [h for h, x in chosen.items() if x == l]
        prefix = F.slice("ts", 1, F.greatest(F.least(F.col("n"), F.col("n") - F.col("need") + l), F.lit(1)))
        parts.append(
            roles.where(F.col("home").isin(homes))
            .select("home", "large", "n", "set_id", "need", prefix.alias("p"))
            .select("home", "large", "n", "set_id", F.explode(_combinations(F.col("p"), l)).alias("sig"))
        )
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _chosen_sizes(roles: DataFrame, threshold: float, bounds: list[int], homes: list[int]) -> dict[int, int]:
    """The combination size of each home: one more as long as its pairs cost more than the next signatures.

    All sets are counted; what reaches the driver is one row for each size class.
    """
    chosen = {h: 1 for h in homes}
    open_homes = list(homes)
    pairs: dict[int, float] = {}
    costs: dict[int, float] = {}
    for l in range(1, MAX_COMBINATION + 1):
        if not open_homes:
            break
        sigs = _signatures(roles.where(F.col("home").isin(open_homes)), {h: l for h in open_homes})
        groups = sigs.groupBy("home", "sig").agg(F.count_if("large").alias("a"), F.count_if(~F.col("large")).alias("b"))
        a, b = F.col("a").cast("double"), F.col("b").cast("double")
        stat = groups.groupBy("home").agg(F.sum(a + b).alias("sigs"), F.sum(a * (a - 1) / 2 + a * b).alias("pairs")).collect()
        kept = []
        for r in stat:
            h = r["home"]
            cost = r["sigs"] + PAIR_COST * r["pairs"]
            if l == 1 or cost < costs[h]:
                chosen[h], costs[h] = l, cost
                pairs[h] = r["pairs"]
            # the least intersection in the home bounds the combination; more signatures than pairs can't pay
            if pairs[h] * PAIR_COST > 2 * r["sigs"] and l + 1 <= math.ceil(threshold * bounds[h] - 1e-9):
                kept.append(h)
        open_homes = kept
    return chosen


def similar_sets(sets: DataFrame, threshold: float = 0.8, least_size: int = 1) -> DataFrame:
    """Pairs of different sets with intersection / union of at least ``threshold``.

    ``sets`` has ``set_id`` (long) and ``ts`` (distinct hashes of the tokens), each set once. Columns ``a``, ``b``
    with a < b, and ``similarity``. Smaller sets than ``least_size`` take no part; an empty table gives no rows.
    """
    if not 0 < threshold <= 1:
        raise ValueError("the threshold must lie in (0, 1]")
    sets = sets.select("set_id", "ts").where(F.size("ts") >= max(1, least_size))
    stored, _ = store(_ordered_sets(sets), "ordered-sets")
    # one row for each size that occurs
    sizes = [r[0] for r in stored.select(F.size("ts").alias("n")).distinct().collect()]
    if not sizes:
        return sets.select(F.col("set_id").alias("a"), F.col("set_id").alias("b"), F.lit(0.0).alias("similarity")).limit(0)
    bounds = size_classes(threshold, max(1, least_size), max(sizes))
    roles = _roles(stored, threshold, bounds)
    homes = {max(k for k, b in enumerate(bounds) if b <= n) for n in sizes}
    homes |= {k + 1 for k in homes if k + 1 < len(bounds)}
    chosen = _chosen_sizes(roles, threshold, bounds, sorted(homes))
    # written once: the two sides of the join pick different rows, and would make them all twice
    sigs, _ = store(_signatures(roles, chosen), "signatures")
    left = sigs.where("large").select("home", "sig", F.col("n").alias("n_l"), F.col("set_id").alias("l"))
    right = sigs.select("home", "sig", F.col("n").alias("n_r"), F.col("set_id").alias("r"), F.col("large").alias("r_large"))
    candidates = (
        left.join(right, ["home", "sig"])
        .where((~F.col("r_large") | (F.col("l") < F.col("r"))) & (F.least("n_l", "n_r") >= F.greatest("n_l", "n_r") * threshold - 1e-9))
        .select(F.least("l", "r").alias("a"), F.greatest("l", "r").alias("b"))
        .distinct()
    )
    tokens_a = stored.select(F.col("set_id").alias("a"), F.col("ts").alias("ta"))
    tokens_b = stored.select(F.col("set_id").alias("b"), F.col("ts").alias("tb"))
    shared = F.size(F.array_intersect("ta", "tb"))
    similarity = shared / (F.size("ta") + F.size("tb") - shared)
    return candidates.join(tokens_a, "a").join(tokens_b, "b").select("a", "b", similarity.alias("similarity")).where(F.col("similarity") >= threshold)


def distinct_sets(records: DataFrame, record_id: str, tokens: Column, least_size: int) -> tuple[DataFrame, DataFrame]:
    """Records of one and the same set as one class: (sets of ``set_id``, ``name``, ``ts``; members of ``set_id``, ``id``).

    A class is named by the MD5 of its sorted tokens, and its number is a 64-bit hash of them; should two names
    ever have one number, classes are numbered one by one. Tokens go on as 64-bit hashes. Records with under
    ``least_size`` tokens or without an id take no part; repeated rows count once.
    """
    d = records.select(F.col(record_id).alias("id"), tokens.alias("tokens")).where(F.col("id").isNotNull() & (F.size("tokens") >= max(1, least_size)))
    hashes = F.transform("tokens", lambda t: F.xxhash64(t)).alias("ts")
    d, path = store(d.select("id", F.xxhash64("tokens").alias("set_id"), F.md5(F.array_join("tokens", "\x1f")).alias("name"), hashes), "record-sets")
    seen = Observation()
    sets = d.groupBy("set_id").agg(F.min("name").alias("name"), F.max("name").alias("last"), F.first("ts").alias("ts"))
    sets, _ = store(sets.observe(seen, F.count_if(F.col("name") != F.col("last")).alias("clashes")).drop("last"), "distinct-sets")
    members = d.select("set_id", "id").distinct()
    if seen.get["clashes"]:
        sets = d.groupBy("name").agg(F.first("ts").alias("ts")).select(F.monotonically_increasing_id().alias("set_id"), "name", "ts")
        sets, _ = store(sets, "distinct-sets")
        members = d.select("name", "id").distinct().join(sets.select("name", "set_id"), "name").select("set_id", "id")
    members, _ = store(members, "set-members")
    remove_path(records.sparkSession, path)
    return sets, members


def similar_records(records: DataFrame, record_id: str, tokens: Column, threshold: float = 0.8, least_size: int = 1) -> DataFrame:
    """Every two records whose token sets are similar, as ``id_a`` < ``id_b`` with ``similarity``.

    ``tokens`` gives the sorted distinct values of a record. Records of one and the same set form a
    class; classes are joined by ``similar_sets`` and then filled with their members, and the members
    of one class are pairs of similarity 1. Rows with a null id take no part; an id given twice with
    one set pairs once with others and never with itself.
    """
    ship_package(records.sparkSession)
    sets, members = distinct_sets(records, record_id, tokens, least_size)
    links = similar_sets(sets, threshold, least_size)
    ma = members.select(F.col("set_id").alias("a"), F.col("id").alias("x"))
    mb = members.select(F.col("set_id").alias("b"), F.col("id").alias("y"))
    across = links.join(ma, "a").join(mb, "b").select("x", "y", "similarity")
    within = ma.join(mb, (F.col("a") == F.col("b")) & (F.col("x") < F.col("y"))).select("x", "y", F.lit(1.0).alias("similarity"))
    return across.unionByName(within).where("x <> y").select(F.least("x", "y").alias("id_a"), F.greatest("x", "y").alias("id_b"), "similarity")


def classes_with_links(records: DataFrame, record_id: str, tokens: Column, threshold: float = 0.8, least_size: int = 1) -> DataFrame:
    """One row for each record that takes part: ``id``, its class ``set_id`` (by name) and ``links``, the other classes similar to its own."""
    ship_package(records.sparkSession)
    sets, members = distinct_sets(records, record_id, tokens, least_size)
    links = similar_sets(sets, threshold, least_size)
    counts = links.select(F.explode(F.array("a", "b")).alias("set_id")).groupBy("set_id").agg(F.count("*").alias("links"))
    named = sets.select("set_id", "name").join(counts, "set_id", "left")
    return members.join(named, "set_id").select("id", F.col("name").alias("set_id"), F.coalesce("links", F.lit(0).cast("long")).alias("links"))
