import math
import statistics

import numpy as np
import pytest
from nightledger.operators import models, quantiles, relational as rel, summaries, validation as val
from pyspark.sql import functions as F


def test_keep_one_first_last_nulls_and_ties(spark, rows):
    df = spark.createDataFrame([(1, "a", 5), (2, "a", 5), (3, None, 1), (4, None, None), (5, "b", None)], "id int, k string, v int").withColumns({"rank_": F.lit(1), "row_": F.lit("x")})
    assert rows(rel.keep_one(df, ["k"], [F.col("v"), F.col("id")]).select("id")) == [(1,), (4,), (5,)]
    assert rows(rel.keep_one(df, ["k"], [F.col("v"), F.col("id")], last=True).select("id")) == [(2,), (3,), (5,)]
    assert rel.keep_one(df.limit(0), ["k"], [F.col("id")]).count() == 0


def test_history(spark, rows):
    df = spark.createDataFrame([("a", 1, "x", 5.0), ("a", 2, None, None), ("a", 3, "y", 7.0), ("b", 1, None, 5.0), ("b", 2, "z", 5.0)], "k string, t int, s string, p double")
    assert rows(rel.previous(df, ["k"], "t", ["s"]).select("k", "t", "previous_s")) == [("a", 1, None), ("a", 2, "x"), ("a", 3, None), ("b", 1, None), ("b", 2, None)]
    assert rows(rel.carry_forward(df, ["k"], "t", ["s"]).select("k", "t", "s")) == [("a", 1, "x"), ("a", 2, "x"), ("a", 3, "y"), ("b", 1, None), ("b", 2, "z")]
    assert rows(rel.rank_descending(df, ["k"], "p", "r").select("k", "t", "r")) == [("a", 1, 2), ("a", 2, None), ("a", 3, 1), ("b", 1, 1), ("b", 2, 1)]
    assert rows(rel.latest(df, "t").select("k")) == [("a",)]
    assert rows(rel.fill_from_first(df, "k", "t", ["s"]).select("k", "t", "s")) == [("a", 1, "x"), ("a", 2, "x"), ("a", 3, "y"), ("b", 1, "z"), ("b", 2, "z")]
    assert rows(rel.later_run_wins(df, "k", "t").select("k", "t")) == [("a", 3), ("b", 2)]


def test_numbers_and_shards(spark):
    df = spark.range(0, 1003).select((F.col("id") * 7919 % 1003).alias("v"))
    got = {r["v"]: r["index"] for r in rel.number_rows(df, ["v"]).collect()}
    assert got == {v: v + 1 for v in range(1003)}
    sizes = [r["count"] for r in rel.shards(df, ["v"], 10).groupBy("shard").count().orderBy("shard").collect()]
    assert sizes == [101, 101, 101] + [100] * 7
    few = {r["v"]: r["shard"] for r in rel.shards(df.where("v < 3"), ["v"], 5).collect()}
    assert few == {0: 1, 1: 2, 2: 3}
    assert rel.number_rows(df.limit(0), ["v"]).count() == 0


def test_windows(spark, rows):
    df = spark.createDataFrame([(1, 7), (2, 14), (3, None)], "id int, lead int")
    pick = lambda w, **k: rows(df.where(rel.in_windows(w, df.columns, **k)).select("id"))
    assert pick([{"lead": 7}, {"id": 3}]) == [(1,), (3,)]
    assert pick([{"lead": 7, "id": 2}]) == [] and pick([]) == [(1,), (2,), (3,)] and pick([{"lead": None}]) == [(1,), (2,), (3,)]
    assert pick([{"season": "x", "id": 1}], on_missing="skip") == [(1,)] and pick([{"l": 14}], aliases={"l": "lead"}) == [(2,)]
    with pytest.raises(ValueError, match="no such column"):
        pick([{"season": "x"}])


def test_contexts_windows_and_upsert(spark, rows):
    a = spark.createDataFrame([("p", 1, None), ("q", 1, 2), ("r", 2, None)], "u string, lead int, stay int")
    assert rows(rel.in_contexts_of(a, a.where("u = 'p'"), ["lead", "stay", "absent"]).select("u")) == [("p",)]
    assert rel.in_contexts_of(a, a, ["absent"]).count() == 3
    assert rows(rel.missing_windows(a, a.where("u = 'q'"), ["u", "lead"]).select("u")) == [("p",), ("r",)]
    old = spark.createDataFrame([(1, "x", 2), (2, "x", 0)], "k int, v string, p int")
    new = spark.createDataFrame([(1, "y", 1), (3, "y", 0)], "k int, v string, p int")
    assert rows(rel.upsert(old, new, ["k"]).select("k", "v")) == [(1, "y"), (2, "x"), (3, "y")]
    again = rel.upsert(rel.upsert(old, new, ["k"]), new, ["k"])
    assert rows(again.select("k", "v")) == [(1, "y"), (2, "x"), (3, "y")]
    assert rows(rel.upsert(old, new.withColumn("p", F.lit(9)), ["k"], priority=F.col("p")).select("k", "v")) == [(1, "x"), (2, "x"), (3, "y")]


def test_reconcile(spark, rows):
    d = spark.createDataFrame([(1, "u", "A", "11"), (2, "u", "A", None), (3, "u", "B", " "), (4, "u", "A", "12")], "id int, u string, n string, r string")
    assert rows(rel.reconcile(d, d, ["u", "n"], "r", "id", "f").select("id", "r", "f")) == [(1, "11", False), (2, "11", True), (3, " ", False), (4, "12", False)]


def test_quantiles_interpolate(spark):
    data = {"a": [1.0, 2.0, 4.0, 8.0], "b": [5.0], "c": [None, math.nan], None: [3.0, 3.0, 9.0]}
    df = spark.createDataFrame([(g, v) for g, vs in data.items() for v in vs], "g string, v double")
    got = {r["g"]: r for r in quantiles.distribution(df, ["g"], F.col("v")).collect()}
    assert set(got) == {"a", "b", None}
    for g in ("a", "b", None):
        for q in (0.1, 0.25, 0.5, 0.75, 0.9):
            assert got[g][f"p{int(q * 100)}"] == pytest.approx(np.quantile(data[g], q))
        assert got[g]["n"] == len(data[g]) and got[g]["mean"] == pytest.approx(statistics.mean(data[g]))
    assert quantiles.medians(df.limit(0), ["g"], F.col("v")).count() == 0


def test_modes_missing_and_status(spark, rows):
    df = spark.createDataFrame([("u", "b"), ("u", "a "), ("u", "b"), ("u", "a"), ("v", " "), ("w", None)], "u string, n string")
    assert rows(summaries.modes(df, ["u"], "n", "m")) == [("u", "a")]
    assert rows(summaries.missing_shares(df)) == [("n", 0.1667), ("u", 0.0)]
    assert rows(summaries.missing_shares(df.limit(0))) == [("n", None), ("u", None)]
    assert rows(summaries.history_status([df.limit(0)], "u")) == [(0, "missing")]
    assert rows(summaries.history_status([df, df], "u")) == [(3, "ready")]


def test_contracts(spark, rows):
    df = spark.createDataFrame([(1, "a", -1.0), (2, None, 2.0), (2, "", 3.0)], "id int, n string, p double")
    rules = [val.Rule("name", val.blank("n"), "no name"), val.Rule("price", F.col("p") <= 0, "no price")]
    found = val.issues(df, rules, F.col("id"))
    assert rows(found) == [("name", "no name", "2"), ("name", "no name", "2"), ("price", "no price", "1")]
    assert rows(val.issue_counts(found.unionByName(val.duplicate_issues(df, ["id"], "twice")))) == [("name", 2), ("price", 1), ("twice", 1)]
    assert val.require(df, ["id"], ["id"]) is df
    for kw, text in (({"columns": ["x"]}, "missing"), ({"columns": [], "not_null": ["n"]}, "nulls"), ({"columns": [], "rules": rules}, "no name")):
        with pytest.raises(val.ContractError, match=text):
            val.require(df, **kw)
    with pytest.raises(val.ContractError, match="empty"):
        val.require(df.limit(0), [], allow_empty=False)


def test_least_squares_hc3_and_folds(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(200, 2))
    y = 3 + x @ [2.0, -1.0] + rng.normal(size=200) * (1 + abs(x[:, 0]))
    df = spark.createDataFrame([(*map(float, a), float(b)) for a, b in zip(x, y)] + [(None, 1.0, 1.0), (math.nan, 1.0, 1.0)], "a double, b double, y double")
    m = models.least_squares(df, ["a", "b"], "y")
    z = np.column_stack([np.ones(200), x])
    inv = np.linalg.inv(z.T @ z)
    beta = inv @ z.T @ y
    h = np.einsum("ij,jk,ik->i", z, inv, z)
    meat = z.T @ (z * (((y - z @ beta) / (1 - h)) ** 2)[:, None])
    assert m.coefficients == pytest.approx(beta) and m.errors == pytest.approx(np.sqrt(np.diag(inv @ meat @ inv)))
    g = spark.range(0, 300).select((F.col("id") % 17).cast("string").alias("g"))
    folds = models.group_folds(g, "g", 5).collect()
    assert len(folds) == 17 and {r["fold"] for r in folds} == set(range(5))


def test_folds_go_to_the_lightest(spark):
    rng = np.random.default_rng(2)
    for sizes in ([1000, 3, 3, 3, 2, 1, 1], [7] * 23 + [2] * 40 + [1] * 5, list(rng.integers(1, 9, 60))):
        data = [(f"g{k}",) for k, n in enumerate(sizes) for _ in range(n)]
        folds = {r["g"]: r["fold"] for r in models.group_folds(spark.createDataFrame(data, "g string"), "g", 4).collect()}
        load = [0] * 4
        for n in sorted(sizes, reverse=True):  # one by one
            load[load.index(min(load))] += int(n)
        got = [sum(int(n) for k, n in enumerate(sizes) if folds[f"g{k}"] == f) for f in range(4)]
        assert len(folds) == len(sizes) and sorted(got) == sorted(load)


def test_absurd_prices_count(spark, tmp_path, rows):
    from nightledger.plans import reference

    data = [(1, "a", 100.0, 3e9, 2), (2, "a", 25e6, math.nan, 1), (3, "a", math.nan, None, 1), (4, "a", -1.0, 50.0, 1), (5, "a", None, 80.0, 0)]
    spark.createDataFrame(data, "observation_id long, market string, price_per_night double, current_price_value double, stay_length_days int").write.parquet(str(tmp_path / "price_observations.parquet"))
    got = reference.agg05_price_distribution(spark, str(tmp_path)).first()
    assert (got["n"], got["least"], got["greatest"], got["mean"]) == (2, 100.0, 25e6, 12500050.0)
    assert rows(reference.sca02_price_text(spark, str(tmp_path))) == [(1, 100.0, 100.0), (2, 25e6, 25e6), (3, None, None), (4, -1.0, -1.0), (5, None, None)]
    assert rows(reference.sca03_nightly(spark, str(tmp_path))) == [(1, 1.5e9), (4, 50.0), (5, None)]


def test_hc3_and_held_out_band_of_prices(spark, tmp_path):
    from nightledger.plans import reference

    rng = np.random.default_rng(4)
    x = np.column_stack([rng.integers(1, 50, 600), rng.integers(0, 10, 600) / 100, rng.integers(0, 8, 600) / 100]).astype(float)
    order = np.arange(600) // 3
    y = 5 + x @ [0.02, -1.0, 2.0] + rng.normal(size=600) * 0.3
    data = [(int(o), *map(float, a), float(np.exp(b))) for o, a, b in zip(order, x, y)] + [(900, 1.0, 0.0, 0.0, math.nan), (901, 1.0, 0.0, 0.0, -5.0)]
    spark.createDataFrame(data, "l_orderkey long, l_quantity double, l_discount double, l_tax double, l_extendedprice double").write.parquet(str(tmp_path / "lineitem.parquet"))
    z = np.column_stack([np.ones(600), x])

    def fit(rows):
        return np.linalg.lstsq(z[rows], y[rows], rcond=None)[0]

    got = {r["feature"]: (r["coefficient"], r["error"]) for r in reference.ml06_hc3(spark, str(tmp_path)).collect()}
    inv = np.linalg.inv(z.T @ z)
    h = np.einsum("ij,jk,ik->i", z, inv, z)
    meat = z.T @ (z * (((y - z @ fit(slice(None))) / (1 - h)) ** 2)[:, None])
    want = dict(zip(["(constant)", "l_quantity", "l_discount", "l_tax"], zip(fit(slice(None)), np.sqrt(np.diag(inv @ meat @ inv)))))
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k], abs=1e-8) for k in want)
    fold = {r["l_orderkey"]: r["fold"] for r in models.group_folds(spark.createDataFrame([(int(o),) for o in order], "l_orderkey long"), "l_orderkey", 5).collect()}
    folds = np.array([fold[int(o)] for o in order])
    held = np.concatenate([y[folds == k] - z[folds == k] @ fit(folds != k) for k in range(5)])
    band = reference.ml16_conformal_offsets(spark, str(tmp_path)).first()
    assert (band["lower"], band["upper"]) == pytest.approx(tuple(np.quantile(held, [0.1, 0.9])), abs=2e-6)
