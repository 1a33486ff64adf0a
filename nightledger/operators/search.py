"""Choice of models by grouped cross-validation, bands from quantile trees, and what features make of a price gap."""

from __future__ import annotations

import math
import random
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from typing import Any

from pyspark.ml.regression import DecisionTreeRegressionModel, DecisionTreeRegressor, GBTRegressor, RandomForestRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nightledger.operators.design import Booster, Contract, fit_contract
from nightledger.operators.models import group_folds
from nightledger.operators.quantiles import group_quantiles
from nightledger.session import remove_path, store

FAMILIES = {"boosted": GBTRegressor, "forest": RandomForestRegressor}
# How far features may move a price.
FACTOR_BOUNDS = (0.5, 2.0)


def sample_configs(space: Mapping[str, Sequence[Any]], n: int, seed: int) -> list[dict[str, Any]]:
    """At most n different settings, one value of each name; the same for the same seed."""
    names = sorted(space)
    total = math.prod(len(space[k]) for k in names)
    out = []
    for number in random.Random(seed).sample(range(total), min(n, total)):
        config = {}
        for k in names:
            number, at = divmod(number, len(space[k]))
            config[k] = space[k][at]
        out.append(config)
    return out


def better(a: Mapping[str, float], b: Mapping[str, float]) -> bool:
    """Whether a wins: by the lower mean error in prices, of equal ones by the higher fit."""
    if math.isclose(a["mae"], b["mae"], rel_tol=1e-9, abs_tol=1e-9):
        return a["r2_log"] > b["r2_log"]
    return a["mae"] < b["mae"]


def cross_validate(design: DataFrame, folds: int, family: str, params: Mapping[str, Any], seed: int) -> dict[str, float] | None:
    """Means over the folds of a table with ``features``, ``y_`` (log price) and ``fold``; None with under two folds."""
    scores = []
    for k in range(folds):
        test, train = design.where(F.col("fold") == k), design.where(F.col("fold") != k)
        if test.isEmpty() or train.isEmpty():
            continue
        d = FAMILIES[family](labelCol="y_", seed=seed, **params).fit(train).transform(test)
        gap = F.col("y_") - F.col("prediction")
        scores.append(d.agg(F.avg(F.abs(gap)).alias("mae_log"), F.avg(F.abs(F.exp("y_") - F.exp("prediction"))).alias("mae"), (1 - F.avg(gap * gap) / F.var_pop("y_")).alias("r2_log")).first().asDict())
    return {k: sum(s[k] or 0.0 for s in scores) / len(scores) for k in scores[0]} | {"folds": len(scores)} if len(scores) > 1 else None


def random_search(design: DataFrame, folds: int, family: str, space: Mapping[str, Sequence[Any]], n: int, seed: int = 10001, at_once: int = 2) -> dict[str, Any] | None:
    """The best of n sampled settings of a family: its ``params`` and ``metrics``. Winners don't depend on the order of fits."""
    configs = sample_configs(space, n, seed)
    with ThreadPoolExecutor(at_once) as pool:
        scored = list(pool.map(lambda p: cross_validate(design, folds, family, p, seed), configs))
    best = None
    for params, metrics in zip(configs, scored):
        if metrics is not None and (best is None or better(metrics, best["metrics"])):
            best = {"family": family, "params": params, "metrics": metrics}
    return best


def bake_off(
    rows: DataFrame, target: str, group: str, numbers: Sequence[str], categories: Sequence[str], tokens: str | None, floors: Sequence[int],
    spaces: Mapping[str, Mapping[str, Sequence[Any]]], n: int, folds: int = 5, seed: int = 10001,
) -> tuple[dict[str, Any] | None, list[dict[str, Any]]]:
    """(winner, leaderboard): the best setting of each family for each floor of token counts, all on the same folds."""
    rows = rows.where(F.col(target) > 0).where(~F.isnan(target))
    held = group_folds(rows, group, folds)
    board = []
    for floor in floors:
        contract = fit_contract(rows, numbers, categories, tokens, floor, [target])
        d = contract.transform(rows.withColumn("y_", F.log(target)), [group, "y_"]).join(held, group)
        d, path = store(d, "bake-off")
        for family, space in spaces.items():
            best = random_search(d, folds, family, space, n, seed)
            if best is not None:
                board.append({"floor": floor, **best})
        remove_path(rows.sparkSession, path)
    winner = None
    for entry in board:
        if winner is None or better(entry["metrics"], winner["metrics"]):
            winner = entry
    return winner, sorted(board, key=lambda e: e["metrics"]["mae"])


@dataclass
class QuantileTree:
    """A regression tree whose leaves give quantiles of the rows in them rather than their mean."""

    contract: Contract
    model: DecisionTreeRegressionModel
    leaves: DataFrame  # leaf_, lower, upper: a row for each leaf

    def predict(self, rows: DataFrame, keep: Sequence[str]) -> DataFrame:
        """The kept columns with ``low`` and ``high``, in order, on the target's own scale."""
        d = self.model.transform(self.contract.transform(rows, keep)).join(F.broadcast(self.leaves), "leaf_", "left")
        low, high = F.exp(F.least("lower", "upper")), F.exp(F.greatest("lower", "upper"))
        return d.select(*keep, low.alias("low"), high.alias("high"))


def fit_quantile_tree(rows: DataFrame, target: str, numbers: Sequence[str], categories: Sequence[str], tokens: str | None = None, least_records: int = 25, coverage: float = 0.8, depth: int = 5, least_rows: int = 20, seed: int = 10001) -> QuantileTree:
    """Bands of the log of a positive target: a tree is grown on it, and each leaf keeps its rows' tail quantiles."""
    rows = rows.where(F.col(target) > 0).where(~F.isnan(target))
    contract = fit_contract(rows, numbers, categories, tokens, least_records, [target])
    d = contract.transform(rows.withColumn("y_", F.log(target)), ["y_"])
    model = DecisionTreeRegressor(labelCol="y_", leafCol="leaf_", maxDepth=depth, minInstancesPerNode=least_rows, seed=seed).fit(d)
    tails = {"lower": (1 - coverage) / 2, "upper": (1 + coverage) / 2}
    leaves, _ = store(group_quantiles(model.transform(d), ["leaf_"], F.col("y_"), tails).drop("n"), "leaves")
    return QuantileTree(contract, model, leaves)


def _like(contract: Contract, client: Mapping[str, Any], only: Sequence[str] | None = None) -> dict[str, Column]:
    """Columns of rows as if they had the client's numbers and categories; tokens stay their own."""
    names = [c for c in (*contract.numbers, *contract.levels) if c in client and (only is None or c in only)]
    return {c: F.lit(client[c]) for c in names}


def adjusted_prices(booster: Booster, rows: DataFrame, client: Mapping[str, Any], price: str, keep: Sequence[str], bounds: tuple[float, float] | None = FACTOR_BOUNDS) -> DataFrame:
    """Each row's price as if it had the client's features: the kept columns, ``predicted``, ``predicted_like``, ``factor``, ``adjusted``.

    The factor is what the model makes of the row with the client's features over what it makes of the row as it
    is, kept within the bounds. Rows of any number go through the model twice in one pass.
    """
    from pyspark.ml.feature import VectorAssembler

    own, like = booster.contract.columns(), None
    d = rows.select("*", *[v.alias(f"own_{i}") for i, v in enumerate(own.values())])
    like = booster.contract.columns()
    d = d.withColumns(_like(booster.contract, client)).select("*", *[v.alias(f"like_{i}") for i, v in enumerate(like.values())])
    for side in ("own", "like"):
        d = VectorAssembler(inputCols=[f"{side}_{i}" for i in range(len(own))], outputCol=f"{side}_features").transform(d)
        d = booster.model.copy({booster.model.featuresCol: f"{side}_features", booster.model.predictionCol: f"{side}_y"}).transform(d)
    factor = F.exp(F.col("like_y") - F.col("own_y"))
    if bounds is not None:
        factor = F.greatest(F.lit(bounds[0]), F.least(F.lit(bounds[1]), factor))
    return d.select(*keep, F.exp("own_y").alias("predicted"), F.exp("like_y").alias("predicted_like"), factor.alias("factor"), (F.col(price) * factor).alias("adjusted"))


def price_gaps(booster: Booster, rows: DataFrame, client: Mapping[str, Any], client_price: float, price: str, keep: Sequence[str]) -> DataFrame:
    """The client's price less each row's, split into what features explain and the rest; the parts sum up."""
    d = adjusted_prices(booster, rows, client, price, [*keep, price] if price not in keep else keep)
    gap = F.lit(float(client_price)) - F.col(price)
    explained = F.col(price) * (F.col("factor") - 1)
    return d.select(*keep, gap.alias("gap"), explained.alias("explained"), (gap - explained).alias("residual"), "factor")


def gap_drivers(booster: Booster, row: DataFrame, client: Mapping[str, Any], n: int = 10) -> DataFrame:
    """(feature, contribution) in log points of one row, the n largest: features go over to the client's one by one.

    Each contributes what its own step moves the prediction; the contributions of all sum up to the whole move.
    """
    names = list(_like(booster.contract, client))
    if not names:
        return row.sparkSession.createDataFrame([], "feature string, contribution double")
    steps = None
    one = row.limit(1)
    for k in range(len(names) + 1):
        part = one.withColumns(_like(booster.contract, client, names[:k])).withColumn("step_", F.lit(k)) if k else one.withColumn("step_", F.lit(0))
        steps = part if steps is None else steps.unionByName(part)
    got = {r["step_"]: r["prediction"] for r in booster.model.transform(booster.contract.transform(steps, ["step_"])).select("step_", "prediction").collect()}
    moves = sorted(((c, float(got[k + 1] - got[k])) for k, c in enumerate(names)), key=lambda x: (-abs(x[1]), x[0])) if got else []
    return row.sparkSession.createDataFrame(moves[:n], "feature string, contribution double")
