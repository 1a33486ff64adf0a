"""Small statistics over distributed rows: folds, least squares, calibrated intervals."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from nightledger.session import store


def _deal(sizes: list[tuple[int, int]], folds: int) -> list[tuple[int, int, int, int]]:
    """(size, first, last, fold) of groups of each size, numbered from 1: each to the fold that is lightest by then.

    ``sizes`` has (size, groups), the greatest size first. Groups of one size are alike, so once the folds differ
    by less than a size each round gives one to every fold, and whole rounds are dealt at once.
    """
    load = [0] * folds
    out = []
    for size, groups in sizes:
        given = [0] * folds
        left = groups
        while left:
            if max(load) - min(load) <= size and left > folds:
                rounds = left // folds
                for f in range(folds):
                    given[f] += rounds
                    load[f] += rounds * size
                left -= rounds * folds
                continue
            f = load.index(min(load))
            given[f] += 1
            load[f] += size
            left -= 1
        first = 1
        for f, n in enumerate(given):
            if n:
                out.append((size, first, first + n - 1, f))
                first += n
    return out


def group_folds(rows: DataFrame, group: str, folds: int) -> DataFrame:
    """(group, fold): no group straddles folds; larger groups go first, each to the fold that is lightest by then.

    The driver sees how many groups each size has: N rows have at most the root of 2 N different sizes. Null is
    a group.
    """
    from nightledger.operators.relational import number_rows

    sizes = rows.groupBy(group).agg(F.count("*").alias("size_"))
    sizes, _ = store(sizes, "group-sizes")
    listed = sorted(((r["size_"], r["groups"]) for r in sizes.groupBy("size_").agg(F.count("*").alias("groups")).collect()), reverse=True)
    if not listed:
        return sizes.select(group, F.lit(0).alias("fold"))
    dealt = rows.sparkSession.createDataFrame(_deal(listed, folds), "s_ long, first_ long, last_ long, fold int")
    # of each size the groups are numbered by name
    numbered = number_rows(sizes, ["size_", group], "i_").alias("n")
    starts = sizes.groupBy("size_").agg(F.count("*").alias("groups_"))
    before = Window.orderBy("size_").rowsBetween(Window.unboundedPreceding, -1)
    starts = starts.select(F.col("size_").alias("s0_"), F.coalesce(F.sum("groups_").over(before), F.lit(0)).alias("before_"))
    d = numbered.join(F.broadcast(starts), F.col("size_") == F.col("s0_")).withColumn("i_", F.col("i_") - F.col("before_"))
    return d.join(F.broadcast(dealt), (F.col("size_") == F.col("s_")) & F.col("i_").between(F.col("first_"), F.col("last_"))).select(group, "fold")


@dataclass(frozen=True)
class LeastSquares:
    names: tuple[str, ...]
    coefficients: tuple[float, ...]
    errors: tuple[float, ...]  # HC3

    def predict(self) -> Column:
        out = F.lit(self.coefficients[0])
        for n, c in zip(self.names[1:], self.coefficients[1:]):
            out = out + F.col(n) * F.lit(c)
        return out


def _sums(rows: DataFrame, terms: list[Column]) -> list[float]:
    got = rows.agg(*[F.coalesce(F.sum(t), F.lit(0.0)).alias(f"s{i}") for i, t in enumerate(terms)]).first()
    return [float(x) for x in got]


def least_squares(rows: DataFrame, features: Sequence[str], target: str) -> LeastSquares:
    """Linear regression with HC3 errors, of few features over any number of rows.

    Two passes of sums: the moments, solved by pseudo-inverse on the driver, then the squared residuals
    over (1 - leverage) squared. Rows with a null or NaN among the columns take no part.
    """
    rows = rows.select(*[F.col(c).cast("double").alias(c) for c in (*features, target)]).dropna()
    x = [F.lit(1.0), *[F.col(c) for c in features]]
    k = len(x)
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    s = _sums(rows, [x[i] * x[j] for i, j in pairs] + [v * F.col(target) for v in x])
    gram = np.zeros((k, k))
    for (i, j), v in zip(pairs, s):
        gram[i, j] = gram[j, i] = v
    inverse = np.linalg.pinv(gram)
    beta = inverse @ np.array(s[len(pairs) :])
    fit = sum((x[i] * F.lit(float(beta[i])) for i in range(1, k)), F.lit(float(beta[0])))
    leverage = sum((x[i] * x[j] * F.lit(float(inverse[i, j]) * (1 if i == j else 2)) for i, j in pairs), F.lit(0.0))
    weight = F.pow((F.col(target) - fit) / F.greatest(1 - leverage, F.lit(1e-12)), 2)
    m = _sums(rows, [x[i] * x[j] * weight for i, j in pairs])
    meat = np.zeros((k, k))
    for (i, j), v in zip(pairs, m):
        meat[i, j] = meat[j, i] = v
    errors = np.sqrt(np.clip(np.diag(inverse @ meat @ inverse), 0, None))
    return LeastSquares(("(constant)", *features), tuple(map(float, beta)), tuple(map(float, errors)))


def conformal_offsets(rows: DataFrame, residual: str, coverage: float) -> DataFrame:
    """One row (lower, upper): the residuals' quantiles on both sides of ``coverage``."""
    from nightledger.operators.quantiles import group_quantiles

    one = rows.select(F.lit(1).alias("g_"), F.col(residual).alias("r_"))
    return group_quantiles(one, ["g_"], F.col("r_"), {"lower": (1 - coverage) / 2, "upper": (1 + coverage) / 2}).select("lower", "upper")


def imputed(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Nulls and NaN of the columns as their median, 0 if there is none, with a 0/1 flag ``<column>_missing``."""
    from nightledger.operators.quantiles import medians

    out = rows
    for c in columns:
        gone = F.col(c).isNull() | F.isnan(c)
        m = medians(rows.select(F.lit(1).alias("g_"), F.col(c)), ["g_"], F.col(c), "m").agg(F.max("m")).scalar()
        out = out.withColumns({f"{c}_missing": gone.cast("int"), c: F.when(gone, F.coalesce(m, F.lit(0.0))).otherwise(F.col(c))})
    return out
