"""Design matrices with a frozen contract, boosted trees, and intervals calibrated on held-out groups."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nightledger.functions.offers import multi_hot
from nightledger.operators.models import conformal_offsets, group_folds
from nightledger.operators.quantiles import medians
from nightledger.session import store


#: Columns of a design matrix that one column of the table may become.
MAX_COLUMNS = 10_000


@dataclass(frozen=True)
class Contract:
    """What a fitted matrix consists of; unseen levels and tokens give zeros, missing numbers their median."""

    numbers: dict[str, float]
    flagged: tuple[str, ...]
    levels: dict[str, tuple[str, ...]]
    vocabulary: tuple[str, ...]
    tokens: str | None
    forbidden: tuple[str, ...] = ()
    names: tuple[str, ...] = field(default=())

    def columns(self) -> dict[str, Column]:
        out: dict[str, Column] = {}
        for c, m in self.numbers.items():
            gone = F.col(c).isNull() | F.isnan(F.col(c).cast("double"))
            out[c] = F.when(gone, m).otherwise(F.col(c).cast("double"))
            if c in self.flagged:
                out[f"{c}_missing"] = gone.cast("double")
        for c, levels in self.levels.items():
            out |= {f"{c}__{v}": (F.coalesce(F.trim(c) == v, F.lit(False))).cast("double") for v in levels}
        if self.tokens:
            out |= {k: v.cast("double") for k, v in multi_hot(F.col(self.tokens), list(self.vocabulary), "token__").items()}
        leaked = set(out) & set(self.forbidden)
        if leaked:
            raise ValueError(f"the target leaks into the matrix: {sorted(leaked)}")
        return out

    def transform(self, rows: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        """The kept columns and ``features``."""
        cols = self.columns()
        flat = rows.select(*keep, *[v.alias(f"x{i}") for i, v in enumerate(cols.values())])
        return VectorAssembler(inputCols=[f"x{i}" for i in range(len(cols))], outputCol="features").transform(flat).select(*keep, "features")


def fit_contract(rows: DataFrame, numbers: Sequence[str], categories: Sequence[str], tokens: str | None, least_records: int, forbidden: Sequence[str] = ()) -> Contract:
    """Medians, flags, levels and vocabulary of the rows. Level and token counts are made before anything is gathered."""
    one = rows.withColumn("g_", F.lit(1))
    numbers_out = {}
    for c in numbers:
        got = medians(one, ["g_"], F.col(c), "m").first()
        numbers_out[c] = float(got["m"]) if got else 0.0
    gaps = rows.agg(*[F.count_if(F.col(c).isNull() | F.isnan(F.col(c).cast("double"))).alias(c) for c in numbers]).first().asDict() if numbers else {}
    levels = {c: _listed(rows.select(F.trim(c)).where(F.trim(c) != "").distinct(), c) for c in categories}
    vocabulary: tuple[str, ...] = ()
    if tokens:
        t = rows.select(F.explode(F.array_distinct(tokens)).alias("t")).groupBy("t").count().where(F.col("count") >= least_records)
        vocabulary = _listed(t.select("t"), tokens)
    return Contract(numbers_out, tuple(c for c in numbers if gaps.get(c)), levels, vocabulary, tokens, tuple(forbidden))


def _listed(values: DataFrame, column: str) -> tuple[str, ...]:
    """The values, which become columns of the matrix: more than it may have are an error."""
    got = values.limit(MAX_COLUMNS + 1).collect()
    if len(got) > MAX_COLUMNS:
        raise ValueError(f"{column} has more than {MAX_COLUMNS} values to make columns of")
    return tuple(sorted(r[0] for r in got))


@dataclass
class Booster:
    contract: Contract
    model: GBTRegressionModel
    lower: float
    upper: float
    scores: dict[str, float]

    def predict(self, rows: DataFrame, keep: Sequence[str]) -> DataFrame:
        """The kept columns, ``predicted`` and its band, on the price's own scale."""
        d = self.model.transform(self.contract.transform(rows, keep))
        p = F.col("prediction")
        return d.select(*keep, F.exp(p).alias("predicted"), F.exp(p + self.lower).alias("low"), F.exp(p + self.upper).alias("high"))


def fit_booster(rows: DataFrame, target: str, group: str, numbers: Sequence[str], categories: Sequence[str], tokens: str | None = None, least_records: int = 25, folds: int = 5, coverage: float = 0.8, seed: int = 10001, **settings) -> Booster:
    """Boosted trees on the log of a positive target, scored and calibrated on folds that keep groups whole."""
    rows = rows.where(F.col(target) > 0).where(~F.isnan(target))
    contract = fit_contract(rows, numbers, categories, tokens, least_records, [target])
    d = contract.transform(rows.withColumn("y_", F.log(target)), [group, "y_"]).join(group_folds(rows, group, folds), group)
    d, _ = store(d, "design")
    make = lambda: GBTRegressor(labelCol="y_", seed=seed, **{"maxIter": 20, "maxDepth": 4, **settings})
    held = None
    for k in range(folds):
        test = d.where(F.col("fold") == k)
        if test.isEmpty():
            continue
        part = make().fit(d.where(F.col("fold") != k)).transform(test).select("fold", "y_", "prediction")
        held = part if held is None else held.unionByName(part)
    if held is None:
        raise ValueError("no rows to fit")
    held, _ = store(held, "held-out")
    band = conformal_offsets(held.withColumn("r", F.col("y_") - F.col("prediction")), "r", coverage).first()
    stats = held.agg(F.avg(F.abs(F.col("y_") - F.col("prediction"))).alias("mae_log"), F.avg(F.abs(F.exp("y_") - F.exp("prediction"))).alias("mae"), (1 - F.avg(F.pow(F.col("y_") - F.col("prediction"), 2)) / F.var_pop("y_")).alias("r2_log")).first()
    return Booster(contract, make().fit(d), float(band["lower"]), float(band["upper"]), stats.asDict())
