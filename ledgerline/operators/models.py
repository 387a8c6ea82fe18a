"""Boosted-tree regression with Spark ML.

Training is distributed by Spark ML; nothing is collected except the
small fitted models. Randomness is keyed: folds and bootstrap weights come
from a hash of the row key and a seed, so results do not depend on how
rows are partitioned.

Scale: trees see a feature by its bins alone, and squared error sees the rows
of one cell (equal bins of all features) by their weight and mean label alone.
So a fit without row sampling groups the rows by cell once, and every boosting
round reads the cells: the rounds cost no more with more rows, once the cells
are filled. Rows whose cells are all different are fitted as they are.
"""

from __future__ import annotations

import math
import random
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import Bucketizer, SQLTransformer, VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.operators.evaluation import KD_ALPHA
from ledgerline.session import cut_lineage

# Settings without any parameters (the boosting library's own), what given parameters are filled
# up with, and the tuning space.
UNTUNED = {"n_estimators": 100, "learning_rate": 0.3, "max_depth": 6, "subsample": 1.0}
DEFAULTS = {"n_estimators": 200, "learning_rate": 0.05, "max_depth": 3, "subsample": 1.0}
SPACE = {"n_estimators": (200, 2000, 100), "learning_rate": (0.01, 0.3), "max_depth": (2, 6),
         "subsample": (0.6, 1.0)}
#: Bins of a feature (the trees' own default). The edges of a feature with more values are quantiles over the rows of
#: about so many different feature vectors (Spark's trees take them from 10,000 rows); all rows are binned and fitted.
BINS, EDGE_VECTORS = 32, 50_000


@dataclass
class FitResult:
    model: PipelineModel
    features: list[str]


def gbt(params: dict | None = None, seed: int = 42, label: str = "label", weight: str | None = None,
        ) -> GBTRegressor:
    p = dict(DEFAULTS, **params) if params else UNTUNED
    g = GBTRegressor(featuresCol="features", labelCol=label, predictionCol="prediction",
                     maxIter=int(p["n_estimators"]), stepSize=float(p["learning_rate"]),
                     maxDepth=int(p["max_depth"]), subsamplingRate=float(p["subsample"]), seed=seed)
    if weight:
        g.setWeightCol(weight)
    return g


def _step_names(step: str, features: list[str]) -> list[str]:
    return [f"__{step}{i}" for i in range(len(features))]


def _bin_names(features: list[str]) -> list[str]:
    return _step_names("bin", features)


def fit_bins(df: DataFrame, features: list[str], bins: int = BINS, output: str = "features") -> PipelineModel:
    """Stages from the features to the vector ``output`` of their bin numbers; NULL and NaN share the bin after the last.

    A feature of at most ``bins`` values has an edge midway between any two neighbours, one of more values has quantiles."""
    x = {c: F.col(f"`{c}`").cast("double") for c in features}
    x = {c: F.when(~F.isnan(v), v) for c, v in x.items()}
    vector = F.xxhash64(*x.values())
    seen = df.agg(F.approx_count_distinct(vector), *[F.approx_count_distinct(v) for v in x.values()]).first()
    few = [n <= 2 * bins for n in seen[1:]]
    taken = F.pmod(vector, F.lit(max(1, seen[0] // EDGE_VECTORS))) == 0
    at = [k / bins for k in range(1, bins)]
    row = df.agg(*[F.array_sort(F.collect_set(v)) if f else F.lit(None) for f, v in zip(few, x.values())],
                 *[F.percentile(v if f else F.when(taken, v), at) for f, v in zip(few, x.values())]).first()
    splits = []
    for values, quantiles in zip(row[:len(features)], row[len(features):]):
        if values is not None and len(values) <= bins:
            edges = [(lo + hi) / 2 for lo, hi in zip(values, values[1:])]
        else:
            edges = quantiles or []
        edges = sorted({e for e in edges if math.isfinite(e)}) or [0.0]
        splits.append([-math.inf, *edges, math.inf])
    names, nums, raw = _bin_names(features), _step_names("num", features), _step_names("raw", features)
    quoted = ["`" + c.replace("`", "``") + "`" for c in features]
    filled = ", ".join(f"coalesce(CAST({c} AS DOUBLE), double('NaN')) AS {n}" for c, n in zip(quoted, nums))
    # Bucketizer marks its numbers as categories; a sum has no such mark, so that trees split them in order
    ordered = ", ".join(f"{r} + 0.0D AS {n}" for r, n in zip(raw, names))
    return PipelineModel(stages=[
        SQLTransformer(statement=f"SELECT *, {filled} FROM __THIS__"),
        Bucketizer(splitsArray=splits, inputCols=nums, outputCols=raw, handleInvalid="keep"),
        SQLTransformer(statement=f"SELECT *, {ordered} FROM __THIS__"),
        VectorAssembler(inputCols=names, outputCol=output)])


def without_bins(df: DataFrame, features: list[str]) -> DataFrame:
    return df.drop(*_bin_names(features), *_step_names("num", features), *_step_names("raw", features))


def _cells(df: DataFrame, bins: PipelineModel, features: list[str], label: str, weights: list) -> DataFrame:
    """One row a cell: its bins, and for each weight the sum over its rows and the weighted mean label."""
    y = F.coalesce(F.col(f"`{label}`").cast("double"), F.lit(math.nan))  # a row without a label is an error of the fit
    names = _bin_names(features)
    sums = bins.transform(df).groupBy(*names).agg(*[
        c for i, w in enumerate(weights) for c in (F.sum(w).alias(f"__w{i}"), F.sum(w * y).alias(f"__s{i}"))])
    return cut_lineage(sums.sortWithinPartitions(*names), "cells")


def _fit_cells(cells: DataFrame, bins: PipelineModel, features: list[str], i: int, params: dict | None, seed: int) -> FitResult:
    d = cells.where(F.col(f"__w{i}") > 0).withColumn("__label", F.col(f"__s{i}") / F.col(f"__w{i}"))
    g = gbt(params, seed, "__label", f"__w{i}").setMaxBins(BINS + 1)
    return FitResult(PipelineModel(stages=[*bins.stages, g.fit(bins.stages[-1].transform(d))]), features)


def _samples_rows(params: dict | None) -> bool:
    return gbt(params).getSubsamplingRate() < 1.0


def train_model(df: DataFrame, features: list[str], label: str = "label", params: dict | None = None,
                seed: int = 42, weight: str | None = None) -> FitResult:
    """M4: one boosted-tree regressor, fitted on the cells of the features' bins, or on rows where rounds sample rows."""
    if not _samples_rows(params):
        bins = fit_bins(df, features)
        cells = _cells(df, bins, features, label, [F.col(f"`{weight}`") if weight else F.lit(1.0)])
        return _fit_cells(cells, bins, features, 0, params, seed)
    asm = VectorAssembler(inputCols=features, outputCol="features", handleInvalid="keep")
    model = Pipeline(stages=[asm, gbt(params, seed, label, weight)]).fit(df)
    return FitResult(model, features)


def predict(fit: FitResult, df: DataFrame) -> DataFrame:
    return without_bins(fit.model.transform(df).drop("features"), fit.features)


def fold_column(df: DataFrame, keys: list[str], k: int, seed: int) -> DataFrame:
    return df.withColumn("fold", F.pmod(F.xxhash64(*[F.col(c) for c in keys], F.lit(seed)), F.lit(k)).cast("int"))


def sample_space(trials: int, seed: int = 42, space: dict | None = None) -> list[dict]:
    """A seeded random sample of the tuning space (the reference uses a TPE sampler)."""
    space = SPACE if space is None else dict(SPACE, **space)
    rnd = random.Random(seed)
    lo_n, hi_n, step = space["n_estimators"]
    out = []
    for _ in range(trials):
        lr_lo, lr_hi = space["learning_rate"]
        out.append({
            "n_estimators": rnd.randrange(lo_n, hi_n + 1, step),
            "learning_rate": math.exp(rnd.uniform(math.log(lr_lo), math.log(lr_hi))),
            "max_depth": rnd.randint(*space["max_depth"]),
            "subsample": rnd.uniform(*space["subsample"]),
        })
    return out


def poisson_weight(keys: list[str], seed: int) -> F.Column:
    """Bootstrap multiplicity ~ Poisson(1) from a key hash (stable under repartition).

    Inverse-CDF on a uniform in [0, 1) derived from ``xxhash64``.
    """
    u = F.pmod(F.xxhash64(*[F.col(c) for c in keys], F.lit(seed)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    e1 = math.exp(-1.0)
    cdf, p = e1, e1
    expr = F.when(u < F.lit(cdf), F.lit(0.0))
    for k in range(1, 12):
        p = p / k
        cdf += p
        expr = expr.when(u < F.lit(cdf), F.lit(float(k)))
    return expr.otherwise(F.lit(12.0))


def train_ensemble(df: DataFrame, features: list[str], keys: list[str], label: str = "label",
                   params: dict | None = None, members: int = 5, seed: int = 42,
                   bootstrap: bool = True, parallelism: int | None = None) -> list[FitResult]:
    """M6: bagging; member i uses seed + i and its own Poisson(1) row weights.

    Features and weights are written once, and so are the cells with every
    member's weights; the members are fitted at the same
    time (``parallelism`` of them, all by default), so the short jobs of one
    fill the cores that the others leave idle."""
    weights = {f"__w{i}": poisson_weight(keys, seed + i) for i in range(members)} if bootstrap else {}
    d = cut_lineage(df.select(*[F.col(f"`{c}`") for c in dict.fromkeys([*features, label])],
                              *[w.alias(c) for c, w in weights.items()]), "ensemble")

    cells = None
    if not _samples_rows(params):
        bins = fit_bins(d, features)
        cells = _cells(d, bins, features, label, [F.col(c) for c in weights] or [F.lit(1.0)] * members)

    def fit(i: int) -> FitResult:
        if cells is not None:
            return _fit_cells(cells, bins, features, i, params, seed + i)
        return train_model(d, features, label, params, seed + i, f"__w{i}" if bootstrap else None)

    with ThreadPool(parallelism or members) as pool:
        return pool.map(inheritable_thread_target(df.sparkSession)(fit), range(members))


def predict_ensemble(fits: list[FitResult], df: DataFrame) -> DataFrame:
    """Member predictions side by side, then mean and population std."""
    from ledgerline.operators.evaluation import ensemble_stats
    cur = df
    names = []
    for i, f in enumerate(fits):
        cur = without_bins(f.model.transform(cur).withColumnRenamed("prediction", f"pred_{i}").drop("features"), f.features)
        names.append(f"pred_{i}")
    return ensemble_stats(cur, names)


def feature_importance(spark: SparkSession, fits: list[FitResult], k: int = 20) -> DataFrame:
    """Element-wise mean importance over members, top ``k``."""
    rows = []
    for m, f in enumerate(fits):
        imp = f.model.stages[-1].featureImportances.toArray()
        rows.extend((m, name, float(v)) for name, v in zip(f.features, imp))
    df = spark.createDataFrame(rows, "member int, feature string, importance double")
    return (df.groupBy("feature").agg(F.avg("importance").alias("importance"))
            .orderBy(F.col("importance").desc(), "feature").limit(k))


def distillation_target(df: DataFrame, y: str, teacher: str, alpha: float = KD_ALPHA) -> DataFrame:
    """Blended label α·y + (1−α)·teacher where both exist, else whichever exists."""
    yv, tv = F.col(y).cast("double"), F.col(teacher).cast("double")
    lab = (F.when(yv.isNotNull() & tv.isNotNull(), F.lit(alpha) * yv + F.lit(1 - alpha) * tv)
           .otherwise(F.coalesce(yv, tv)))
    return df.withColumn("kd_label", lab).where(F.col("kd_label").isNotNull())


def validation_curve(df: DataFrame, features: list[str], label: str, indicator: str,
                     params: dict | None = None, seed: int = 42) -> tuple[FitResult, list[float]]:
    """Fit every iteration on the rows without the indicator, score each by the mean absolute
    error on the rows with it, and keep the model up to the best iteration; returns it and the whole curve.

    Boosting adds trees one after another from a fixed seed, so a fit of the best length has the same trees."""
    train, val = df.where(~F.col(indicator)), df.where(F.col(indicator))
    asm = VectorAssembler(inputCols=features, outputCol="features", handleInvalid="keep")
    model = Pipeline(stages=[asm, gbt(params, seed, label)]).fit(train)
    losses = list(model.stages[-1].evaluateEachIteration(asm.transform(val), "absolute"))
    best = min(range(len(losses)), key=lambda i: losses[i]) + 1
    if best < len(losses):
        full = dict(DEFAULTS, **params) if params else UNTUNED
        model = Pipeline(stages=[asm, gbt(dict(full, n_estimators=best), seed, label)]).fit(train)
    return FitResult(model, features), losses
