"""Student training on the mixed distillation loss (M11, M12, A21): boosting on its own gradients.

The loss is ``evaluation.kd_loss``: alpha times the mean absolute error against
the labels plus (1 - alpha) times the mean squared error against the teacher,
each over the rows that have the value; with one of the two that one alone.
A blended label can't express it: the absolute error of a blend is not the
blend of an absolute and a squared error.

Each round fits a Spark ML regression tree to the negative gradient of the
loss at the current scores and adds the multiple of it, out of ``STEPS``, that
makes the loss smallest; one aggregate scores all multiples. A round that can't
lower the training loss ends the fit. So the loss falls every round.

Scale: a score depends on the bins of the features alone, so the rows of one
cell (equal bins) share it. Rows are gathered once into pieces of a cell, each
with its labels as an array of at most about ``PIECE`` and its teacher values as
count, mean and squared deviation. A round fits a tree to the pieces (their mean
gradient, weighted by their rows) and reads the labels once for the losses; only
losses and trees reach the driver. The scores are written every ``CUT`` rounds,
so the plan stays short and a lost executor costs no more than these rounds.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressionModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.scalars import finite_or_null
from ledgerline.operators.evaluation import KD_ALPHA
from ledgerline.operators.models import fit_bins, without_bins
from ledgerline.session import cut_lineage

#: Multiples of a tree that a round may add.
STEPS = tuple(2.0 ** -k for k in range(-2, 11))
#: Rounds between two written score tables.
CUT = 8
ROUNDS, MAX_DEPTH, PATIENCE = 100, 3, 10
#: Labels of a piece of a cell.
PIECE = 4096


@dataclass
class Student:
    """``start`` plus the weighted trees of ``model`` over the vector that ``bins`` makes of the features; ``losses`` after 0, 1, .. rounds on the training and the validation rows."""

    model: GBTRegressionModel | None
    start: float
    features: list[str]
    bins: PipelineModel
    losses: list[tuple[float, float | None]]


def _weights(alpha: float, has_y: bool, has_t: bool) -> tuple[float, float]:
    return (alpha, 1.0 - alpha) if has_y and has_t else (1.0 * has_y, 1.0 * has_t)


def _pieces(d: DataFrame, bins: PipelineModel) -> DataFrame:
    """The rows (``__y``, ``__t``, ``__v``) as pieces of cells: ``__n`` rows, labels ``__ys``, teacher values as ``__nt``, ``__mt``, ``__dt``."""
    cell = [*bins.stages[-1].getInputCols(), "__v"]
    # ids are dealt in turn, so that a cell's rows go evenly to its pieces, equal ones too
    rows = bins.transform(d).select(*cell, "__y", "__t", F.monotonically_increasing_id().alias("__id"))
    large = rows.groupBy(*cell).agg(F.ceil(F.count(F.lit(1)) / F.lit(PIECE)).alias("__k")).where("__k > 1")
    rows = rows.join(large, cell, "left").withColumn("__piece", F.pmod("__id", F.coalesce("__k", F.lit(1).cast("bigint"))))
    pieces = rows.groupBy(*cell, "__piece").agg(
        F.count(F.lit(1)).cast("double").alias("__n"), F.collect_list("__y").alias("__ys"), F.count("__t").alias("__nt"),
        F.coalesce(F.avg("__t"), F.lit(0.0)).alias("__mt"), (F.coalesce(F.var_pop("__t"), F.lit(0.0)) * F.count("__t")).alias("__dt"))
    return cut_lineage(bins.stages[-1].transform(pieces).select("__features", "__v", "__n", "__ys", "__nt", "__mt", "__dt"), "student")


def fit_student(df: DataFrame, features: list[str], y: str | None, teacher: str | None, indicator: str | None = None,
                alpha: float = KD_ALPHA, rounds: int = ROUNDS, max_depth: int = MAX_DEPTH, patience: int = PATIENCE,
                max_bins: int = 32, seed: int = 42) -> Student:
    """Fit on the rows without ``indicator``. With one, the rows that have it set are scored each round, the fit ends
    ``patience`` rounds after their least loss, and the trees up to it are kept.

    Rows with neither a label nor a teacher value are left out; with none left, an error."""
    num = lambda c: finite_or_null(F.col(c)) if c else F.lit(None).cast("double")
    names = ["__y", "__t", "__v"]
    d = df.withColumns({"__y": num(y), "__t": num(teacher), "__v": F.col(indicator) if indicator else F.lit(False)})
    d = d.where(F.col("__y").isNotNull() | F.col("__t").isNotNull())
    d = cut_lineage(d.select(*[F.col(f"`{c}`") for c in features], *names), "student-rows")
    train = ~F.col("__v")
    seen = {r["__v"]: r for r in d.groupBy("__v").agg(
        F.count(F.lit(1)).alias("n"), F.count("__y").alias("y"), F.count("__t").alias("t"),
        F.avg("__y").alias("mean_y"), F.avg("__t").alias("mean_t")).collect()}
    if False not in seen:
        raise ValueError("no training row has a label or a teacher value")
    n, n_y, n_t, mean_y, mean_t = (seen[False][c] for c in ("n", "y", "t", "mean_y", "mean_t"))
    a, b = _weights(alpha, n_y > 0, n_t > 0)
    start = a * (mean_y or 0.0) + b * (mean_t or 0.0)
    bins = fit_bins(d.where(train), features, max_bins, "__features")
    d = _pieces(d, bins).withColumn("__s", F.lit(start))
    # minus the gradient by the score, times the rows, so that its size does not depend on the table's; the mean of a piece
    pull = F.lit(0.0)
    if n_y:
        signs = F.aggregate("__ys", F.lit(0.0), lambda acc, x: acc + F.signum(x - F.col("__s")))
        pull += signs * F.lit(a * n / n_y)
    if n_t:
        pull += (F.col("__mt") - F.col("__s")) * F.col("__nt") * F.lit(2 * b * n / n_t)
    pull /= F.col("__n")
    tree = DecisionTreeRegressor(featuresCol="__features", labelCol="__g", predictionCol="__p", weightCol="__n", maxDepth=max_depth,
                                 maxBins=max_bins + 1, seed=seed)

    def scored(d: DataFrame, steps: tuple[float, ...]) -> list[tuple[float, float | None]]:
        p = F.col("__p") if "__p" in d.columns else F.lit(0.0)
        at = [(F.col("__s") + F.lit(s) * p).alias(f"s{k}") for k, s in enumerate(steps)]
        y = d.select("__v", "__s", p.alias("__p"), F.explode("__ys").alias("y"))
        y = y.groupBy("__v").agg(*[F.sum(F.abs(F.col("__s") + F.lit(s) * F.col("__p") - F.col("y"))).alias(f"s{k}") for k, s in enumerate(steps)])
        t = d.select("__v", "__nt", "__mt", "__dt", *at)
        t = t.groupBy("__v").agg(*[F.sum(F.col("__dt") + F.col("__nt") * (F.col("__mt") - F.col(f"s{k}")) * (F.col("__mt") - F.col(f"s{k}"))).alias(f"s{k}")
                                   for k in range(len(steps))])
        sums = {(r["of"], r["__v"]): r for r in y.withColumn("of", F.lit("y")).unionByName(t.withColumn("of", F.lit("t"))).collect()}

        def loss(v: bool, k: int) -> float | None:
            if v not in seen:
                return None
            return sum(w * sums[of, v][f"s{k}"] / seen[v][of] for of, w in (("y", a), ("t", b)) if seen[v][of])

        return [(loss(False, k), loss(True, k)) for k in range(len(steps))]

    losses, trees, weights = scored(d, (0.0,)), [], []
    while len(trees) < rounds:
        fitted = tree.fit(d.where(train).withColumn("__g", pull).select("__features", "__g", "__n"))
        d2 = fitted.transform(d)
        after = scored(d2, STEPS)
        k = min(range(len(STEPS)), key=lambda i: after[i][0])
        if not after[k][0] < losses[-1][0]:
            break
        losses.append(after[k])
        trees.append(fitted)
        weights.append(STEPS[k])
        d = d2.withColumn("__s", F.col("__s") + F.lit(STEPS[k]) * F.col("__p")).drop("__p")
        if len(trees) % CUT == 0:
            d = cut_lineage(d, "student")
        if losses[0][1] is not None and len(trees) - min(range(len(losses)), key=lambda i: losses[i][1]) >= patience:
            break
    kept = len(trees) if losses[0][1] is None else min(range(len(losses)), key=lambda i: losses[i][1])
    return Student(_ensemble(df, trees[:kept], weights[:kept]), start, features, bins, losses)


def _ensemble(df: DataFrame, trees: list, weights: list[float]) -> GBTRegressionModel | None:
    """The weighted trees as one Spark ML model, which can be saved, explained and applied in one pass."""
    if not trees:
        return None
    sc = df.sparkSession.sparkContext
    kind = sc._jvm.org.apache.spark.ml.regression
    some = sc._gateway.new_array(kind.DecisionTreeRegressionModel, len(trees))
    weight = sc._gateway.new_array(sc._jvm.double, len(trees))
    for i, (t, w) in enumerate(zip(trees, weights)):
        some[i], weight[i] = t._java_obj, w
    return GBTRegressionModel(kind.GBTRegressionModel("student_" + trees[0].uid, some, weight))


def predict_student(fit: Student, df: DataFrame, name: str = "prediction") -> DataFrame:
    """``df`` with the student's prediction."""
    if fit.model is None:
        return df.withColumn(name, F.lit(fit.start))
    model = fit.model.setFeaturesCol("__features").setPredictionCol(name)
    scored = model.transform(fit.bins.transform(df)).withColumn(name, F.col(name) + F.lit(fit.start))
    return without_bins(scored.drop("__features"), fit.features)
