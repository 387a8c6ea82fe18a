"""Hyper-parameter search for boosted trees (M5, A22): successive halving over fitted prefixes.

A boosted model of n trees is the first n trees of a longer one, so one fit
per (rate, depth, subsample) scores every tree count up to its length. The
search fits all candidates to the smallest count of the space, keeps the
better third by their best fold mean, fits those three times as long, and so on
up to the largest count: the whole space is open, and few candidates pay for long fits.

Each (candidate, fold) is one Spark task over a bounded sample of the rows
(``SAMPLE_ROWS``, drawn by a key hash; all rows of smaller tables), binned to
``BINS`` steps a feature and broadcast: rows × features bytes, whatever the
table holds. The model itself is trained on all rows (``models.train_model``).
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.operators.models import SPACE, fold_column, sample_space
from ledgerline.session import cut_lineage

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need no copy of this package

#: Rows that the search is run on, at most about (a hash of the key draws them).
SAMPLE_ROWS = 200_000
#: Steps of a feature; a missing value is a step of its own.
BINS = 64
#: One of so many candidates goes on to the next, about as many times longer, fits.
KEEP = 3
ERRORS = "trial int, fold int, n_estimators int, mae double, n_rows long"


def binned(values: np.ndarray) -> np.ndarray:
    """Steps (0 to ``BINS`` - 1) of one feature: quantile steps, or one a value where there are few; 0 is missing."""
    known = np.unique(values[~np.isnan(values)])
    if len(known) > BINS - 1:
        known = np.unique(np.quantile(values[~np.isnan(values)], np.linspace(0, 1, BINS - 1), method="lower"))
    return np.where(np.isnan(values), 0, np.searchsorted(known, values, side="right").clip(1)).astype(np.uint8)


def grow(x: np.ndarray, target: np.ndarray, rows: np.ndarray | None, depth: int) -> np.ndarray:
    """What a least-squares regression tree, grown on ``rows`` (None: all), predicts for every row. ``x`` is features × rows."""
    own, t = (x, target) if rows is None else (x[:, rows], target[rows])
    node, every = np.zeros(x.shape[1], np.int64), np.arange(x.shape[1])
    for level in range(depth):
        nodes = 1 << level
        best, feature, cut = np.full(nodes, 1e-12), np.zeros(nodes, np.int64), np.full(nodes, BINS)
        base = (node if rows is None else node[rows]) * BINS
        for f, column in enumerate(own):
            key = base + column
            s, n = (np.bincount(key, w, nodes * BINS).reshape(nodes, BINS).cumsum(axis=1) for w in (t, None))
            all_s, all_n = s[:, -1:], n[:, -1:]
            gain = s * s / np.maximum(n, 1) + (all_s - s) ** 2 / np.maximum(all_n - n, 1) - all_s ** 2 / np.maximum(all_n, 1)
            gain[(n == 0) | (n == all_n)] = 0
            at = gain.argmax(axis=1)
            top = gain[np.arange(nodes), at]
            better = top > best
            best[better], feature[better], cut[better] = top[better], f, at[better]
        node = 2 * node + (x[feature[node], every] > cut[node])
    last = node if rows is None else node[rows]
    s, n = np.bincount(last, t, 1 << depth), np.bincount(last, minlength=1 << depth)
    return (s / np.maximum(n, 1))[node]


def prefix_errors(x: np.ndarray, y: np.ndarray, held_out: np.ndarray, counts: list[int], rate: float, depth: int,
                  subsample: float, seed: list[int]) -> list[float]:
    """Mean absolute error on the ``held_out`` rows of the first n trees, for every n of ``counts`` (ascending)."""
    rng, train = np.random.default_rng(seed), np.flatnonzero(~held_out)
    order = np.concatenate((train, np.flatnonzero(held_out)))
    x, y, n = np.ascontiguousarray(x[:, order]), y[order], len(train)
    guess = np.full(len(y), y[:n].mean())
    out, wanted = [], set(counts)
    for k in range(1, max(counts) + 1):
        rows = np.flatnonzero(rng.random(n) < subsample) if subsample < 1 else np.arange(n)
        guess += rate * grow(x, y - guess, rows, depth)
        if k in wanted:
            out.append(float(np.abs(y - guess)[n:].mean()))
    return out


def rungs(space: dict = SPACE) -> list[int]:
    """Tree counts to which the survivors are fitted: from the smallest of the space to the largest, about three times as many each."""
    lo, hi, step = space["n_estimators"]
    k = max(1, round(math.log(hi / lo, KEEP))) if hi > lo else 0
    return [lo] + [int(lo * (hi / lo) ** (i / k) - lo + 1e-9) // step * step + lo for i in range(1, k)] + [hi] * (hi > lo)


def fold_errors(df: DataFrame, features: list[str], keys: list[str], label: str = "label", candidates: list[dict] | None = None,
                folds: int = 5, seed: int = 42, space: dict = SPACE, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """(trial, fold, n_estimators, mae, n_rows), written: every tree count that was fitted, of every candidate and fold."""
    spark = df.sparkSession
    candidates = candidates or sample_space(10, seed, space)
    lo, _, step = space["n_estimators"]
    d = fold_column(df.where(F.col(label).isNotNull()), keys, folds, seed)
    n = d.count()
    if n > sample_rows:
        d = d.where(F.pmod(F.xxhash64(*[F.col(c) for c in keys], F.lit(seed + 1)), F.lit(1 << 30)) < int(sample_rows / n * (1 << 30)))
    pdf = d.select(*[F.col(f"`{c}`").cast("double").alias(f"x{i}") for i, c in enumerate(features)],
                   F.col(label).cast("double").alias("y"), "fold").toPandas()  # bounded by sample_rows
    if pdf["fold"].nunique() < 2:
        raise ValueError("too few rows for cross-validation")
    data = spark.sparkContext.broadcast((np.stack([binned(pdf[f"x{i}"].to_numpy()) for i in range(len(features))]),
                                         pdf["y"].to_numpy(), pdf["fold"].to_numpy()))

    def fit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        x, y, fold = data.value
        for b in batches:
            for t in b.itertuples():
                held_out = fold == t.fold
                counts = list(range(lo, t.trees + 1, step))
                mae = prefix_errors(x, y, held_out, counts, t.learning_rate, t.max_depth, t.subsample, [seed, t.trial, t.fold])
                yield pd.DataFrame({"trial": t.trial, "fold": t.fold, "n_estimators": counts, "mae": mae, "n_rows": int(held_out.sum())})

    alive, done = list(range(len(candidates))), None
    present = sorted(pdf["fold"].unique().tolist())
    for trees in rungs(space):
        tasks = [(i, k, trees, float(c["learning_rate"]), int(c["max_depth"]), float(c["subsample"]))
                 for i, c in enumerate(candidates) if i in alive for k in present]
        plan = spark.createDataFrame(tasks, "trial int, fold int, trees int, learning_rate double, max_depth int, subsample double")
        rung = cut_lineage(plan.coalesce(1).repartition(len(tasks)).mapInPandas(fit, ERRORS), "rung")
        # a longer fit repeats the errors of its prefixes, so it replaces the shorter one
        done = rung if done is None else done.where(~F.col("trial").isin(alive)).unionByName(rung)
        best = {r["trial"]: r["mae"] for r in cv_means(done).groupBy("trial").agg(F.min("cv_mae").alias("mae")).collect()}  # a row a candidate
        alive = sorted(alive, key=lambda i: (best[i], i))[:-(-len(alive) // KEEP)]
    return cut_lineage(done, "fold_errors")


def cv_means(errors: DataFrame) -> DataFrame:
    """(trial, n_estimators, cv_mae): mean over the folds."""
    return errors.groupBy("trial", "n_estimators").agg(F.avg("mae").alias("cv_mae"))


def tune(df: DataFrame, features: list[str], keys: list[str], label: str = "label", candidates: list[dict] | None = None,
         folds: int = 5, seed: int = 42, space: dict = SPACE, sample_rows: int = SAMPLE_ROWS) -> tuple[dict, DataFrame]:
    """The best setting, and every scored one: (trial, n_estimators, learning_rate, max_depth, subsample, cv_mae).

    Ties go to the smaller model, then to the earlier trial."""
    candidates = candidates or sample_space(10, seed, space)
    means = cv_means(fold_errors(df, features, keys, label, candidates, folds, seed, space, sample_rows))
    settings = df.sparkSession.createDataFrame(
        [(i, float(c["learning_rate"]), int(c["max_depth"]), float(c["subsample"])) for i, c in enumerate(candidates)],
        "trial int, learning_rate double, max_depth int, subsample double")
    means = means.join(F.broadcast(settings), "trial").select("trial", "n_estimators", "learning_rate", "max_depth", "subsample", "cv_mae")
    b = means.orderBy("cv_mae", "n_estimators", "trial").first()
    return {c: b[c] for c in ("n_estimators", "learning_rate", "max_depth", "subsample")}, means
