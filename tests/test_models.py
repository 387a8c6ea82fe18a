"""Rows-only queries checked by brute force / contracts (no SQL twin)."""

import struct

import numpy as np
import xxhash
from pyspark.sql import functions as F


def _spark_xxhash64(values, seed):
    """Spark's xxhash64 over string columns then an int literal: seeds chain column by column."""
    h = seed
    for v in values:
        if isinstance(v, str):
            h = xxhash.xxh64_intdigest(v.encode("utf-8"), seed=h)
        else:
            h = xxhash.xxh64_intdigest(struct.pack("<i", v), seed=h)
    return h - (1 << 64) if h >= (1 << 63) else h


def test_hash_split_matches_brute_force(spark):
    from ledgerline.operators.features import hash_split
    rows = [(f"{i:010d}", f"2020-01-{1 + i % 28:02d}") for i in range(400)]
    df = spark.createDataFrame(rows, "cik string, report_date string")
    got = {(r.cik, r.report_date): r.is_test for r in hash_split(df, ["cik", "report_date"], 0.2, 42).collect()}
    want = {}
    for cik, d in rows:
        h = _spark_xxhash64([cik, d, 42], 42)
        want[(cik, d)] = (h % 10000) < 2000  # pmod: Python % is already non-negative
    assert got == want


def test_gbt_query_is_deterministic(spark, sf_dir, monkeypatch):
    """Seeded trees and hash splits: two runs give identical hold-out predictions."""
    from ledgerline.catalog import gbt_train_score
    from ledgerline.operators import models as ML
    assert ML.DEFAULTS["n_estimators"] == 200
    monkeypatch.setitem(ML.DEFAULTS, "n_estimators", 15)
    a = {(r.l_orderkey, r.l_linenumber, r.label): r.prediction for r in gbt_train_score(spark, sf_dir).collect()}
    b = {(r.l_orderkey, r.l_linenumber, r.label): r.prediction for r in gbt_train_score(spark, sf_dir).collect()}
    assert a == b and len(a) > 0


def test_gbt_learns_a_known_signal_and_bagging_spreads(spark):
    """On data with a real signal the fitted trees beat the mean predictor by far
    (lineitem's label is unrelated to its features, so this uses a fixture)."""
    import random

    from ledgerline.operators import models as ML
    rnd = random.Random(1)
    rows = []
    for i in range(2000):
        x1, x2 = rnd.uniform(0, 10), rnd.uniform(0, 1)
        rows.append((i, x1, x2, 3.0 * x1 + (5.0 if x2 > 0.5 else 0.0) + rnd.gauss(0, 0.5)))
    df = spark.createDataFrame(rows, "k long, x1 double, x2 double, label double")
    train, test = df.where(F.col("k") % 5 != 0), df.where(F.col("k") % 5 == 0)
    fit = ML.train_model(train, ["x1", "x2"], "label", {"n_estimators": 30, "max_depth": 3, "learning_rate": 0.2})
    scored = ML.predict(fit, test).collect()
    mean = train.agg(F.avg("label")).first()[0]
    mae = sum(abs(r.prediction - r.label) for r in scored) / len(scored)
    mae_mean = sum(abs(mean - r.label) for r in scored) / len(scored)
    assert mae < 0.25 * mae_mean
    fits = ML.train_ensemble(train, ["x1", "x2"], ["k"], "label",
                             {"n_estimators": 10, "max_depth": 2, "learning_rate": 0.3}, members=3)
    one = ML.train_model(train.withColumn("w", ML.poisson_weight(["k"], 43)), ["x1", "x2"], "label",
                         {"n_estimators": 10, "max_depth": 2, "learning_rate": 0.3}, 43, "w")
    alone = [r.prediction for r in ML.predict(one, test).orderBy("k").collect()]
    assert np.allclose([r.prediction for r in ML.predict(fits[1], test).orderBy("k").collect()], alone)  # fitted side by side or alone
    ens = ML.predict_ensemble(fits, test).collect()
    assert all(r.pred_std >= 0 for r in ens) and any(r.pred_std > 0 for r in ens)


def test_tree_equals_brute_force():
    """Best split by squared error at every node, on few distinct values."""
    from ledgerline.operators import tuning as U
    rng = np.random.default_rng(3)
    raw, y = rng.integers(0, 9, (3, 120)).astype(float), rng.normal(size=120)
    raw[0, ::10] = np.nan
    x = np.stack([U.binned(v) for v in raw])
    assert (x[0, ::10] == 0).all() and (x[0, 1::10] > 0).all()

    def brute(rows, depth):
        out = {i: y[rows].mean() for i in rows}
        if depth and len(rows) > 1:
            sse = lambda r: ((y[r] - y[r].mean()) ** 2).sum()
            cuts = [(sse(lo) + sse(hi), f, c, lo, hi) for f in range(3) for c in range(10)
                    for lo, hi in [([i for i in rows if x[f, i] <= c], [i for i in rows if x[f, i] > c])] if lo and hi]
            if cuts:
                best = min(cuts, key=lambda v: v[0])
                out = brute(best[3], depth - 1) | brute(best[4], depth - 1)
        return out

    got = U.grow(x, y, np.arange(120), 3)
    want = brute(list(range(120)), 3)
    assert np.allclose(got, [want[i] for i in range(120)])


def _signal(spark, n=600):
    rng = np.random.default_rng(7)
    x = rng.uniform(0, 10, (n, 2))
    return spark.createDataFrame([(i, float(a), float(b), float(3 * a + (5 if b > 5 else 0) + e))
                                  for i, ((a, b), e) in enumerate(zip(x, rng.normal(0, .5, n)))], "k long, x1 double, x2 double, label double")


def test_tuning_scores_every_prefix_and_means_equal_sql(spark, tmp_path):
    """Fold errors are stored; DuckDB averages them to the same means; a longer fit repeats the errors of its prefixes."""
    import duckdb

    from ledgerline.operators import models as ML
    from ledgerline.operators import tuning as U
    space = dict(ML.SPACE, n_estimators=(4, 40, 4))
    assert U.rungs() == [200, 600, 2000] and U.rungs(space) == [4, 12, 40] and U.rungs(dict(space, n_estimators=(5, 5, 1))) == [5]
    df, cands = _signal(spark), ML.sample_space(7, 1, space)
    err = U.fold_errors(df, ["x1", "x2"], ["k"], "label", cands, 3, 5, space)
    rows = err.collect()
    by_trial = {t: {r.n_estimators for r in rows if r.trial == t} for t in range(7)}
    assert sorted(map(len, by_trial.values())) == [1, 1, 1, 1, 3, 3, 10]
    assert all(sum(r.n_rows for r in rows if (r.trial, r.n_estimators) == (t, 4)) == 600 for t in range(7))
    path = str(tmp_path / "errors")
    err.write.parquet(path)
    want = duckdb.sql(f"SELECT trial, n_estimators, avg(mae) FROM '{path}/*.parquet' GROUP BY ALL").fetchall()
    got = [tuple(r) for r in U.cv_means(err).collect()]
    assert [(t, n) for t, n, _ in sorted(got)] == [(t, n) for t, n, _ in sorted(want)]
    assert np.allclose([m for *_, m in sorted(got)], [m for *_, m in sorted(want)])
    best, means = U.tune(df, ["x1", "x2"], ["k"], "label", cands, 3, 5, space)
    b = min(means.collect(), key=lambda r: (r.cv_mae, r.n_estimators, r.trial))
    assert best == {c: b[c] for c in ("n_estimators", "learning_rate", "max_depth", "subsample")}
    assert b.cv_mae < 2.0  # the mean predictor is off by about 7.6


def test_tuning_samples_large_tables_within_its_bound(spark):
    from ledgerline.operators import models as ML
    from ledgerline.operators import tuning as U
    space = dict(ML.SPACE, n_estimators=(2, 4, 2))
    err = U.fold_errors(_signal(spark, 3000), ["x1", "x2"], ["k"], "label", ML.sample_space(1, 1, space), 3, 5, space, sample_rows=500)
    n = err.where("n_estimators = 2").agg(F.sum("n_rows")).first()[0]
    assert 400 < n < 600


def test_gbt_tune_searches_the_operators_space(spark, sf_dir, monkeypatch):
    from ledgerline.catalog import gbt_tune
    from ledgerline.operators import models as ML
    from ledgerline.operators import tuning as U
    seen = []
    monkeypatch.setattr(U, "tune", lambda d, f, k, label, candidates, folds, seed: (seen.extend(candidates), (None, d))[1])
    gbt_tune(spark, sf_dir)
    lo, hi, step = ML.SPACE["n_estimators"]
    assert len(seen) == 10 and all(lo <= c["n_estimators"] <= hi and (c["n_estimators"] - lo) % step == 0 for c in seen)


def _kd_rows():
    rng = np.random.default_rng(2)
    rows = []
    for i in range(200):
        a, b = rng.uniform(0, 10, 2)
        y, t = 2 * a + rng.normal(), 2 * a + (4 if b > 5 else 0)
        rows.append((i, float(a), float(b), None if i % 5 == 0 else float(y), float("nan") if i % 7 == 0 else float(t)))
    return rows


def test_student_equals_a_brute_force_booster(spark):
    """Exact trees on the negative gradient, the best of the steps each round; the loss falls every round."""
    from ledgerline.operators import distillation as K
    rows = [r for r in _kd_rows() if not (r[3] is None and np.isnan(r[4]))]
    df = spark.createDataFrame(_kd_rows(), "k long, x1 double, x2 double, y double, t double")
    fit = K.fit_student(df, ["x1", "x2"], "y", "t", rounds=6, max_depth=2, max_bins=256)
    x = np.array([[r[1], r[2]] for r in rows])
    y = np.array([np.nan if r[3] is None else r[3] for r in rows])
    t = np.array([r[4] for r in rows])
    loss = lambda s: .7 * np.nanmean(abs(s - y)) + .3 * np.nanmean((s - t) ** 2)

    def tree(g, idx, depth):
        out = np.zeros(len(g))
        out[idx] = g[idx].mean()
        if depth:
            best = None
            for f in range(2):
                v = np.unique(x[idx, f])
                for c in (v[1:] + v[:-1]) / 2:
                    lo, hi = idx[x[idx, f] <= c], idx[x[idx, f] > c]
                    e = g[lo].var() * len(lo) + g[hi].var() * len(hi)
                    if best is None or e < best[0] - 1e-12:
                        best = (e, lo, hi)
            if best:
                out = tree(g, best[1], depth - 1) + tree(g, best[2], depth - 1)
        return out

    n, n_y, n_t = len(y), (~np.isnan(y)).sum(), (~np.isnan(t)).sum()
    s = np.full(n, .7 * np.nanmean(y) + .3 * np.nanmean(t))
    want = [loss(s)]
    for _ in range(6):
        g = np.nan_to_num(np.sign(y - s)) * .7 * n / n_y + np.nan_to_num(t - s) * .6 * n / n_t
        p = tree(g, np.arange(n), 2)
        s = min((s + k * p for k in K.STEPS), key=loss)
        want.append(loss(s))
    got = [a for a, _ in fit.losses]
    assert np.allclose(got, want, rtol=1e-9) and all(b < a for a, b in zip(got, got[1:]))
    pred = {r.k: r.prediction for r in K.predict_student(fit, df).collect()}
    assert np.allclose([pred[r[0]] for r in rows], s)


def test_student_stops_at_the_best_validation_round(spark, tmp_path):
    from pyspark.ml.regression import GBTRegressionModel

    from ledgerline.operators import distillation as K
    from ledgerline.operators.evaluation import kd_loss
    df = spark.createDataFrame(_kd_rows(), "k long, x1 double, x2 double, y double, t double").withColumn("v", F.col("k") % 4 == 0)
    fit = K.fit_student(df, ["x1", "x2"], "y", "t", "v", rounds=12, patience=3)
    val = [v for _, v in fit.losses]
    best = min(range(len(val)), key=val.__getitem__)
    assert fit.model.getNumTrees == best and len(val) - 1 <= best + 3
    scored = K.predict_student(fit, df)
    assert abs(kd_loss(scored.where("v"), "prediction", "y", "t").first()["loss"] - val[best]) < 1e-9
    fit.model.write().overwrite().save(str(tmp_path / "m"))
    assert GBTRegressionModel.load(str(tmp_path / "m")).getNumTrees == best
    only = K.fit_student(df, ["x1", "x2"], None, "t", rounds=2)
    assert only.losses[-1][0] < only.losses[0][0]


def _cell_rows(spark, n=3000):
    rng = np.random.default_rng(5)
    rows = [(i, float(rng.integers(0, 6)), float(rng.integers(0, 4)) if i % 11 else None, float(rng.integers(1, 4))) for i in range(n)]
    return spark.createDataFrame([(i, a, b, w, 2 * a + (9 if b and b > 1 else 0) + float(rng.integers(0, 3))) for i, a, b, w in rows],
                                 "k long, x1 double, x2 double, w double, label double")


def test_boosting_reads_cells_and_equals_a_fit_on_rows(spark, monkeypatch):
    """Rounds read a row a cell, not every row; trees and predictions are those of the rows."""
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import VectorAssembler

    from ledgerline.operators import models as ML
    df, params, seen = _cell_rows(spark), {"n_estimators": 8, "max_depth": 3, "learning_rate": 0.3}, []
    plain = df.fillna(99.0, ["x2"])
    stages = [VectorAssembler(inputCols=["x1", "x2"], outputCol="features"), ML.gbt(params, 42, "label", "w")]
    want = {r.k: r.prediction for r in Pipeline(stages=stages).fit(plain).transform(plain).collect()}
    own = ML.GBTRegressor.fit
    monkeypatch.setattr(ML.GBTRegressor, "fit", lambda self, d: (seen.append(d.count()), own(self, d))[1])
    fit = ML.train_model(df, ["x1", "x2"], "label", params, 42, "w")
    assert seen == [6 * 5]
    got = {r.k: r.prediction for r in ML.predict(fit, df).collect()}
    assert np.allclose([got[k] for k in want], list(want.values()))
    assert " in {" not in fit.model.stages[-1].toDebugString  # bins are split in order
    assert ML.predict(fit, df).columns == [*df.columns, "prediction"]
    nan = df.withColumn("x2", F.coalesce("x2", F.lit(float("nan"))))
    assert {r.k: r.prediction for r in ML.predict(fit, nan).collect()} == got


def test_bins_of_a_feature_with_many_values_are_even(spark):
    from ledgerline.operators import models as ML
    df = spark.range(20_000).select((F.col("id") * F.col("id")).cast("double").alias("x"), F.lit(3.0).alias("c"))
    binned = ML.fit_bins(df, ["x", "c"]).transform(df)
    counts = [r["count"] for r in binned.groupBy("__bin0").count().collect()]
    assert len(counts) == ML.BINS and max(counts) < 1.2 * min(counts)
    assert binned.select("__bin1").distinct().count() == 1


def test_student_reads_pieces_of_cells(spark, monkeypatch):
    """A tree is fitted to a row a cell; a cell cut in pieces gives the same losses."""
    from ledgerline.operators import distillation as K
    df, seen = _cell_rows(spark, 1200).withColumn("t", F.when(F.col("k") % 3 != 0, F.col("label") + 1)), []
    own = K.DecisionTreeRegressor.fit
    monkeypatch.setattr(K.DecisionTreeRegressor, "fit", lambda self, d: (seen.append(d.count()), own(self, d))[1])
    fit = lambda: K.fit_student(df, ["x1", "x2"], "label", "t", rounds=4)
    whole = fit().losses
    assert max(seen) == 6 * 5
    seen.clear()
    monkeypatch.setattr(K, "PIECE", 10)
    assert np.allclose([a for a, _ in fit().losses], [a for a, _ in whole]) and min(seen) > 6 * 5
