"""Train-and-report (M13) and batch scoring (M7, J11) for the revenue-multiple
regression on a spreadsheet export.

load → fit feature stats (train rows only) → optional tuning → single model
or bagged ensemble → hold-out metrics → persisted models, stats and report.
"""

from __future__ import annotations

import json
import os
from datetime import datetime, timezone

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.operators import evaluation as E
from ledgerline.operators import features as X
from ledgerline.operators import models as ML
from ledgerline.operators.tuning import tune


def read_sheet(spark: SparkSession, path: str) -> DataFrame:
    """Header CSV, every cell as text."""
    return spark.read.option("header", True).option("inferSchema", False).csv(path)


def train_and_report(spark: SparkSession, sheet: DataFrame, out_dir: str, test_size: float = 0.2,
                     seed: int = 42, tune_trials: int = 0, cv_folds: int = 5, ensemble: int = 1,
                     bootstrap: bool = True) -> dict:
    """Fit, evaluate on the hold-out split and persist; returns the report dict (K8)."""
    df = X.hash_split(X.with_target(X.normalise_headers(sheet)), [X.TICKER], test_size, seed)
    train_raw = df.where(~F.col("is_test"))
    medians, names, plan = X.fit_features(train_raw)          # stats from train rows only
    feats = X.apply_features(df, medians, names, plan, carry=["is_test"])
    cols = [c.strip() + X.FEATURE_SUFFIX for c in names]
    train, test = feats.where(~F.col("is_test")), feats.where(F.col("is_test"))

    params = None
    if tune_trials > 0:
        params, _ = tune(train, cols, [X.TICKER], "rev_multiple", ML.sample_space(tune_trials, seed), cv_folds, seed)
    if ensemble > 1:
        fits = ML.train_ensemble(train, cols, [X.TICKER], "rev_multiple", params, ensemble, seed, bootstrap)
        scored = ML.predict_ensemble(fits, test).withColumnRenamed("pred_mean", "prediction")
    else:
        fits = [ML.train_model(train, cols, "rev_multiple", params, seed)]
        scored = ML.predict(fits[0], test)
    metrics = E.regression_metrics(scored, "rev_multiple", "prediction").first().asDict()

    for i, f in enumerate(fits):
        f.model.write().overwrite().save(os.path.join(out_dir, "models", f"member_{i}"))
    medians.write.mode("overwrite").parquet(os.path.join(out_dir, "medians"))
    report = {
        "timestamp": datetime.now(timezone.utc).isoformat(),
        "tuned": tune_trials > 0, "trials": tune_trials, "cv_folds": cv_folds if tune_trials else 0,
        "ensemble": ensemble > 1, "ensemble_size": ensemble,
        "feature_count": len(cols), "feature_names": cols, "parsers": plan, "params": params,
        "metrics": metrics,
    }
    spark.createDataFrame([(json.dumps(report, default=str),)], "report string") \
        .coalesce(1).write.mode("overwrite").text(os.path.join(out_dir, "report"))
    return report


def score_tickers(spark: SparkSession, sheet: DataFrame, requests: DataFrame, model_dir: str,
                  names: list[str], plan: dict[str, str], members: int) -> DataFrame:
    """J11 + M7 (batch): look up each requested ticker's row, apply the stored
    medians, predict with every member, return mean ± std."""
    medians = spark.read.parquet(os.path.join(model_dir, "medians"))
    have = set(X.normalise_headers(sheet).columns)
    missing = sorted(set(names) - have)
    if missing:  # O4: the stored feature set must be reproducible from the sheet
        raise ValueError(f"feature columns missing from the sheet: {missing}")
    feats = X.apply_features(sheet, medians, names, plan, with_label=False)
    rows = X.lookup_rows(feats, requests)
    fits = [ML.FitResult(PipelineModel.load(os.path.join(model_dir, "models", f"member_{i}")),
                         [c.strip() + X.FEATURE_SUFFIX for c in names]) for i in range(members)]
    return ML.predict_ensemble(fits, rows)


def prepare_supervised(train: DataFrame, others: dict[str, DataFrame] | None = None,
                       teacher: DataFrame | None = None, require_ps: bool = False) -> dict:
    """M3: leakage-safe feature frames for a model trained on a company snapshot.

    Feature columns are the numeric, non-leaky columns (P11); medians and the
    scaler are fitted on ``train`` only and applied to every frame (fix of
    Q19). Each frame keeps ``cik``/``ticker``/``report_date``, gets the
    teacher prediction when given (J10) and the price/sales target (F14).
    With ``require_ps`` an all-NULL target raises (fix of Q6).
    """
    cols = X.leakage_safe_columns(train)
    medians = X.fit_medians(train, cols)
    scaler = X.fit_scaler(train, cols, medians)
    ids = [c for c in ("cik", "ticker", "report_date") if c in train.columns]
    out = {"features": cols, "medians": medians, "scaler": scaler}
    for name, df in {"train": train, **(others or {})}.items():
        base = df.withColumn("ps_target", X.ps_ratio(df))
        scaled = X.standardize(base.select(*ids, "ps_target", *cols), cols, medians, scaler)
        if teacher is not None:
            scaled = X.join_teacher(scaled, teacher)
        out[name] = scaled
    if require_ps and out["train"].where(F.col("ps_target").isNotNull()).isEmpty():
        raise ValueError("price/sales target is NULL for every training row (no prices joined)")
    return out
