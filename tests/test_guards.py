"""Rules that the driver tables rarely reach: white space, scales, empty bins, missing cells, ties, settings."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerline.functions import cells, scalars
from ledgerline.operators import evaluation as E
from ledgerline.operators import features as X
from ledgerline.operators import models as ML
from ledgerline.operators import upsert as U


def test_cells_strip_like_python_and_stay_finite(spark):
    texts = ["\t5", "5\t", "\xa0$1,5 ", "1e400", "-1e400", " 7 \n", "\x1f3", "5 5", "​5"]
    df = spark.createDataFrame([(t,) for t in texts], "x string")
    got = [tuple(r) for r in df.select(cells.py_float("x"), cells.parse_money("x")).collect()]

    def want(t, drop=""):
        try:
            v = float("".join(c for c in t if c not in drop).strip())
        except ValueError:
            return None
        return v if np.isfinite(v) else None

    assert got == [(want(t), want(t, "$,")) for t in texts]
    assert df.select(scalars.pad_cik(F.lit("\t12\n"))).first()[0] == "0000000012"


def test_scale_reads_integral_numbers(spark):
    df = spark.createDataFrame([("3",), ("3.0",), (None,), ("x",), ("-2",)], "s string")
    assert [r[0] for r in df.select(scalars.scale_int("s")).collect()] == [3, 3, 0, 0, -2]


def test_histogram_has_every_bin(spark):
    df = spark.createDataFrame([(0.0, 0.0), (0.0, 3.0)], "actual double, predicted double")
    h = E.residual_histogram(df).orderBy("bin").collect()
    assert [r["n"] for r in h] == [1] + [0] * 28 + [1] and h[0]["lo_edge"] == 0.0 and h[-1]["hi_edge"] == 3.0
    assert E.residual_histogram(df.limit(0)).count() == 0


def test_metrics_leave_out_rows_without_a_prediction(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, None), (3.0, 3.0)], "actual double, predicted double")
    m = E.regression_metrics(df).first()
    assert (m["n_test"], m["mae"]) == (2, 0.5)


@pytest.mark.parametrize(("accuracy", "band"), [(10_000, 10 ** 6), (100, 10 ** 6), (100, 5)])
def test_quantiles_are_exact_whatever_the_bracket(spark, monkeypatch, accuracy, band):
    """Small tables whole, sketch brackets, and brackets that are sketched again; ties, heavy values and NULLs."""
    monkeypatch.setattr(E, "ACCURACY", accuracy)
    monkeypatch.setattr(E, "BAND_ROWS", band)
    rnd = np.random.default_rng(3)
    a, b, e = rnd.normal(size=3000), np.repeat([1.0, 2.0], 1500), np.where(rnd.random(3000) < .9, 0.0, rnd.normal(size=3000))
    df = spark.createDataFrame([(float(x), float(y), None, float(z) if i % 3 else None) for i, (x, y, z) in enumerate(zip(a, b, e, strict=True))],
                               "a double, b double, c double, e double").repartition(5)
    probs = [0.0, 0.05, 0.4999, 0.5, 0.901, 1.0]
    got = E.exact_quantile_table(df, {"a": probs, "b": probs, "c": [0.5], "e": probs})
    assert np.allclose(got["a"], np.quantile(a, probs), rtol=1e-12) and np.allclose(got["b"], np.quantile(b, probs)) and got["c"] == [None]
    assert np.allclose(got["e"], np.quantile(e[np.arange(3000) % 3 > 0], probs), rtol=1e-12)


def test_quantiles_take_two_scans(spark, monkeypatch):
    """However many columns and probabilities are wanted."""
    df = spark.range(30_000).select(*[F.rand(i).alias(f"c{i}") for i in range(6)])
    scans = []
    agg = type(df).agg
    monkeypatch.setattr(type(df), "agg", lambda self, *x: (scans.append(1), agg(self, *x))[1])
    E.exact_quantile_table(df, {f"c{i}": [0.05, 0.5, 0.95] for i in range(6)})
    assert len(scans) == 2


def test_a_missed_bracket_is_opened(spark, monkeypatch):
    """Counts beside the bracket prove it: a sketch that is off costs a scan, not the result."""
    monkeypatch.setattr(E, "ACCURACY", 100)
    monkeypatch.setattr(E.F, "percentile_approx", lambda v, ps, n: F.array(*[F.lit(-5.0) for _ in ps]) if isinstance(ps, list) else None)
    df = spark.range(1000).select(F.col("id").cast("double").alias("x"))
    monkeypatch.setattr(E.F, "percentile_approx", lambda v, ps, n: F.array(*[F.max(v) - 3 for _ in ps]))
    assert E.exact_quantiles(df, "x", [0.25, 0.5]) == [249.75, 499.5]


def test_profile_equals_the_separate_passes(spark):
    """Parser, valid share and the deviation of the imputed column, from one scan, against parsing and imputing."""
    rows = [("$1,000.5", "3%", "7", "1_0"), ("2", "–", "$8", "x"), (None, "250%", "9", "1e999"), ("-4e2", "0.5", "N/A", "inf"), ("$ 5", " 1 ", "9", "2.")]
    df = spark.createDataFrame(rows, "`Total Debt` string, `YoY Growth%` string, Staff string, Rank string")
    seen = X.profile(df, df.columns)
    assert {c: p.kind for c, p in seen.items()} == X.parser_plan(df, df.columns) == {
        "Total Debt": "money", "YoY Growth%": "percent", "Staff": "money", "Rank": "float"}
    parsed = X.parse_columns(df, {c: p.kind for c, p in seen.items()}, [])
    ratios = {r["feature"]: r["valid_ratio"] for r in X.valid_ratios(parsed, df.columns).collect()}
    medians = X.fit_medians(parsed, df.columns)
    stds = {r["feature"]: r["std"] for r in X.column_stddevs(X.impute(parsed, medians, df.columns), df.columns).collect()}
    for c, p in seen.items():
        assert p.valid_ratio == ratios[c] and abs(p.imputed_std(medians.first()[c]) - stds[c]) < 1e-9


def test_split_ranks_only_the_cut_date(spark, monkeypatch):
    """Equal to sorting everything, for every cut: rows that share a date, microseconds apart, repeat, or are no date."""
    rnd = np.random.default_rng(6)
    days = [f"2024-01-{1 + d:02d}" for d in rnd.integers(0, 6, 30)] + ["2024-01-03 10:00:00.000001", "2024-01-03 10:00:00.000002", "2024-01-03 10:00:01", "bad", "bad", "1969-12-31 23:59:59.5"]
    rows = [(d, int(k)) for d, k in zip(days, rnd.integers(0, 9, len(days)))] + [(None, 1), ("2024-01-02", 4), ("2024-01-02", 4)]
    df = spark.createDataFrame(rows, "d string, k int").repartition(3)
    ranked = []
    rank = X.global_rank
    monkeypatch.setattr(X, "global_rank", lambda d, *a: (ranked.append(d.count()), rank(d, *a))[1])
    present = sorted((r for r in rows if r[0]), key=lambda r: (r[0] == "bad", r[0] if r[0] != "bad" else "", r[1]))
    for frac in (0.0, 0.1, 0.35, 0.5, 0.65, 0.97, 1.0):
        cut = int(len(present) * (1 - frac))
        got = sorted((r.d, r.k, r.split) for r in X.chronological_split(df, "d", ["k"], frac).collect())
        assert got == sorted((*r, "train" if i < cut else "val") for i, r in enumerate(present)), frac
    assert max(ranked) < 15


def test_text_dates_are_parsed_and_bad_ones_sort_last(spark):
    rows = [("2024-01-05", 1), ("1/3/2024", 2), ("n/a", 3), (None, 4), ("20240104", 5), (" 2024-01-01 ", 6)]
    r = X.chronological_split(spark.createDataFrame(rows, "d string, k int"), "d", ["k"], 0.4).collect()
    assert {x["k"]: x["split"] for x in r} == {6: "train", 2: "train", 5: "train", 1: "val", 3: "val"}


def test_the_survivor_of_a_key_is_defined(spark):
    rows = [(1, i, f"u{i}") for i in (3, 1, 2)]
    src = spark.createDataFrame(rows, "k int, id int, url string")
    empty = src.limit(0)
    for parts in (1, 3):
        assert [tuple(r) for r in U.insert_ignore(empty, src.repartition(parts), ["k"]).collect()] == [(1, 1, "u1")]
        assert [tuple(r) for r in U.latest_per_key(src.repartition(parts), ["k"], None).collect()] == [(1, 3, "u3")]


def test_boosting_settings():
    untuned, filled = ML.gbt(), ML.gbt({"max_depth": 4})
    assert (untuned.getMaxIter(), untuned.getStepSize(), untuned.getMaxDepth()) == (100, 0.3, 6)
    assert (filled.getMaxIter(), filled.getStepSize(), filled.getMaxDepth()) == (200, 0.05, 4)
    assert all(5 <= c["n_estimators"] <= 20 for c in ML.sample_space(20, 1, {"n_estimators": (5, 20, 5)}))
    assert all(200 <= c["n_estimators"] <= 2000 for c in ML.sample_space(20, 1))


def test_validation_keeps_the_best_iteration(spark):
    rnd = np.random.default_rng(1)
    x = rnd.uniform(-1, 1, 300)
    rows = [(float(v), float(np.sin(3 * v) + rnd.normal(0, .5)), i % 3 == 0) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "x double, y double, is_val boolean")
    fit, curve = ML.validation_curve(df, ["x"], "y", "is_val", {"n_estimators": 12, "learning_rate": 0.5, "max_depth": 3})
    assert len(curve) == 12 and fit.model.stages[-1].getNumTrees == curve.index(min(curve)) + 1


def test_shared_folder_is_asked_for_off_local_masters(monkeypatch):
    from ledgerline import session

    class Conf:
        def __init__(self, master):
            self.master = master

        def get(self, key, default=None):
            return self.master if key == "spark.master" else default

    class Fake:
        def __init__(self, master):
            self.conf = Conf(master)

    with pytest.raises(ValueError, match="checkpoint"):
        session.ensure_checkpoint_dir(Fake("spark://host:7077"))
    assert session.ensure_checkpoint_dir(Fake("local[2]"))


def test_calendar_quarters_count_once_and_q4_is_derived(spark):
    from ledgerline.operators.series import calendar_summary
    rows = [("c", "m", "2023-03-31", "10-Q", 2023, "Q1", 10.0, 0), ("c", "m", "2023-06-30", "10-Q", 2023, "Q2", 10.0, 1),
            ("c", "m", "2023-09-30", "10-Q", 2023, "Q3", 10.0, 2), ("c", "m", "2022-09-30", "10-Q", 2023, "Q3", 99.0, 3),
            ("c", "m", "2023-12-31", "10-K", 2023, "FY", 42.0, 4), ("c", "m", "2022-12-31", "10-K", 2022, "FY", 1.0, 5),
            ("d", "m", "2023-12-31", "10-K", 2023, "FY", 42.0, 0), ("d", "m", "2023-09-30", "10-Q", 2023, "Q3", 7.0, 1)]
    df = spark.createDataFrame(rows, "cik string, metric string, end string, form string, fy int, fp string, val double, pos long")
    r = {x["cik"]: x for x in calendar_summary(df).collect()}
    assert (r["c"]["lq"], r["c"]["ltm"]) == (12.0, 42.0)
    assert (r["d"]["lq"], r["d"]["ltm"], r["d"]["yoy"]) == (7.0, None, None)
