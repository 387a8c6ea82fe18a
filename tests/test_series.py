"""W1/W2/W3–W6 on hand-made facts (FIXTURES F-2, F-3) and tag/unit rules (F-1)."""

from helpers import doc, entries, facts_doc, one
from pyspark.sql import functions as F

from ledgerline import schemas as S
from ledgerline.operators import metrics as M
from ledgerline.operators.series import resolve_series
from ledgerline.sources.facts import facts_frame

REV = S.REVENUE_TAGS[0]


def series(spark, d, metrics=("revenue",)):
    mm = S.metric_map(spark).where(F.col("metric").isin(list(metrics)))
    return resolve_series(facts_frame(facts_doc(spark, d)), mm)


def quarter_vals(spark, es, metric="revenue", tag=REV):
    s = series(spark, doc(1, {tag: entries(*es)}), [metric])
    return [float(r.val) if r.val is not None else None
            for r in s.orderBy("form", "fy", "end").collect()]


def test_ytd_by_qtrs(spark):
    v = quarter_vals(spark, [("2023-03-31", 10, "10-Q", 2023, "Q1", 1), ("2023-06-30", 25, "10-Q", 2023, "Q2", 2),
                             ("2023-09-30", 45, "10-Q", 2023, "Q3", 3)])
    assert v == [10.0, 15.0, 20.0]


def test_ytd_by_fp_when_qtrs_missing(spark):
    v = quarter_vals(spark, [("2023-03-31", 10, "10-Q", 2023, "Q1", None), ("2023-06-30", 25, "10-Q", 2023, "Q2", None)])
    assert v == [10.0, 15.0]


def test_ytd_gap_kept(spark):
    v = quarter_vals(spark, [("2023-03-31", 10, "10-Q", 2023, "Q1", 1), ("2023-09-30", 45, "10-Q", 2023, "Q3", 3)])
    assert v == [10.0, 45.0]


def test_ytd_falls_back_to_fp_against_docstring(spark):
    v = quarter_vals(spark, [("2023-03-31", 10, "10-Q", 2023, "Q1", 1), ("2023-06-30", 12, "10-Q", 2023, "Q2", 1)])
    assert v == [10.0, 2.0]


def test_annual_form_own_group(spark):
    v = quarter_vals(spark, [("2023-12-31", 60, "10-K", 2023, "FY", 4)])
    assert v == [60.0]


def summary_for(spark, es):
    s = series(spark, doc(1, {REV: entries(*es)}))
    return M.metric_summary(s)


def q_rows(vals, form="10-Q"):
    # distinct fiscal years so W1 never subtracts (one row per (form, fy))
    return [(f"{2000 + i}-03-31", v, form, 2000 + i, "Q1", 1) for i, v in enumerate(vals)]


def test_latest_metrics_table(spark):
    cases = {
        (1, 2, 3): (3, 12, None, None),
        (1, 2, 3, 4): (4, 16, 10, None),
        (2, 1, 2, 3, 4): (4, 16, 10, 100.0),
        (0, 1, 2, 3, 4): (4, 16, 10, None),
        (-2, 1, 2, 3, 4): (4, 16, 10, -300.0),
    }
    for vals, (lq, ann, ltm, yoy) in cases.items():
        r = one(summary_for(spark, q_rows(vals)))
        assert (r.lq, r.annualized, r.ltm, r.yoy) == (lq, ann, ltm, yoy), vals


def test_quarterly_tier_beats_annual(spark):
    r = one(summary_for(spark, [("2023-03-31", 1, "10-Q", 2023, "Q1", 1),
                                ("2023-12-31", 9, "10-K", 2023, "FY", 4)]))
    assert (r.lq, r.annualized, r.ltm, r.yoy) == (1, 4, None, None)


def test_any_form_tier(spark):
    r = one(summary_for(spark, [("2023-03-31", 7, "8-K", 2023, "Q1", 1)]))
    assert (r.lq, r.annualized) == (7, 28)


def test_no_rows_no_summary(spark):
    s = series(spark, doc(1, {"Other": entries(("2023-03-31", 1, "10-Q", 2023, "Q1", 1))}))
    assert M.metric_summary(s).count() == 0


def test_first_tag_with_rows_wins_no_splice(spark):
    d = doc(1, {REV: entries(("2019-03-31", 5, "10-Q", 2019, "Q1", 1)),
                "Revenues": entries(*[(f"{2000 + i}-03-31", 100 + i, "10-Q", 2000 + i, "Q1", 1) for i in range(12)])})
    s = series(spark, d)
    assert {r.tag for r in s.collect()} == {REV}
    assert s.count() == 1


def test_unit_filter_and_scale(spark):
    d = {"cik": 7, "facts": {"us-gaap": {
        REV: {"units": {"EUR": [{"end": "2023-03-31", "val": 1, "form": "10-Q", "fy": 2023, "fp": "Q1"}]}},
        "NetIncomeLoss": {"units": {"USD": [
            {"end": "2023-03-31", "val": 10, "scale": 3, "form": "10-Q", "fy": 2023, "fp": "Q1"},
            {"end": "2023-06-30", "val": "abc", "form": "10-Q", "fy": 2023, "fp": "Q2"},
            {"end": "2023-06-30", "val": None, "form": "10-Q", "fy": 2023, "fp": "Q2"},
            {"end": "2022-06-30", "val": 4, "scale": "x", "form": "10-Q", "fy": 2022, "fp": "Q2"},
            {"end": "2022-03-31", "val": 1, "segment": {"axis": "x"}, "form": "10-Q", "fy": 2022, "fp": "Q1"},
            {"end": "2021-03-31", "val": 2, "segment": {}, "form": "10-Q", "fy": 2021, "fp": "Q1"},
            {"end": "2020-03-31", "val": 3, "dimensional": True, "form": "10-Q", "fy": 2020, "fp": "Q1"},
        ]}}}}}
    f = facts_frame(facts_doc(spark, d))
    got = sorted((r.end.isoformat(), r.val, r.scale_applied) for r in f.where(F.col("tag") == "NetIncomeLoss").collect())
    assert got == [("2021-03-31", 2.0, 0), ("2022-06-30", 4.0, 0), ("2023-03-31", 10000.0, 3)]
    s = series(spark, d, ["revenue"])
    assert s.count() == 0  # EUR only: no revenue


def test_shares_fall_back_to_dei(spark):
    d = doc(1, {}, extra_ns={"dei": {S.SHARES_DEI_TAG: {"units": {"shares": entries(("2023-03-31", 50, "10-Q", 2023, "Q1"))}}}})
    r = one(M.metric_summary(series(spark, d, ["shares"])))
    assert r.lq == 50 and r.tag == S.SHARES_DEI_TAG


def test_cash_components_sum_and_null_keys(spark):
    d = doc(1, {S.CASH_COMPONENT_TAGS[0]: entries(("2023-03-31", 5, "10-Q", 2023, "Q1"),
                                                  ("2023-06-30", 6, "10-Q", None, "Q2")),
                S.CASH_COMPONENT_TAGS[1]: entries(("2023-03-31", 2, "10-Q", 2023, "Q1"))})
    s = series(spark, d, ["cash"])
    got = [(r.end.isoformat(), float(r.val), r.tag) for r in s.collect()]
    assert got == [("2023-03-31", 7.0, S.CASH_COMPOSITE_TAG)]


def test_deferred_revenue_tiers(spark):
    legacy = doc(1, {S.DEFERRED_LEGACY_TAGS[0]: entries(("2023-03-31", 3, "10-Q", 2023, "Q1")),
                     S.DEFERRED_LEGACY_TAGS[1]: entries(("2023-03-31", 4, "10-Q", 2023, "Q1")),
                     S.DEFERRED_TOTAL_TAG: entries(("2023-03-31", 100, "10-Q", 2023, "Q1"))})
    assert one(M.metric_summary(series(spark, legacy, ["deferred_revenue"]))).lq == 7
    total = doc(1, {S.DEFERRED_TOTAL_TAG: entries(("2023-03-31", 100, "10-Q", 2023, "Q1"))})
    assert one(M.metric_summary(series(spark, total, ["deferred_revenue"]))).lq == 100


def test_ebitda_composite_shared_periods(spark):
    op = entries(*[(f"2023-0{m}-28", 10 * m, "10-Q", 2023 + m, "Q1", 1) for m in (1, 2, 3, 4)])
    da = entries(*[(f"2023-0{m}-28", m, "10-Q", 2023 + m, "Q1", 1) for m in (1, 2, 3, 5)])
    s = series(spark, doc(1, {S.OPERATING_INCOME_TAG: op, S.DA_TAG: da}), ["ebitda"])
    assert sorted(float(r.val) for r in s.collect()) == [11.0, 22.0, 33.0]


def test_ebitda_direct_wins(spark):
    d = doc(1, {S.EBITDA_DIRECT_TAG: entries(("2010-03-31", 1, "10-Q", 2010, "Q1", 1)),
                S.OPERATING_INCOME_TAG: entries(("2023-03-31", 10, "10-Q", 2023, "Q1", 1)),
                S.DA_TAG: entries(("2023-03-31", 1, "10-Q", 2023, "Q1", 1))})
    r = one(M.metric_summary(series(spark, d, ["ebitda"])))
    assert r.lq == 1 and r.tag == S.EBITDA_DIRECT_TAG


def test_repartition_invariance(spark):
    d = doc(1, {REV: entries(*q_rows([1, 2, 3, 4, 5, 6]))})
    f = facts_frame(facts_doc(spark, d))
    base = sorted(M.metric_summary(resolve_series(f, S.metric_map(spark))).collect())
    for n in (1, 7):
        again = sorted(M.metric_summary(resolve_series(f.repartition(n), S.metric_map(spark))).collect())
        assert again == base


def test_strict_qtrs_flag(spark):
    from ledgerline.operators.series import to_quarterly_col
    df = spark.createDataFrame(
        [("1", "revenue", "t", "10-Q", 2023, "2023-03-31", 0, 1, "Q1", 10.0),
         ("1", "revenue", "t", "10-Q", 2023, "2023-06-30", 1, 1, "Q2", 12.0)],
        "cik string, metric string, tag string, form string, fy int, end string, pos long, qtrs int, fp string, val double")
    parity = [r.v for r in df.select(to_quarterly_col().alias("v")).orderBy("v").collect()]
    strict = [r.v for r in df.select(to_quarterly_col(strict_qtrs=True).alias("v")).orderBy("v").collect()]
    assert sorted(parity) == [2.0, 10.0] and sorted(strict) == [10.0, 12.0]


def test_calendar_mode_skips_gaps(spark):
    from ledgerline.operators.series import calendar_summary
    # quarters 2022Q1..Q3 and 2023Q1, Q3 (2023Q2 missing); values already quarterly
    rows = [("2022-03-31", 1, 2022, "Q1"), ("2022-06-30", 2, 2022, "Q2"), ("2022-09-30", 3, 2022, "Q3"),
            ("2023-03-31", 5, 2023, "Q1"), ("2023-09-30", 6, 2023, "Q3")]
    df = spark.createDataFrame([("1", "revenue", "10-Q", fy, fp, float(v)) for _, v, fy, fp in rows],
                               "cik string, metric string, form string, fy int, fp string, val double")
    r = one(calendar_summary(df))
    assert (r.lq, r.ltm, r.yoy) == (6.0, None, 100.0)  # LTM needs 4 quarters; YoY vs 2022Q3 = 3


def test_fast_path_equals_resolve_then_rank(spark):
    """latest_series (tag choice inside the top-n) == latest_rows(resolve_series(...))."""
    from ledgerline.operators.series import latest_rows, latest_series
    docs = [
        doc(1, {REV: entries(("2019-03-31", 5, "10-Q", 2019, "Q1", 1)),
                "Revenues": entries(*[(f"{2000 + i}-03-31", 100 + i, "10-Q", 2000 + i, "Q1", 1) for i in range(12)]),
                S.OPERATING_INCOME_TAG: entries(("2023-03-31", 10, "10-Q", 2023, "Q1", 1),
                                                ("2023-06-30", 25, "10-Q", 2023, "Q2", 2)),
                S.DA_TAG: entries(("2023-03-31", 1, "10-Q", 2023, "Q1", 1)),
                S.CASH_COMPONENT_TAGS[0]: entries(("2023-06-30", 6, "10-Q", None, "Q2")),  # NULL fy only
                S.DEFERRED_TOTAL_TAG: entries(("2023-03-31", 9, "10-K", 2023, "FY"))}),
        doc(2, {S.EBITDA_DIRECT_TAG: entries(("2010-03-31", 1, "10-Q", 2010, "Q1", 1)),
                S.OPERATING_INCOME_TAG: entries(("2023-03-31", 10, "10-Q", 2023, "Q1", 1)),
                S.DA_TAG: entries(("2023-03-31", 1, "10-Q", 2023, "Q1", 1)),
                S.DEFERRED_LEGACY_TAGS[0]: entries(("2023-03-31", 3, "10-Q", 2023, "Q1"),
                                                   ("2022-12-31", 2, "10-K", 2022, "FY")),
                S.DEFERRED_TOTAL_TAG: entries(("2023-03-31", 100, "10-Q", 2023, "Q1"))},
            extra_ns={"dei": {S.SHARES_DEI_TAG: {"units": {"shares": entries(("2023-03-31", 50, "8-K", 2023, "Q1"))}}}}),
    ]
    f = facts_frame(facts_doc(spark, docs[0])).unionByName(facts_frame(facts_doc(spark, docs[1])))
    mm = S.metric_map(spark)
    cols = ["cik", "metric", "rn", "val", "end", "form", "fy", "fp", "tag"]
    slow = sorted(tuple(r) for r in latest_rows(resolve_series(f, mm, checkpoint=False), 8).select(*cols).collect())
    fast = sorted(tuple(r) for r in latest_series(f, mm, 8).select(*cols).collect())
    assert fast == slow
    assert not any(r[1] == "cash" for r in fast)  # the NULL-fy cash tier wins and yields nothing


def test_raw_facts_last_four_and_dims(spark):
    from ledgerline.sources.facts import raw_facts
    es = [{"end": f"2020-0{i}-28", "val": i, "form": "10-Q", "fy": 2020, "fp": "Q1"} for i in range(1, 7)]
    es[5]["dimensional"] = True
    d = {"cik": 3, "facts": {"us-gaap": {"Revenues": {"units": {"USD": es}}},
                             "dei": {S.SHARES_DEI_TAG: {"units": {"shares": es[:2]}}}}}
    got = raw_facts(facts_doc(spark, d)).orderBy("end").collect()
    assert [r.val for r in got] == [3.0, 4.0, 5.0, 6.0]  # last four entries, us-gaap only
    assert got[-1].dims == "true" and got[0].dims == "null"


def test_dimensional_text_variants(spark):
    from ledgerline.sources.facts import is_nondimensional
    rows = [(None, None, True), ("{}", None, True), ('{"a": 1}', None, False), (None, "false", True),
            (None, "0", True), (None, "[]", True), (None, "true", False), (None, "1", False), (" { } ", None, True)]
    df = spark.createDataFrame([(a, b) for a, b, _ in rows], "segment string, dimensional string")
    got = [r.k for r in df.select(is_nondimensional(F.col("segment"), F.col("dimensional")).alias("k")).collect()]
    assert got == [k for _, _, k in rows]


def test_ranged_lag_equals_window_with_a_hot_group(spark):
    """to_quarterly_ranged == to_quarterly when one group spans many partitions."""
    import random as _r

    from ledgerline.operators.series import to_quarterly, to_quarterly_ranged
    rnd = _r.Random(7)
    rows = []
    for i in range(3000):  # one hot group: same company/metric/tag/form/fy
        rows.append(("hot", "revenue", "t", "10-Q", 2020, f"2020-{1 + i % 12:02d}-{1 + i % 28:02d}", i,
                     rnd.choice([None, 1, 2, 3]), rnd.choice(["Q1", "Q2", "Q3", None]), float(rnd.randint(-50, 50))))
    for c in range(40):  # many small groups, some with NULL fy
        for q in range(1, 4):
            rows.append((f"c{c}", "revenue", "t", "10-Q", None if c % 5 == 0 else 2021, f"2021-0{3 * q}-28", q,
                         q, f"Q{q}", float(q * 10 + c)))
    df = spark.createDataFrame(rows, "cik string, metric string, tag string, form string, fy int, end string, "
                                     "pos long, qtrs int, fp string, val double").repartition(9)
    df = df.withColumn("end", F.col("end").cast("date"))
    key = ["cik", "pos"]
    a = sorted((r.cik, r.pos, r.val) for r in to_quarterly(df).select(*key, "val").collect())
    # without coalescing, the 3,000-row group spreads over several range partitions, so the
    # partition-boundary carry is exercised (AQE would merge this small input into one)
    conf = "spark.sql.adaptive.coalescePartitions.enabled"
    old = spark.conf.get(conf)
    spark.conf.set(conf, "false")
    try:
        b = sorted((r.cik, r.pos, r.val) for r in to_quarterly_ranged(df.repartition(16)).select(*key, "val").collect())
    finally:
        spark.conf.set(conf, old)
    assert a == b


def test_ranged_lag_option_in_series_paths(spark, sf_dir):
    from ledgerline.operators.series import latest_series
    from ledgerline.sources import driver as D
    f = D.lineitem_facts(spark, sf_dir)
    mm = S.metric_map(spark)
    cols = ["cik", "metric", "rn", "val", "end", "tag"]
    base = sorted(tuple(r) for r in latest_series(f, mm, 8).select(*cols).collect())
    ranged = sorted(tuple(r) for r in latest_series(f, mm, 8, ranged_lag=True).select(*cols).collect())
    assert base == ranged
    full = sorted(tuple(r) for r in resolve_series(f, mm, checkpoint=False, ranged_lag=True)
                  .select("cik", "metric", "val", "end").collect())
    full0 = sorted(tuple(r) for r in resolve_series(f, mm, checkpoint=False).select("cik", "metric", "val", "end").collect())
    assert full == full0


def test_latest_series_reads_facts_once_and_bounds_its_tasks(spark, sf_dir, tmp_path, monkeypatch):
    """Branches read the tagged facts, not the source; more rows make more tasks, with the same result."""
    from ledgerline.operators import series as R
    from ledgerline.sources.driver import lineitem_facts
    path = str(tmp_path / "facts")
    lineitem_facts(spark, sf_dir).write.parquet(path)
    f, mm = spark.read.parquet(path), S.metric_map(spark)
    cols = ["cik", "metric", "kind", "tag", "end", "form", "fy", "fp", "val", "rn"]
    run = lambda: R.latest_series(f, mm, 8).select(*cols)
    one_task = run()
    assert one_task.inputFiles() and not any(path in x for x in one_task.inputFiles())
    want = sorted(tuple(r) for r in one_task.collect())
    monkeypatch.setattr(R, "TASK_ROWS", 100)
    many = run()
    n = -(-R.attach_metric_map(f, mm).count() // 100)
    assert f", {n}), REPARTITION_BY_NUM" in many._jdf.queryExecution().executedPlan().toString()
    assert sorted(tuple(r) for r in many.collect()) == want and want


def test_filer_facts_divide_only_present_entries(spark, sf_dir):
    """The entries of a customer's quarter carry cents; only those that are present become money."""
    from ledgerline.sources.filers import filer_facts
    plan = filer_facts(spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    entries = next(x for x in plan.splitlines() if "Generate explode" in x)
    assert "decimal" not in entries and " / " not in entries
