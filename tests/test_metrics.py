"""Margins (FIXTURES F-4), stamps and the fundamentals row."""

from helpers import doc, entries, facts_doc

from ledgerline import schemas as S
from ledgerline.functions.scalars import safe_ratio_pct
from ledgerline.operators import metrics as M
from ledgerline.operators.series import resolve_series
from ledgerline.sources.facts import facts_frame

REV, NI = S.REVENUE_TAGS[0], S.NET_INCOME_TAGS[0]


def fund(spark, d, filing_dates=None):
    f = facts_frame(facts_doc(spark, d))
    summ = M.metric_summary(resolve_series(f, S.metric_map(spark)))
    comp = spark.createDataFrame([("%010d" % d["cik"],)], "cik string")
    return M.fundamentals_frame(comp, summ, filing_dates).collect()[0]


def test_guard_values(spark):
    df = spark.createDataFrame([(20.0, 100.0), (20.0, 0.0), (20.0, -5.0), (150.0, 100.0), (-100.0, 100.0)],
                               "n double, d double")
    got = [r.m for r in df.select(safe_ratio_pct("n", "d").alias("m")).collect()]
    assert got == [20.0, None, None, None, -100.0]


def test_margin_same_period_only(spark):
    same = doc(1, {REV: entries(("2023-03-31", 100, "10-Q", 2023, "Q1", 1)),
                   NI: entries(("2023-03-31", 20, "10-Q", 2023, "Q1", 1))})
    assert fund(spark, same).net_income_margin == 20.0
    other = doc(1, {REV: entries(("2023-03-31", 100, "10-Q", 2023, "Q1", 1)),
                    NI: entries(("2022-03-31", 20, "10-Q", 2022, "Q1", 1))})
    assert fund(spark, other).net_income_margin is None


def test_stamps_fallback_chain(spark):
    r = fund(spark, doc(1, {REV: entries(("2023-03-31", 100, "10-Q", 2023, "Q1", 1)),
                            NI: entries(("2024-03-31", 20, "10-Q", 2024, "Q1", 1))}))
    assert (r.report_date, r.fiscal_year, r.fiscal_period) == ("2023-03-31", 2023, "Q1")
    r = fund(spark, doc(1, {NI: entries(("2024-03-31", 20, "10-Q", 2024, "Q1", 1))}))
    assert r.report_date == "2024-03-31"
    r = fund(spark, doc(1, {S.OPERATING_INCOME_TAG: entries(("2021-06-30", 5, "10-Q", 2021, "Q2", 2))}))
    assert (r.report_date, r.fiscal_period) == ("2021-06-30", "Q2")
    fd = spark.createDataFrame([("0000000001", "2020-01-05"), ("0000000001", "2020-02-01")],
                               "cik string, filing_date string")
    r = fund(spark, doc(1, {"Unused": entries(("2021-06-30", 5, "10-Q", 2021, "Q2", 2))}), fd)
    assert (r.report_date, r.fiscal_year, r.fiscal_period) == ("2020-02-01", None, None)


def test_unwritten_columns_null_and_schema(spark):
    r = fund(spark, doc(1, {REV: entries(("2023-03-31", 100, "10-Q", 2023, "Q1", 1))}))
    for c in S.UNWRITTEN_COLUMNS + ["stock_price", "market_cap"]:
        assert r[c] is None
    assert list(r.asDict()) == [f.name for f in S.FUNDAMENTALS_SCHEMA.fields]


def test_audit_rows(spark):
    d = doc(1, {REV: entries(("2023-03-31", 100, "10-Q", 2023, "Q1", 1))})
    f = facts_frame(facts_doc(spark, d))
    summ = M.metric_summary(resolve_series(f, S.metric_map(spark)))
    comp = spark.createDataFrame([("0000000001",)], "cik string")
    a = M.audit_frame(summ, M.fundamentals_frame(comp, summ)).collect()
    assert [(r.metric, r.value, r.source_tag, r.form) for r in a] == [("revenue_lq", 100.0, REV, "10-Q")]
