"""Company metrics from resolved series: LQ / annualized / LTM / YoY, aligned
margins, report stamps, the fundamentals row and its audit rows.

All of it is one lineage keyed by company: the per-(cik, metric) summary
(at most one row per company and metric) is folded into one row per
company with a single conditional aggregation, so no per-metric join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline import schemas as S
from ledgerline.functions.scalars import safe_ratio_pct
from ledgerline.operators.series import latest_rows, latest_series, series_summary

FLOW_METRICS = ["revenue", "ebitda", "net_income"]
BALANCE_METRICS = {"cash": "cash_sti", "debt": "total_debt", "shares": "shares_outstanding",
                   "deferred_revenue": "deferred_revenue"}
STAMP_ORDER = ["revenue", "net_income", "operating_income"]
AUDIT_METRICS = [("revenue", "revenue_lq"), ("ebitda", "ebitda_lq"), ("net_income", "net_income_lq"),
                 ("cash", "cash_sti"), ("debt", "total_debt"), ("shares", "shares_outstanding"),
                 ("deferred_revenue", "deferred_revenue")]
WINDOW_ROWS = 8


def metric_summary(series: DataFrame, n: int = WINDOW_ROWS) -> DataFrame:
    """One row per (cik, metric): lq, annualized, ltm, yoy and the newest row's stamp."""
    return series_summary(latest_rows(series, n))


def facts_summary(facts: DataFrame, mmap: DataFrame, kinds: set | None = None, n: int = WINDOW_ROWS) -> DataFrame:
    """``metric_summary`` straight from the fact frame (tag choice folded into the top-n)."""
    return series_summary(latest_series(facts, mmap, n, kinds))


def _pick(metric: str) -> Column:
    fields = ["lq", "annualized", "ltm", "yoy", "end", "form", "fy", "fp", "tag", "unit", "scale_applied"]
    return F.max(F.when(F.col("metric") == metric, F.struct(*fields))).alias(metric)


def aligned_margin(numer: str, denom: str) -> Column:
    """Margin of the newest rows of two metrics, only when their periods match.

    Periods match on (end, form, fy, fp) with NULL equal to NULL; the
    denominator must be > 0 and the result within ±100 (W9, P15).
    """
    a, b = F.col(numer), F.col(denom)
    same = (a["end"].eqNullSafe(b["end"]) & a["form"].eqNullSafe(b["form"])
            & a["fy"].eqNullSafe(b["fy"]) & a["fp"].eqNullSafe(b["fp"]))
    return F.when(a.isNotNull() & b.isNotNull() & same, safe_ratio_pct(a["lq"], b["lq"]))


def report_stamp() -> Column:
    """(end, fy, fp) of the newest revenue row, else net income, else operating income."""
    cands = [F.when(F.col(m)["end"].isNotNull(),
                    F.struct(F.col(m)["end"].alias("end"), F.col(m)["fy"].alias("fy"),
                             F.col(m)["fp"].alias("fp")))
             for m in STAMP_ORDER]
    return F.coalesce(*cands)


def company_wide(summary: DataFrame) -> DataFrame:
    """Fold the per-metric summary into one row per company (struct per metric)."""
    metrics = FLOW_METRICS + list(BALANCE_METRICS) + ["operating_income"]
    return summary.groupBy("cik").agg(*[_pick(m) for m in metrics])


def fundamentals_frame(companies: DataFrame, summary: DataFrame,
                       filing_dates: DataFrame | None = None,
                       prices: DataFrame | None = None) -> DataFrame:
    """The ``fundamentals`` table: one row per company in ``companies``.

    ``filing_dates`` (cik, filing_date) gives the last-resort stamp;
    ``prices`` (cik, price) is optional (the reference never has a price,
    so ``stock_price`` and ``market_cap`` stay NULL without it).
    """
    wide = company_wide(summary)
    base = companies.select("cik").distinct().join(wide, "cik", "left")
    if filing_dates is not None:
        newest = filing_dates.groupBy("cik").agg(F.max("filing_date").alias("newest_filing"))
        base = base.join(newest, "cik", "left")
    else:
        base = base.withColumn("newest_filing", F.lit(None).cast("string"))
    if prices is not None:
        base = base.join(prices.select("cik", F.col("price").cast("double").alias("stock_price")), "cik", "left")
    else:
        base = base.withColumn("stock_price", F.lit(None).cast("double"))
    stamp = report_stamp()
    cols: dict[str, Column] = {
        "id": F.lit(None).cast("bigint"),
        "cik": F.col("cik"),
        "report_date": F.coalesce(stamp["end"].cast("string"), F.col("newest_filing").cast("string")),
        "fiscal_year": F.when(stamp.isNotNull(), stamp["fy"].cast("int")),
        "fiscal_period": F.when(stamp.isNotNull(), stamp["fp"].cast("string")),
    }
    for m, prefix in (("revenue", "revenue"), ("ebitda", "ebitda"), ("net_income", "net_income")):
        for f in ("lq", "annualized", "ltm", "yoy"):
            cols[f"{prefix}_{f}"] = F.col(m)[f]
        if m != "revenue":
            cols[f"{prefix}_margin"] = aligned_margin(m, "revenue")
    for m, col in BALANCE_METRICS.items():
        cols[col] = F.col(m)["lq"]
    for c in S.UNWRITTEN_COLUMNS:
        cols[c] = F.lit(None).cast("double")
    cols["stock_price"] = F.col("stock_price")
    cols["market_cap"] = F.col("stock_price") * F.col("shares")["lq"]
    out = base.select(*[v.alias(k) for k, v in cols.items()])
    return out.select(*[F.col(f.name).cast(f.dataType) for f in S.FUNDAMENTALS_SCHEMA.fields])


def audit_frame(summary: DataFrame, fundamentals: DataFrame) -> DataFrame:
    """One audit row per company and metric whose newest row exists (K5)."""
    names = F.create_map(*[x for m, name in AUDIT_METRICS for x in (F.lit(m), F.lit(name))])
    s = summary.where(F.col("metric").isin([m for m, _ in AUDIT_METRICS]))
    stamps = fundamentals.select("cik", "report_date", "fiscal_year", "fiscal_period")
    out = s.join(stamps, "cik", "left").select(
        F.lit(None).cast("bigint").alias("id"), "cik", "report_date", "fiscal_year", "fiscal_period",
        names[F.col("metric")].alias("metric"), F.col("lq").alias("value"),
        F.col("tag").alias("source_tag"), "unit", F.col("scale_applied").cast("int").alias("scale_applied"),
        "form", F.col("fy").cast("int").alias("fy"), "fp")
    return out.select(*[F.col(f.name).cast(f.dataType) for f in S.AUDIT_SCHEMA.fields])
