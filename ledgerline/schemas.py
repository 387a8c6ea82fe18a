"""Table schemas and the metric map.

The metric map is data, not code: one row per (metric, tier, component tag).
It is broadcast into the series plan (a fixed, small table of a few dozen
rows), which replaces a per-metric resolver function with one join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# XBRL tags, units and their preference order per metric.
# These must equal the reference's lists for identical results.
# ---------------------------------------------------------------------------
REVENUE_TAGS = [
    "RevenueFromContractWithCustomerExcludingAssessedTax",
    "Revenues",
    "SalesRevenueNet",
    "SalesRevenueGoodsNet",
    "SalesRevenueServicesAndOtherNet",
]
EBITDA_DIRECT_TAG = "EarningsBeforeInterestTaxesDepreciationAndAmortization"
NET_INCOME_TAGS = ["NetIncomeLoss", "ProfitLoss"]  # only the first one is used
CASH_DIRECT_TAG = "CashCashEquivalentsAndShortTermInvestments"
OPERATING_INCOME_TAG = "OperatingIncomeLoss"
DA_TAG = "DepreciationAndAmortization"
CASH_COMPONENT_TAGS = ["CashAndCashEquivalentsAtCarryingValue", "ShortTermInvestments"]
DEBT_COMPONENT_TAGS = ["LongTermDebtNoncurrent", "LongTermDebtCurrent", "ShortTermBorrowings"]
SHARES_TAG = "CommonStockSharesOutstanding"
SHARES_DEI_TAG = "EntityCommonStockSharesOutstanding"
DEFERRED_CONTRACT_TAGS = ["ContractWithCustomerLiabilityCurrent", "ContractWithCustomerLiabilityNoncurrent"]
DEFERRED_LEGACY_TAGS = ["DeferredRevenueCurrent", "DeferredRevenueNoncurrent"]
DEFERRED_TOTAL_TAG = "DeferredRevenue"

# Provenance names written for combined series.
EBITDA_COMPOSITE_TAG = "OperatingIncomeLoss+DepreciationAndAmortization"
CASH_COMPOSITE_TAG = "CashAndCashEquivalentsAtCarryingValue(+ShortTermInvestments)"
DEBT_COMPOSITE_TAG = "LongTermDebtNoncurrent+LongTermDebtCurrent+ShortTermBorrowings"
DEFERRED_COMPOSITE_TAG = "DeferredRevenue(Total)"

# Forms used when picking the latest rows.
QUARTERLY_FORM = "10-Q"
ANNUAL_FORM = "10-K"
FILING_FORMS = ["10-Q", "10-K", "S-1"]
FP_ORDER = ["Q1", "Q2", "Q3", "Q4"]

US_GAAP = "us-gaap"
DEI = "dei"

# combine: first = lowest priority present wins; sum = add present components
# per period; join = inner join of two components on the period (EBITDA).
METRIC_MAP_SCHEMA = T.StructType([
    T.StructField("metric", T.StringType(), False),
    T.StructField("tier", T.IntegerType(), False),
    T.StructField("priority", T.IntegerType(), False),
    T.StructField("namespace", T.StringType(), False),
    T.StructField("tag", T.StringType(), False),
    T.StructField("unit", T.StringType(), False),
    T.StructField("combine", T.StringType(), False),
    T.StructField("quarterly", T.BooleanType(), False),
    T.StructField("out_tag", T.StringType(), True),
])


def metric_map_rows() -> list[tuple]:
    rows: list[tuple] = []
    for i, tag in enumerate(REVENUE_TAGS, start=1):
        rows.append(("revenue", 1, i, US_GAAP, tag, "USD", "first", True, None))
    rows.append(("ebitda", 1, 1, US_GAAP, EBITDA_DIRECT_TAG, "USD", "first", True, None))
    rows.append(("ebitda", 2, 1, US_GAAP, OPERATING_INCOME_TAG, "USD", "join", True, EBITDA_COMPOSITE_TAG))
    rows.append(("ebitda", 2, 2, US_GAAP, DA_TAG, "USD", "join", True, EBITDA_COMPOSITE_TAG))
    rows.append(("net_income", 1, 1, US_GAAP, NET_INCOME_TAGS[0], "USD", "first", True, None))
    rows.append(("operating_income", 1, 1, US_GAAP, OPERATING_INCOME_TAG, "USD", "first", False, None))
    rows.append(("cash", 1, 1, US_GAAP, CASH_DIRECT_TAG, "USD", "first", False, None))
    for i, tag in enumerate(CASH_COMPONENT_TAGS, start=1):
        rows.append(("cash", 2, i, US_GAAP, tag, "USD", "sum", False, CASH_COMPOSITE_TAG))
    for i, tag in enumerate(DEBT_COMPONENT_TAGS, start=1):
        rows.append(("debt", 1, i, US_GAAP, tag, "USD", "sum", False, DEBT_COMPOSITE_TAG))
    rows.append(("shares", 1, 1, US_GAAP, SHARES_TAG, "shares", "first", False, None))
    rows.append(("shares", 2, 1, DEI, SHARES_DEI_TAG, "shares", "first", False, None))
    for i, tag in enumerate(DEFERRED_CONTRACT_TAGS, start=1):
        rows.append(("deferred_revenue", 1, i, US_GAAP, tag, "USD", "sum", False, DEFERRED_COMPOSITE_TAG))
    for i, tag in enumerate(DEFERRED_LEGACY_TAGS, start=1):
        rows.append(("deferred_revenue", 2, i, US_GAAP, tag, "USD", "sum", False, DEFERRED_COMPOSITE_TAG))
    rows.append(("deferred_revenue", 3, 1, US_GAAP, DEFERRED_TOTAL_TAG, "USD", "first", False, None))
    return rows


def metric_map(spark: SparkSession, metrics: list[str] | None = None) -> DataFrame:
    """The metric map as a broadcastable frame (optionally only some metrics)."""
    rows = [r for r in metric_map_rows() if metrics is None or r[0] in metrics]
    return spark.createDataFrame(rows, METRIC_MAP_SCHEMA)


def map_kinds(metrics: list[str] | None = None) -> set[tuple[str, bool]]:
    """(combine, quarterly) pairs used by the selected metrics (decided on the driver)."""
    return {(r[6], r[7]) for r in metric_map_rows() if metrics is None or r[0] in metrics}


# ---------------------------------------------------------------------------
# Long fact frame: one row per accepted fact entry, all companies, all tags.
# ``val`` keeps the numeric type of the source (DOUBLE from JSON, DECIMAL
# from exact adapters); operators never change it until the final metrics.
# ---------------------------------------------------------------------------
FACT_COLUMNS = ["cik", "namespace", "tag", "unit", "end", "form", "fy", "fp",
                "qtrs", "val", "scale_applied", "pos"]

# ---------------------------------------------------------------------------
# Output tables (types follow the reference DDL: TEXT, REAL, INTEGER).
# ---------------------------------------------------------------------------
COMPANIES_SCHEMA = T.StructType([
    T.StructField("cik", T.StringType(), False),
    T.StructField("ticker", T.StringType(), True),
    T.StructField("name", T.StringType(), True),
    T.StructField("business_state", T.StringType(), True),
    T.StructField("state_incorp", T.StringType(), True),
    T.StructField("sic", T.StringType(), True),
    T.StructField("sic_description", T.StringType(), True),
    T.StructField("fiscal_year_end", T.StringType(), True),
    T.StructField("last_price", T.DoubleType(), True),
    T.StructField("market_cap", T.DoubleType(), True),
])
COMPANIES_KEY = ["cik"]

FUNDAMENTAL_METRIC_COLUMNS = [
    "revenue_lq", "revenue_annualized", "revenue_ltm", "revenue_yoy",
    "ebitda_lq", "ebitda_annualized", "ebitda_ltm", "ebitda_yoy", "ebitda_margin",
    "net_income_lq", "net_income_annualized", "net_income_ltm", "net_income_yoy", "net_income_margin",
    "gross_profit_lq", "gross_margin", "operating_income_lq", "operating_margin",
    "cfo_lq", "capex_lq", "fcf_lq",
    "cash_sti", "total_debt", "shares_outstanding", "stock_price", "market_cap",
    "deferred_revenue",
]
# Declared by the DDL but never computed by the reference: kept as NULL.
UNWRITTEN_COLUMNS = ["gross_profit_lq", "gross_margin", "operating_income_lq", "operating_margin",
                     "cfo_lq", "capex_lq", "fcf_lq"]
FUNDAMENTALS_SCHEMA = T.StructType(
    [T.StructField("id", T.LongType(), True),
     T.StructField("cik", T.StringType(), False),
     T.StructField("report_date", T.StringType(), True),
     T.StructField("fiscal_year", T.IntegerType(), True),
     T.StructField("fiscal_period", T.StringType(), True)]
    + [T.StructField(c, T.DoubleType(), True) for c in FUNDAMENTAL_METRIC_COLUMNS]
)
FUNDAMENTALS_KEY = ["cik", "report_date"]

FILINGS_SCHEMA = T.StructType([
    T.StructField("id", T.LongType(), True),
    T.StructField("cik", T.StringType(), False),
    T.StructField("filing_type", T.StringType(), False),
    T.StructField("url", T.StringType(), False),
])
FILINGS_KEY = ["cik", "filing_type", "url"]

FACTS_RAW_SCHEMA = T.StructType([
    T.StructField("id", T.LongType(), True),
    T.StructField("cik", T.StringType(), False),
    T.StructField("concept", T.StringType(), False),
    T.StructField("unit", T.StringType(), True),
    T.StructField("end", T.StringType(), True),
    T.StructField("fy", T.IntegerType(), True),
    T.StructField("fp", T.StringType(), True),
    T.StructField("form", T.StringType(), True),
    T.StructField("val", T.DoubleType(), True),
    T.StructField("dims", T.StringType(), True),
])
FACTS_RAW_KEY = ["cik", "concept", "unit", "end", "form", "dims"]

AUDIT_SCHEMA = T.StructType([
    T.StructField("id", T.LongType(), True),
    T.StructField("cik", T.StringType(), False),
    T.StructField("report_date", T.StringType(), True),
    T.StructField("fiscal_year", T.IntegerType(), True),
    T.StructField("fiscal_period", T.StringType(), True),
    T.StructField("metric", T.StringType(), False),
    T.StructField("value", T.DoubleType(), True),
    T.StructField("source_tag", T.StringType(), True),
    T.StructField("unit", T.StringType(), True),
    T.StructField("scale_applied", T.IntegerType(), True),
    T.StructField("form", T.StringType(), True),
    T.StructField("fy", T.IntegerType(), True),
    T.StructField("fp", T.StringType(), True),
])

TABLE_SCHEMAS = {
    "companies": (COMPANIES_SCHEMA, COMPANIES_KEY),
    "fundamentals": (FUNDAMENTALS_SCHEMA, FUNDAMENTALS_KEY),
    "filings": (FILINGS_SCHEMA, FILINGS_KEY),
    "facts_raw": (FACTS_RAW_SCHEMA, FACTS_RAW_KEY),
    "fundamentals_audit": (AUDIT_SCHEMA, None),
}
