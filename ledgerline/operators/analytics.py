"""Data-quality and distribution queries over the maintained tables
(A1–A5, A10, J3, J8, J9, P7, P8, T3–T5, T8).

Each is a plain DataFrame aggregation; ratios are rounded with exact
integer arithmetic so every engine agrees on the last digit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline import schemas as S

COVERAGE_COLUMNS = {"pct_rev_lq": "revenue_lq", "pct_ebitda_lq": "ebitda_lq", "pct_ni_lq": "net_income_lq",
                    "pct_cash_sti": "cash_sti", "pct_debt": "total_debt", "pct_shares": "shares_outstanding"}
NULL_COLUMNS = {"pct_null_report_date": "report_date", "pct_null_revenue_lq": "revenue_lq",
                "pct_null_ebitda_lq": "ebitda_lq", "pct_null_net_income_lq": "net_income_lq",
                "pct_null_cash_sti": "cash_sti", "pct_null_total_debt": "total_debt",
                "pct_null_shares": "shares_outstanding"}

# Margin histogram buckets (upper bound, label); last bucket closed at 100.
MARGIN_BUCKETS = [(-100, "<-100"), (-50, "[-100,-50)"), (0, "[-50,0)"), (20, "[0,20)"), (40, "[20,40)"),
                  (60, "[40,60)"), (80, "[60,80)")]
TOP_BUCKET, OVER_BUCKET = "[80,100]", ">100"


def pct1(part: Column, total: Column) -> Column:
    """``round(100 * part / total, 1)`` with half-up rounding on the exact ratio; NULL when total is 0."""
    p, t = part.cast("bigint"), total.cast("bigint")
    # floor((2000p + t) / 2t) is 1000p/t rounded half up; the double quotient of
    # two integers below 2^40 is correctly rounded, so the floor is exact.
    q = F.floor((F.lit(2000) * p + t) / (F.lit(2) * t))
    return F.when(t > 0, q.cast("double") / F.lit(10.0))


def company_count(companies: DataFrame) -> DataFrame:
    """A1."""
    return companies.agg(F.count(F.lit(1)).alias("companies"))


def coverage(fundamentals: DataFrame, columns: dict[str, str] | None = None) -> DataFrame:
    """A2: row count and share of non-NULL values per key column (one pass)."""
    columns = columns or COVERAGE_COLUMNS
    n = F.count(F.lit(1))
    return fundamentals.agg(n.alias("n"), *[pct1(F.count(F.col(c)), n).alias(a) for a, c in columns.items()])


def null_ratios(fundamentals: DataFrame, columns: dict[str, str] | None = None) -> DataFrame:
    """A3: share of NULL values per key column (one pass)."""
    columns = columns or NULL_COLUMNS
    n = F.count(F.lit(1))
    return fundamentals.agg(*[pct1(F.count_if(F.col(c).isNull()), n).alias(a) for a, c in columns.items()])


def rows_per_date(fundamentals: DataFrame, k: int = 5) -> DataFrame:
    """Rows per report date, newest ``k`` dates (a top-k report)."""
    return (fundamentals.where(F.col("report_date").isNotNull())
            .groupBy("report_date").agg(F.count(F.lit(1)).alias("rows"))
            .orderBy(F.col("report_date").desc()).limit(k))


def sample_rows(fundamentals: DataFrame, companies: DataFrame, k: int = 10) -> DataFrame:
    """``k`` rows with revenue and net income present, joined to tickers.

    The reference takes any 10 rows; here they are the first by (ticker, date)
    so the result is reproducible.
    """
    f = fundamentals.where(F.col("revenue_lq").isNotNull() & F.col("net_income_lq").isNotNull())
    j = f.join(companies.select("cik", "ticker"), "cik")
    return (j.select("ticker", "report_date", "revenue_lq", "net_income_lq")
            .orderBy("ticker", "report_date").limit(k))


def margin_bucket(m: Column) -> Column:
    e = F.when(m < MARGIN_BUCKETS[0][0], F.lit(MARGIN_BUCKETS[0][1]))
    for hi, label in MARGIN_BUCKETS[1:]:
        e = e.when(m < hi, F.lit(label))
    return e.when(m <= 100, F.lit(TOP_BUCKET)).otherwise(F.lit(OVER_BUCKET))


def margin_histogram(fundamentals: DataFrame, column: str = "ebitda_margin") -> DataFrame:
    """A5: counts per margin bucket, ordered by label text."""
    m = F.col(column)
    return (fundamentals.where(m.isNotNull()).groupBy(margin_bucket(m).alias("bucket"))
            .agg(F.count(F.lit(1)).alias("n")).orderBy("bucket"))


def latest_link_per_company(filings: DataFrame, forms: list[str] | None = None) -> DataFrame:
    """The link with the highest id among the company's 10-Q/10-K filings.

    The reference runs a correlated ``ORDER BY id DESC LIMIT 1`` subquery per
    row; here it is one partial aggregate (``max_by``) joined back.
    """
    forms = forms or [S.QUARTERLY_FORM, S.ANNUAL_FORM]
    return (filings.where(F.col("filing_type").isin(forms))
            .groupBy("cik").agg(F.max_by("url", "id").alias("filing_url")))


def margin_outliers(fundamentals: DataFrame, companies: DataFrame, filings: DataFrame,
                    limit: float = 100.0, k: int = 20) -> DataFrame:
    """Margins beyond ±limit with the latest filing link, largest first (top-k)."""
    a, b = F.col("ebitda_margin"), F.col("net_income_margin")
    f = fundamentals.where((F.abs(a) > limit) | (F.abs(b) > limit))
    j = (f.join(companies.select("cik", "ticker"), "cik")
         .join(latest_link_per_company(filings), "cik", "left"))
    score = F.abs(F.coalesce(a, F.lit(0.0))) + F.abs(F.coalesce(b, F.lit(0.0)))
    return (j.select("ticker", "report_date", "ebitda_margin", "net_income_margin", "filing_url",
                     score.alias("score"))
            .orderBy(F.col("score").desc(), F.col("ticker"), F.col("report_date")).limit(k).drop("score"))


def latest_snapshot(fundamentals: DataFrame, companies: DataFrame) -> DataFrame:
    """Every row on its company's newest report date (ties kept), with ticker.

    Newest date per company is a partial aggregate; the join back is an
    equi-join AQE can broadcast or split when a company is hot.
    """
    newest = fundamentals.groupBy("cik").agg(F.max("report_date").alias("report_date"))
    latest = fundamentals.join(newest, ["cik", "report_date"], "inner")
    return (latest.join(companies.select("cik", "ticker"), "cik")
            .where(F.col("report_date").isNotNull()))


def table_listing(spark: SparkSession, database: str | None = None) -> DataFrame:
    """Tables of the catalog, ordered by name."""
    rows = [(t.database, t.name) for t in spark.catalog.listTables(database)]
    return spark.createDataFrame(rows, "table_schema string, table_name string").orderBy("table_name")
