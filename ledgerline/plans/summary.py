"""The SQL summary over the maintained tables, and the Parquet export
(duck-summary entry: table listing, company count, coverage, newest dates,
sample rows, NULL ratios, margin histogram, outliers with links).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerline.operators import analytics as A
from ledgerline.plans.fundamentals import read_current

TABLES = ["companies", "fundamentals", "filings", "fundamentals_audit"]


def register_store(spark: SparkSession, store: str) -> list[str]:
    """Expose the current version of every table as a temp view."""
    names = []
    for t in TABLES:
        df = read_current(spark, store, t)
        if df is not None:
            df.createOrReplaceTempView(t)
            names.append(t)
    return names


def summary(spark: SparkSession, fundamentals: DataFrame, companies: DataFrame,
            filings: DataFrame) -> dict[str, DataFrame]:
    """All summary results as DataFrames, in the reference's order."""
    return {
        "tables": A.table_listing(spark),
        "companies": A.company_count(companies),
        "coverage": A.coverage(fundamentals),
        "latest_dates": A.rows_per_date(fundamentals),
        "sample": A.sample_rows(fundamentals, companies),
        "nulls": A.null_ratios(fundamentals),
        "margin_histogram": A.margin_histogram(fundamentals),
        "outliers": A.margin_outliers(fundamentals, companies, filings),
    }


def export_parquet(fundamentals: DataFrame, out_path: str) -> None:
    """K6: the whole fundamentals table to Parquet."""
    fundamentals.write.mode("errorifexists").parquet(out_path)


def export_universe(universe: DataFrame, out_path: str) -> None:
    """K7: the universe as JSON records (one per line)."""
    universe.write.mode("errorifexists").json(out_path)
