"""Submissions documents: company metadata and the recent-filings arrays
(S6, S7, W11, A9, F11, J7).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline import schemas as S
from ledgerline.functions.scalars import filing_url, pad_cik

_ARR = T.ArrayType(T.StringType())
SUBMISSIONS_SCHEMA = T.StructType([
    T.StructField("cik", T.StringType(), True),
    T.StructField("name", T.StringType(), True),
    T.StructField("entityType", T.StringType(), True),
    T.StructField("addresses", T.StructType([
        T.StructField("business", T.StructType([T.StructField("stateOrCountry", T.StringType(), True)]), True),
    ]), True),
    T.StructField("stateOfIncorporation", T.StringType(), True),
    T.StructField("sic", T.StringType(), True),
    T.StructField("sicDescription", T.StringType(), True),
    T.StructField("fiscalYearEnd", T.StringType(), True),
    T.StructField("filings", T.StructType([T.StructField("recent", T.StructType([
        T.StructField("form", _ARR, True),
        T.StructField("accessionNumber", _ARR, True),
        T.StructField("primaryDocument", _ARR, True),
        T.StructField("filingDate", _ARR, True),
    ]), True)]), True),
])


def read_submissions(spark: SparkSession, paths: str | list[str], multi_line: bool = True) -> DataFrame:
    return spark.read.schema(SUBMISSIONS_SCHEMA).option("multiLine", multi_line).json(paths)


def company_metadata(subs: DataFrame) -> DataFrame:
    """Name (else entity type), state, incorporation, SIC, fiscal year end."""
    return subs.select(
        pad_cik(F.col("cik")).alias("cik"),
        F.coalesce(F.col("name"), F.col("entityType")).alias("name"),
        F.col("addresses.business.stateOrCountry").alias("business_state"),
        F.col("stateOfIncorporation").alias("state_incorp"),
        F.col("sic").alias("sic"), F.col("sicDescription").alias("sic_description"),
        F.col("fiscalYearEnd").alias("fiscal_year_end"))


def recent_filings(subs: DataFrame) -> DataFrame:
    """The index-aligned arrays as rows (cik, pos, form, accession, document, filing_date)."""
    r = F.col("filings.recent")
    z = F.arrays_zip(r["form"].alias("form"), r["accessionNumber"].alias("accession"),
                     r["primaryDocument"].alias("document"), r["filingDate"].alias("filing_date"))
    return (subs.select(pad_cik(F.col("cik")).alias("cik"), F.posexplode(z).alias("pos", "f"))
            .select("cik", F.col("pos").cast("bigint").alias("pos"), "f.form", "f.accession", "f.document",
                    "f.filing_date"))


def latest_filing_links(filings: DataFrame, forms: list[str] | None = None) -> DataFrame:
    """W11 + F11: per company and form, the link of the first (newest) array entry.

    ``pos`` orders entries, smallest first. A partial aggregate (``min_by``),
    so a company with a huge filing list never lands in one task.
    """
    forms = forms or S.FILING_FORMS
    first = (filings.where(F.col("form").isin(forms))
             .groupBy("cik", "form")
             .agg(F.min_by(F.struct("accession", "document"), F.col("pos")).alias("f")))
    return first.select("cik", F.col("form").alias("filing_type"),
                        filing_url(F.col("cik"), F.col("f.accession"), F.col("f.document")).alias("url"))


def newest_filing_date(filings: DataFrame) -> DataFrame:
    """Newest filing date per company (the last-resort report stamp)."""
    return filings.groupBy("cik").agg(F.max("filing_date").alias("filing_date"))


def companies_with_both(facts_ciks: DataFrame, subs_ciks: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Companies that have both documents, and those skipped (for the report)."""
    a = facts_ciks.select("cik").distinct()
    b = subs_ciks.select("cik").distinct()
    return a.join(b, "cik", "inner"), a.join(b, "cik", "left_anti").unionByName(b.join(a, "cik", "left_anti"))


def form_order(form: Column) -> Column:
    """Insert order of filing links (10-Q, 10-K, S-1), used to synthesise ids."""
    return F.array_position(F.array(*[F.lit(f) for f in S.FILING_FORMS]), form)
