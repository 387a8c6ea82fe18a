"""Adapter: the driver's customers as filing companies that reach every tier, guard and fallback.

``sources.driver.lineitem_facts`` gives every supplier the same tags. Here what
a customer files depends on its nation, segment and balance, so that each rule
of the fundamentals has rows on both sides:

revenue           by nation: each of the five tags alone, two at once, none
EBITDA            direct tag beside its components; components only; one component
net income        missing for some without revenue: the operating income stamps the row
cash              direct tag, components, both, none
shares            us-gaap, dei, both (with different counts)
deferred revenue  contract, legacy, total, all three, none; contract rows without a fiscal period
forms             10-Q and 10-K; annual reports only; another form only
no facts          customers with a negative balance: the newest filing date stamps the row
margins           numerators up to three times the revenue, revenue of either sign
price             customers above a balance of 1,000

All rows of ``customer`` and ``orders`` are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerline import schemas as S
from ledgerline.functions.scalars import pad_cik
from ledgerline.sources.driver import VAL, _cents, order_filings, quarter_end, table

FOREIGN_FORM = "20-F"
FLOWS = ["revenue", "op_income", "net_income", "da", "ebitda"]


def order_quarters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per (customer, year, quarter): flows year-to-date in cents, the other figures as counts."""
    o = table(spark, sf_dir, "orders")
    price, st, pr = _cents(F.col("o_totalprice")), F.col("o_orderstatus"), F.col("o_orderpriority")
    g = (o.groupBy(F.col("o_custkey").alias("c_custkey"), F.year("o_orderdate").alias("yr"), F.quarter("o_orderdate").alias("q"))
         .agg(F.sum(F.when(pr == "5-LOW", -price).otherwise(price)).alias("revenue"),
              F.sum(F.when(st == "F", price * 2).when(st == "O", -price).otherwise(price)).alias("op_income"),
              F.sum(F.when(st == "F", price).when(st == "O", -price).otherwise(price * 3)).alias("net_income"),
              F.sum(F.when(pr == "1-URGENT", price)).alias("cash"),
              F.sum(F.when(pr != "1-URGENT", price)).alias("sti"),
              F.sum(price).alias("ebitda"),
              F.count(F.lit(1)).alias("n")))
    g = g.withColumn("da", F.col("n") * 10000)
    w = Window.partitionBy("c_custkey", "yr").orderBy("q").rowsBetween(Window.unboundedPreceding, 0)
    return g.withColumns({f: F.sum(f).over(w) for f in FLOWS})


def filer_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The long fact frame (``schemas.FACT_COLUMNS``) of the customers."""
    c = table(spark, sf_dir, "customer").where(F.col("c_acctbal") >= 0).select("c_custkey", "c_nationkey", "c_mktsegment")
    x = order_quarters(spark, sf_dir).join(c, "c_custkey")
    nation, segment, q = F.col("c_nationkey"), F.col("c_mktsegment"), F.col("q")
    annual_only, foreign = segment == "HOUSEHOLD", segment == "MACHINERY"
    x = x.where(~annual_only | (q == 4))
    period = F.when(q == 4, "FY").otherwise(F.concat(F.lit("Q"), q.cast("string")))
    revenue_kind, deferred_kind, third, fourth = nation % 8, nation % 5, nation % 3, nation % 4

    def entry(tag: str, cents: Column, when: Column, flow: bool = False, fp: Column = period, ns: str = S.US_GAAP,
              unit: str = "USD") -> Column:
        return F.struct(F.lit(ns).alias("namespace"), F.lit(tag).alias("tag"), F.lit(unit).alias("unit"),
                        F.when(when, cents).alias("cents"), (q if flow else F.lit(None).cast("int")).alias("qtrs"), fp.alias("fp"))

    revenue, n, always = F.col("revenue"), F.col("n"), F.lit(True)
    no_period = F.when(nation != 13, period)
    contract, legacy = deferred_kind.isin(0, 3), deferred_kind.isin(1, 3)
    entries = F.array(
        *[entry(tag, revenue, (revenue_kind == i) | ((revenue_kind == 5) & ((i == 2) | ((i == 1) & (F.col("yr") < 1997)))), True)
          for i, tag in enumerate(S.REVENUE_TAGS)],
        entry(S.EBITDA_DIRECT_TAG, F.col("ebitda"), third == 0, True),
        entry(S.OPERATING_INCOME_TAG, F.col("op_income"), always, True),
        entry(S.DA_TAG, F.col("da"), third != 2, True),
        entry(S.NET_INCOME_TAGS[0], F.col("net_income"), revenue_kind != 7, True),
        entry(S.CASH_DIRECT_TAG, F.col("ebitda"), fourth.isin(0, 2)),
        entry(S.CASH_COMPONENT_TAGS[0], F.col("cash"), fourth.isin(1, 2)),
        entry(S.CASH_COMPONENT_TAGS[1], F.col("sti"), fourth.isin(1, 2)),
        entry(S.DEBT_COMPONENT_TAGS[0], F.col("sti"), nation % 2 == 0),
        entry(S.DEBT_COMPONENT_TAGS[1], F.col("cash"), nation % 2 == 1),
        entry(S.DEBT_COMPONENT_TAGS[2], n * 700, nation % 2 == 1),
        entry(S.SHARES_TAG, n * 100000, third.isin(0, 2), unit="shares"),
        entry(S.SHARES_DEI_TAG, n * 300000, third.isin(1, 2), ns=S.DEI, unit="shares"),
        entry(S.DEFERRED_CONTRACT_TAGS[0], n * 1100, contract & (q % 2 == 1), fp=no_period),
        entry(S.DEFERRED_CONTRACT_TAGS[1], n * 1300, contract, fp=no_period),
        entry(S.DEFERRED_LEGACY_TAGS[0], n * 1700, legacy),
        entry(S.DEFERRED_LEGACY_TAGS[1], n * 1900, legacy & (q > 2)),
        entry(S.DEFERRED_TOTAL_TAG, n * 2300, deferred_kind.isin(2, 3)),
    )
    form = F.when(foreign, FOREIGN_FORM).when(q == 4, S.ANNUAL_FORM).otherwise(S.QUARTERLY_FORM)
    e = x.select(pad_cik(F.col("c_custkey")).alias("cik"), "yr", "q", form.alias("form"), F.explode(entries).alias("e"))
    # cents become money on the rows that are left: a division of decimals costs more than the rest of an entry
    money = (F.col("e.cents").cast("decimal(20,0)") / F.lit(100)).cast(VAL).alias("val")
    return e.where(F.col("e.cents").isNotNull()).select(
        "cik", "e.namespace", "e.tag", "e.unit", quarter_end(F.col("yr"), F.col("q")).alias("end"), "form",
        F.col("yr").alias("fy"), "e.fp", "e.qtrs", money, F.lit(0).alias("scale_applied"),
        (F.col("yr") * 10 + F.col("q")).cast("bigint").alias("pos"))


def prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(cik, price) of the customers above a balance of 1,000."""
    c = table(spark, sf_dir, "customer").where(F.col("c_acctbal") > 1000)
    return c.select(pad_cik(F.col("c_custkey")).alias("cik"), F.col("c_acctbal").alias("price"))


def submission_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each customer as its submissions document (``value``, one JSON text a company).

    Filings are index-aligned arrays, newest first. Customers with a negative
    balance have no name (their entity type stands in), those of the first
    nation no address, and customers without orders empty arrays.
    """
    c = table(spark, sf_dir, "customer")
    f = order_filings(spark, sf_dir).groupBy("cik").agg(
        F.array_sort(F.collect_list(F.struct("pos", "form", "accession", "document", "filing_date"))).alias("f"))
    c = c.withColumn("cik", pad_cik(F.col("c_custkey"))).join(f, "cik", "left")
    none = F.array().cast("array<string>")
    arr = lambda field: F.coalesce(F.col("f")[field], none)
    nation = F.col("c_nationkey").cast("string")
    return c.select(F.to_json(F.struct(
        F.col("c_custkey").alias("cik"),
        F.when(F.col("c_acctbal") >= 0, F.col("c_name")).alias("name"), F.lit("operating").alias("entityType"),
        F.when(F.col("c_nationkey") > 0, F.struct(F.struct(nation.alias("stateOrCountry")).alias("business"))).alias("addresses"),
        F.col("c_mktsegment").alias("stateOfIncorporation"), nation.alias("sic"), F.lit("1231").alias("fiscalYearEnd"),
        F.struct(F.struct(arr("form").alias("form"), arr("accession").alias("accessionNumber"),
                          arr("document").alias("primaryDocument"), arr("filing_date").alias("filingDate")).alias("recent")).alias("filings"),
    )).alias("value"))
