"""Adapters that shape the driver's TPC-H-like tables into this engine's inputs.

They only rename and aggregate; every row of the source tables is read.

AF  facts        lineitem per (supplier, ship year, ship quarter) → fact entries
AC  companies    supplier ⋈ nation ⋈ region
AH  history      orders per (customer, order date) → fundamentals-shaped rows
AT  text cells   part / customer numbers written as spreadsheet text
AL  labelled     lineitem with an actual value and a deterministic prediction

Money is summed as DECIMAL so both engines of the oracle check agree exactly;
it is cast to DOUBLE only by the operators' final expressions.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerline import schemas as S
from ledgerline.functions.scalars import pad_cik

MONEY = "decimal(18,2)"
MONEY_SUM = "decimal(28,2)"
VAL = "decimal(30,4)"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def quarter_end(year: Column, quarter: Column) -> Column:
    return F.last_day(F.make_date(year, quarter * 3, F.lit(1)))


def _cents(c: Column) -> Column:
    """Exact integer hundredths of a two-decimal value (sums stay in 64-bit integers)."""
    # rint (Math.rint) instead of round: round() on DOUBLE goes through BigDecimal per row
    return F.rint(c * 100).cast("bigint")


def supplier_quarters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per (supplier, year, quarter) with exact period sums.

    flows (made year-to-date later): revenue, operating income, net income, D&A
    instants (point in time): cash, short-term investments, debt parts, shares
    An instant component exists only in quarters that have qualifying lines,
    so components are naturally sparse. Sums run over integer cents (and
    1e-4 units for products) and become DECIMAL only after aggregation.
    """
    li = table(spark, sf_dir, "lineitem")
    price, qty = _cents(F.col("l_extendedprice")), _cents(F.col("l_quantity"))
    disc, tax = _cents(F.col("l_discount")), _cents(F.col("l_tax"))
    flag, status = F.col("l_returnflag"), F.col("l_linestatus")
    zero = F.lit(0).cast("bigint")
    g = (li.groupBy(F.col("l_suppkey").alias("supp"), F.year("l_shipdate").alias("yr"),
                    F.quarter("l_shipdate").alias("q"))
         .agg(F.sum(price).alias("revenue"),
              F.sum(F.when(flag == "R", -price).otherwise(price)).alias("op_income"),
              F.sum(F.when(flag == "A", price).when(flag == "R", -price).otherwise(zero)).alias("net_income"),
              F.sum(qty).alias("da"),
              F.sum(F.when(status == "F", price * (F.lit(100) - disc))).alias("cash"),
              F.sum(F.when(tax >= 6, price * tax)).alias("sti"),
              F.sum(F.when(disc >= 9, price * disc)).alias("debt_nc"),
              F.sum(F.when(disc <= 1, price * disc)).alias("debt_c"),
              F.sum(F.when(flag == "R", qty)).alias("borrow"),
              F.count(F.lit(1)).alias("shares")))
    cents = lambda c: (F.col(c).cast("decimal(20,0)") / F.lit(100)).cast(VAL)
    bp = lambda c: (F.col(c).cast("decimal(20,0)") / F.lit(10000)).cast(VAL)
    return g.select(
        pad_cik(F.col("supp")).alias("cik"), "yr", "q",
        cents("revenue").alias("revenue"), cents("op_income").alias("op_income"),
        cents("net_income").alias("net_income"), cents("da").alias("da"),
        bp("cash").alias("cash"), bp("sti").alias("sti"), bp("debt_nc").alias("debt_nc"),
        bp("debt_c").alias("debt_c"), cents("borrow").alias("borrow"),
        F.col("shares").cast(VAL).alias("shares"))


def lineitem_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AF: the long fact frame (``schemas.FACT_COLUMNS``) built from lineitem.

    Flows are reported year-to-date (running sum inside the ship year), as
    filings do; the fourth quarter is the annual report (``10-K``, fp ``FY``).
    Revenue is tagged with the ASC 606 tag from 1998 on and with the legacy
    tag before, so the tag resolver must not splice the two.
    """
    sq = supplier_quarters(spark, sf_dir)
    ytd_w = Window.partitionBy("cik", "yr").orderBy("q").rowsBetween(Window.unboundedPreceding, 0)
    sq = sq.withColumns({f + "_ytd": F.sum(f).over(ytd_w) for f in ("revenue", "op_income", "net_income", "da")})
    rev_tag = F.when(F.col("yr") >= 1998, F.lit(S.REVENUE_TAGS[0])).otherwise(F.lit(S.REVENUE_TAGS[2]))

    def entry(ns: str, tag: Column | str, unit: str, val: Column, flow: bool) -> Column:
        return F.struct(F.lit(ns).alias("namespace"),
                        (tag if isinstance(tag, Column) else F.lit(tag)).alias("tag"),
                        F.lit(unit).alias("unit"), val.cast(VAL).alias("val"),
                        (F.col("q") if flow else F.lit(None).cast("int")).alias("qtrs"))

    entries = F.array(
        entry(S.US_GAAP, rev_tag, "USD", F.col("revenue_ytd"), True),
        # annual reports also carry a converted EUR figure, which no metric accepts
        entry(S.US_GAAP, rev_tag, "EUR", F.when(F.col("q") == 4, F.col("revenue_ytd") * F.lit(0.9).cast("decimal(2,1)")), True),
        entry(S.US_GAAP, S.OPERATING_INCOME_TAG, "USD", F.col("op_income_ytd"), True),
        entry(S.US_GAAP, S.NET_INCOME_TAGS[0], "USD", F.col("net_income_ytd"), True),
        entry(S.US_GAAP, S.DA_TAG, "USD", F.col("da_ytd"), True),
        entry(S.US_GAAP, S.CASH_COMPONENT_TAGS[0], "USD", F.col("cash"), False),
        entry(S.US_GAAP, S.CASH_COMPONENT_TAGS[1], "USD", F.col("sti"), False),
        entry(S.US_GAAP, S.DEBT_COMPONENT_TAGS[0], "USD", F.col("debt_nc"), False),
        entry(S.US_GAAP, S.DEBT_COMPONENT_TAGS[1], "USD", F.col("debt_c"), False),
        entry(S.US_GAAP, S.DEBT_COMPONENT_TAGS[2], "USD", F.col("borrow"), False),
        entry(S.DEI, S.SHARES_DEI_TAG, "shares", F.col("shares"), False),
    )
    e = sq.select("cik", "yr", "q", F.explode(entries).alias("e")).where(F.col("e.val").isNotNull())
    return e.select(
        "cik", F.col("e.namespace").alias("namespace"), F.col("e.tag").alias("tag"),
        F.col("e.unit").alias("unit"),
        quarter_end(F.col("yr"), F.col("q")).alias("end"),
        F.when(F.col("q") == 4, F.lit(S.ANNUAL_FORM)).otherwise(F.lit(S.QUARTERLY_FORM)).alias("form"),
        F.col("yr").alias("fy"),
        F.when(F.col("q") == 4, F.lit("FY")).otherwise(F.concat(F.lit("Q"), F.col("q").cast("string"))).alias("fp"),
        F.col("e.qtrs").alias("qtrs"), F.col("e.val").alias("val"),
        F.lit(0).alias("scale_applied"),
        (F.col("yr") * 10 + F.col("q")).cast("bigint").alias("pos"),
    )


def facts_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``lineitem_facts`` as landed company-facts documents (``value``), one JSON text a company.

    Besides the facts they hold what a scan must cope with: first quarters in
    thousands (scale ``"3"``), second quarters with a twin of one segment, third
    quarters with a twin marked dimensional, annual values with a twin that is
    no number, an entry that is no object, units that are a text, the net
    income once more under a namespace of its own, and a line that is no JSON.
    """
    f = lineitem_facts(spark, sf_dir)
    text = lambda **more: F.to_json(F.struct(
        *[c.alias(n) for n, c in {"val": F.col("val").cast("string"), "end": F.col("end").cast("string"), "form": F.col("form"),
                                  "fy": F.col("fy"), "fp": F.col("fp"), "qtrs": F.col("qtrs"), **more}.items()]))
    twin = (F.when(F.col("fp") == "Q2", text(segment=F.struct(F.lit("east").alias("region"))))
            .when(F.col("fp") == "Q3", text(dimensional=F.lit(True)))
            .when(F.col("fp") == "FY", text(val=F.lit("n/a"))).otherwise("17"))
    own = F.when(F.col("fp") == "Q1", text(scale=F.lit("3"))).otherwise(text())
    f = f.unionByName(f.where(F.col("tag") == S.NET_INCOME_TAGS[0]).withColumn("namespace", F.lit("ifrs-full")))
    quoted = lambda c: F.concat(F.lit('"'), F.col(c), F.lit('":'))  # noqa: E731 (names of tags and units need no escapes)
    joined = lambda c: F.array_join(F.array_sort(F.collect_list(c)), ",")
    ordered = F.array_sort(F.collect_list(F.struct("pos", F.concat_ws(",", own, twin).alias("t"))))
    units = f.groupBy("cik", "namespace", "tag", "unit").agg(F.array_join(F.transform(ordered, lambda x: x["t"]), ",").alias("t"))
    tags = units.groupBy("cik", "namespace", "tag").agg(joined(F.concat(quoted("unit"), F.lit("["), "t", F.lit("]"))).alias("t"))
    spaces = tags.groupBy("cik", "namespace").agg(joined(F.concat(quoted("tag"), F.lit('{"label":null,"units":{'), "t", F.lit("}}"))).alias("t"))
    docs = spaces.groupBy("cik").agg(joined(F.concat(quoted("namespace"), F.lit('{"Odd":{"units":"none"},'), "t", F.lit("}"))).alias("t"))
    whole = F.concat(F.lit('{"cik":'), F.col("cik").cast("long").cast("string"), F.lit(',"entityName":"c","facts":{'), "t", F.lit("}}"))
    return docs.select(F.explode(F.array(whole, F.lit("no document"))).alias("value"))


def lineitem_raw_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw fact entries as landed text: value text and scale text per line item.

    The scale text comes from the line number (``3``, ``x``, missing, ``-2``,
    then small integers), so bad and missing scales occur; open lines with
    flag ``N`` carry ``n/a`` as value and must drop out.
    """
    li = table(spark, sf_dir, "lineitem")
    ln = F.col("l_linenumber")
    scale = (F.when(ln == 1, F.lit("3")).when(ln == 2, F.lit("x")).when(ln == 3, F.lit(None).cast("string"))
             .when(ln == 4, F.lit("-2")).otherwise((ln - 5).cast("string")))
    val = F.when((F.col("l_returnflag") == "N") & (F.col("l_linestatus") == "O"), F.lit("n/a")) \
        .otherwise(F.col("l_extendedprice").cast(MONEY).cast("string"))
    return li.select("l_orderkey", "l_linenumber", val.alias("val"), scale.alias("scale"))


def supplier_companies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AC: supplier ⋈ nation ⋈ region in the ``companies`` shape (dimension tables are tiny)."""
    s = table(spark, sf_dir, "supplier")
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    j = s.join(F.broadcast(n), s.s_nationkey == n.n_nationkey).join(F.broadcast(r), n.n_regionkey == r.r_regionkey)
    return j.select(
        pad_cik(F.col("s_suppkey")).alias("cik"),
        F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("ticker"),
        F.col("s_name").alias("name"), F.col("n_name").alias("business_state"),
        F.col("r_name").alias("state_incorp"), F.col("s_nationkey").cast("string").alias("sic"),
        F.col("n_name").alias("sic_description"), F.lit("1231").alias("fiscal_year_end"),
        F.lit(None).cast("double").alias("last_price"), F.lit(None).cast("double").alias("market_cap"))


def supplier_filing_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(cik, filing_date) per supplier: its newest ship date as ISO text.

    Pre-aggregated on the raw key so padding and formatting run once per supplier."""
    li = table(spark, sf_dir, "lineitem")
    newest = li.groupBy("l_suppkey").agg(F.max("l_shipdate").alias("d"))
    return newest.select(pad_cik(F.col("l_suppkey")).alias("cik"),
                         F.col("d").cast("date").cast("string").alias("filing_date"))


# --------------------------------------------------------------------------
# AC: symbol directories, ticker map, requested tickers and filings
# --------------------------------------------------------------------------
def nasdaq_listed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as the NASDAQ-listed directory (negative balance = ETF)."""
    s = table(spark, sf_dir, "supplier")
    return s.select(
        F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("Symbol"),
        F.col("s_name").alias("Security Name"),
        F.when(F.col("s_acctbal") < 0, "Y").otherwise("N").alias("ETF"),
        F.lit("N").alias("Test Issue"),
        F.col("s_suppkey").alias("pos"))


def other_listed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as the other-listed directory, plus wealthy suppliers listed twice.

    Segment decides the exchange code; machinery symbols carry a ``.W``
    suffix (removed by the special-symbol filter); household rows are test issues.
    """
    c = table(spark, sf_dir, "customer")
    seg = F.col("c_mktsegment")
    cust = c.select(
        F.concat(F.lit("C"), F.col("c_custkey").cast("string"),
                 F.when(seg == "MACHINERY", F.lit(".W")).otherwise(F.lit(""))).alias("ACT Symbol"),
        F.col("c_name").alias("Security Name"),
        F.when(seg == "AUTOMOBILE", "A").when(seg == "BUILDING", "N").when(seg == "FURNITURE", "P")
         .otherwise("Z").alias("Exchange"),
        F.when(F.col("c_acctbal") < 0, "Y").otherwise("N").alias("ETF"),
        F.when(seg == "HOUSEHOLD", "Y").otherwise("N").alias("Test Issue"),
        F.col("c_custkey").alias("pos"))
    # suppliers with a smaller balance come under special symbols, which the directory filter drops
    dup = table(spark, sf_dir, "supplier").select(
        F.concat(F.lit("S"), F.col("s_suppkey").cast("string"),
                 F.when(F.col("s_acctbal") > 9000, F.lit("")).otherwise(F.lit(".W"))).alias("ACT Symbol"),
        F.col("s_name").alias("Security Name"), F.lit("N").alias("Exchange"),
        F.lit("N").alias("ETF"), F.lit("N").alias("Test Issue"),
        (F.col("s_suppkey") + F.lit(1 << 32)).alias("pos"))
    return cust.unionByName(dup)


def ticker_map_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ticker-map entries in file order: customers (those with a negative balance
    have a blank CIK, which the map drops), then suppliers, then nations under a two-letter ticker (which collide, so
    the later entry must win)."""
    c = table(spark, sf_dir, "customer")
    s = table(spark, sf_dir, "supplier")
    n = table(spark, sf_dir, "nation")
    return (c.select(F.concat(F.lit("c"), F.col("c_custkey").cast("string")).alias("ticker"),
                     F.when(F.col("c_acctbal") >= 0, F.col("c_custkey").cast("string")).otherwise(F.lit(" ")).alias("cik_str"), F.col("c_name").alias("title"),
                     F.col("c_custkey").cast("bigint").alias("pos"))
            .unionByName(s.select(F.concat(F.lit(" S"), F.col("s_suppkey").cast("string")).alias("ticker"),
                                  (F.col("s_suppkey") + 100000000).cast("string").alias("cik_str"),
                                  F.col("s_name").alias("title"),
                                  (F.col("s_suppkey") + F.lit(1 << 32)).alias("pos")))
            .unionByName(n.select(F.substring("n_name", 1, 2).alias("ticker"),
                                  (F.col("n_nationkey") + 900000000).cast("string").alias("cik_str"),
                                  F.col("n_name").alias("title"),
                                  (F.col("n_nationkey") + F.lit(1 << 33)).cast("bigint").alias("pos"))))


def requested_ticker_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as a tickers file: one line per order in key order; pending orders are
    comment lines, open orders are lower-case with padding."""
    o = table(spark, sf_dir, "orders")
    st = F.col("o_orderstatus")
    cust = F.col("o_custkey").cast("string")
    line = (F.when(st == "F", F.concat(F.lit("C"), cust))
            .when(st == "O", F.concat(F.lit("  c"), cust, F.lit(" ")))
            .otherwise(F.concat(F.lit("# C"), cust)))
    return o.select(line.alias("value"), F.col("o_orderkey").alias("pos"))


def order_filings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as each customer's recent-filings list (newest first): priority → form."""
    o = table(spark, sf_dir, "orders")
    pr = F.col("o_orderpriority")
    form = (F.when(pr == "1-URGENT", "10-K").when(pr == "2-HIGH", "10-Q").when(pr == "3-MEDIUM", "S-1")
            .otherwise("8-K"))
    d = F.col("o_orderdate").cast("date")
    accession = F.concat(F.lpad(F.col("o_custkey").cast("string"), 10, "0"), F.lit("-"),
                         F.date_format(d, "yy"), F.lit("-"), F.lpad(F.col("o_orderkey").cast("string"), 6, "0"))
    # smaller pos = newer entry, as in the submissions arrays
    pos = -(F.unix_date(d).cast("bigint") * F.lit(100000000) + F.col("o_orderkey"))
    return o.select(pad_cik(F.col("o_custkey")).alias("cik"), pos.alias("pos"), form.alias("form"),
                    accession.alias("accession"),
                    F.concat(F.lit("d"), F.col("o_orderkey").cast("string"), F.lit(".htm")).alias("document"),
                    d.cast("string").alias("filing_date"))


# --------------------------------------------------------------------------
# AH: fundamentals-shaped history from orders
# --------------------------------------------------------------------------
def customer_companies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers in the ``companies`` shape."""
    c = table(spark, sf_dir, "customer")
    return c.select(
        pad_cik(F.col("c_custkey")).alias("cik"),
        F.concat(F.lit("C"), F.col("c_custkey").cast("string")).alias("ticker"),
        F.col("c_name").alias("name"), F.col("c_nationkey").cast("string").alias("business_state"),
        F.col("c_mktsegment").alias("state_incorp"), F.col("c_nationkey").cast("string").alias("sic"),
        F.col("c_mktsegment").alias("sic_description"), F.lit("1231").alias("fiscal_year_end"),
        F.col("c_acctbal").cast("double").alias("last_price"),
        F.lit(None).cast("double").alias("market_cap"))


def order_fundamentals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AH: one fundamentals row per (customer, order date).

    Metrics are sums over that day's orders by status or priority, so a
    metric is NULL when no order qualifies. Margins are unguarded signed
    order values in units of 2,000 (``(F − O) / 2000``, ``(O − P) / 2000``) so
    that all nine histogram buckets and the outlier query see data. Sums run
    over integer cents.
    """
    o = table(spark, sf_dir, "orders")
    price = _cents(F.col("o_totalprice"))
    st, pr = F.col("o_orderstatus"), F.col("o_orderpriority")
    g = (o.groupBy(F.col("o_custkey").alias("cust"), F.col("o_orderdate").cast("date").alias("d"))
         .agg(F.sum(price).alias("total"),
              F.sum(F.when(st == "F", price)).alias("f_sum"),
              F.sum(F.when(st == "O", price)).alias("o_sum"),
              F.sum(F.when(st == "F", price).when(st == "O", -price)).alias("fo"),
              F.sum(F.when(st == "O", price).when(st == "P", -price)).alias("op"),
              F.sum(F.when(pr.isin("1-URGENT", "2-HIGH"), price)).alias("cash"),
              F.sum(F.when(pr == "5-LOW", price)).alias("debt"),
              F.sum(F.when(pr == "4-NOT SPECIFIED", F.lit(100000))).alias("shares")))
    # cents → exact DECIMAL → DOUBLE (the same value an exact decimal sum gives)
    dbl = lambda c: (F.col(c).cast("decimal(20,0)") / F.lit(100)).cast(MONEY_SUM).cast("double")
    return g.select(
        pad_cik(F.col("cust")).alias("cik"), F.col("d").cast("string").alias("report_date"),
        F.year("d").alias("fiscal_year"),
        F.concat(F.lit("Q"), F.quarter("d").cast("string")).alias("fiscal_period"),
        dbl("total").alias("revenue_lq"), dbl("f_sum").alias("ebitda_lq"), dbl("o_sum").alias("net_income_lq"),
        dbl("cash").alias("cash_sti"), dbl("debt").alias("total_debt"), dbl("shares").alias("shares_outstanding"),
        (dbl("fo") / F.lit(2000.0)).alias("ebitda_margin"),
        (dbl("op") / F.lit(2000.0)).alias("net_income_margin"),
        F.lit(None).cast("double").alias("market_cap"),
        (dbl("total") * F.lit(4.0)).alias("revenue_ltm"))


def customer_filings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ``filings`` table for customers: newest link per form, with ids in
    insert order (company, then 10-Q, 10-K, S-1)."""
    from ledgerline.sources.submissions import form_order, latest_filing_links
    links = latest_filing_links(order_filings(spark, sf_dir))
    return links.select(
        (F.col("cik").cast("bigint") * 10 + form_order(F.col("filing_type"))).alias("id"),
        "cik", "filing_type", "url")


# --------------------------------------------------------------------------
# AT: spreadsheet text cells from part
# --------------------------------------------------------------------------
def part_sheet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as a spreadsheet export: every cell is text (money with ``$`` and
    thousands commas, percents with ``%``, missing tokens by part type),
    including identifier, excluded, leaky, sparse and constant columns."""
    p = table(spark, sf_dir, "part")
    size, ty, price = F.col("p_size"), F.col("p_type"), F.col("p_retailprice")
    s = lambda c: c.cast("string")
    return p.select(
        F.concat(F.lit("P"), s(F.col("p_partkey"))).alias("Ticker"),
        F.col("p_name").alias("Company"),
        F.when(size > 47, F.lit("N/A")).otherwise(F.concat(s(size), F.lit(".5"))).alias(" revenue multiple "),
        F.concat(F.lit("$"), F.format_number(price * 10, 2)).alias("Last Quarter Revenue"),
        F.concat(s(size), F.lit("%")).alias("YoY Growth%"),
        F.when(ty == "PROMO", F.lit("-")).otherwise(F.concat(s(size - 25), F.lit("%"))).alias("EBITDA Margin"),
        F.when(ty == "ECONOMY", F.lit("–")).otherwise(s(size * 10)).alias("Employee Count"),
        F.when(ty == "SMALL", F.lit("null")).otherwise(F.concat(F.lit("$"), F.format_number(price * 2, 2)))
         .alias("total debt"),
        s(size + 1980).alias("IPO Year"),
        F.regexp_extract(F.col("p_brand"), r"#(\d+)", 1).alias("Brand Rank"),
        ty.alias("Headquarters"),
        F.concat(F.lit("$"), F.format_number(price * 1000, 2)).alias("Market Cap"),
        s(size).alias("EV/Revenue Ratio"),
        F.lit("1").alias("Listed"),
        F.when(size < 10, s(size)).otherwise(F.lit("N/A")).alias("Sparse Metric"),
    )


# --------------------------------------------------------------------------
# AL: labelled predictions from lineitem
# --------------------------------------------------------------------------
MEMBER_RATES = [0.0004, 0.00045, 0.0005, 0.00055, 0.0006]


def labelled_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with an actual value (quantity), a deterministic linear
    prediction (price × 0.0005), five member predictions, a teacher
    prediction (finished lines only), a supervised label that is missing for
    returned lines, a chronological hold-out flag and model features.
    Each value is one DOUBLE product, identical in any IEEE engine."""
    li = table(spark, sf_dir, "lineitem")
    price = F.col("l_extendedprice")
    return li.select(
        "l_orderkey", "l_linenumber",
        F.col("l_quantity").alias("actual"),
        (price * F.lit(0.0005)).alias("predicted"),
        *[(price * F.lit(r)).alias(f"m{i}") for i, r in enumerate(MEMBER_RATES)],
        F.when(F.col("l_linestatus") == "F", price * F.lit(0.0004)).alias("teacher"),
        F.when(F.col("l_returnflag") != "R", F.col("l_quantity")).alias("y_kd"),
        (F.col("l_shipdate") >= F.lit("2001-01-01").cast("timestamp_ntz")).alias("holdout"),
        F.col("l_extendedprice").alias("f_price"), F.col("l_discount").alias("f_discount"),
        F.col("l_tax").alias("f_tax"), F.col("l_linenumber").cast("double").alias("f_line"),
        F.month("l_shipdate").cast("double").alias("f_month"),
        F.col("l_quantity").alias("label"))
