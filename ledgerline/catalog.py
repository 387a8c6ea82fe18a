"""Named queries over the driver tables: ``name -> fn(spark, sf_dir) -> DataFrame``.

Each query reads whole tables through the adapters in
``ledgerline.sources.driver`` and runs a library operator on them; the
matching DuckDB text for the oracle check is in ``ledgerline.oracles``.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline import schemas as S
from ledgerline.operators import metrics as M
from ledgerline.operators.series import latest_series, resolve_series, series_summary
from ledgerline.sources import driver as D

QueryFn = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, QueryFn] = {}


def query(fn: QueryFn) -> QueryFn:
    REGISTRY[fn.__name__] = fn
    return fn


def _series(spark: SparkSession, sf_dir: str, metrics: list[str]) -> DataFrame:
    """Full resolved series (every row of the winning tag/tier)."""
    return resolve_series(D.lineitem_facts(spark, sf_dir), S.metric_map(spark, metrics), S.map_kinds(metrics))


def _latest(spark: SparkSession, sf_dir: str, metrics: list[str], n: int = M.WINDOW_ROWS) -> DataFrame:
    """Newest ``n`` rows per (company, metric), tag choice folded into the ranking."""
    return latest_series(D.lineitem_facts(spark, sf_dir), S.metric_map(spark, metrics), n, S.map_kinds(metrics))


def _summary(spark: SparkSession, sf_dir: str, metrics: list[str]) -> DataFrame:
    return series_summary(_latest(spark, sf_dir, metrics))


# --------------------------------------------------------------------------
# Phase 1: year-to-date → quarter → latest rows → LQ / annualized / LTM / YoY
# --------------------------------------------------------------------------
@query
def latest_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: LQ, annualized, LTM, YoY and stamp per supplier and flow metric."""
    summ = _summary(spark, sf_dir, M.FLOW_METRICS)
    return summ.select("cik", "metric", "lq", "annualized", "ltm", "yoy",
                       F.col("end").alias("report_date"), "fy", "fp")


def _flow_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _latest(spark, sf_dir, M.FLOW_METRICS)


@query
def quarterly_from_ytd(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every quarter value of the resolved flow series (revenue, EBITDA, net income)."""
    s = _series(spark, sf_dir, M.FLOW_METRICS)
    return s.select("cik", "metric", F.col("end").alias("period_end"), "form", "fy", "fp",
                    F.col("val").cast("double").alias("quarter_val"))


@query
def latest_quarters_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest 8 rows per company and flow metric, form tiers applied."""
    return _flow_latest(spark, sf_dir).select(
        "cik", "metric", F.col("rn").cast("int").alias("rn"), F.col("end").alias("period_end"),
        "form", "fy", "fp", F.col("val").cast("double").alias("quarter_val"))


@query
def metric_ltm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trailing-twelve-month sum (newest 4 rows, NULL with fewer)."""
    return _summary(spark, sf_dir, M.FLOW_METRICS).select("cik", "metric", "ltm")


@query
def metric_yoy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Growth of the newest row over the 5th newest, signed prior."""
    return _summary(spark, sf_dir, M.FLOW_METRICS).select("cik", "metric", "yoy")


@query
def metric_annualized(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Newest quarter and newest quarter × 4."""
    return _summary(spark, sf_dir, M.FLOW_METRICS).select("cik", "metric", "lq", "annualized")


# --------------------------------------------------------------------------
# Phase 2: tag / unit / scale resolution, combining, margins, stamps, audit
# --------------------------------------------------------------------------
@query
def ebitda_composite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operating income ⋈ D&A on the period (both de-accumulated first)."""
    return _series(spark, sf_dir, ["ebitda"]).select(
        "cik", "tag", F.col("end").alias("period_end"), "form", "fy", "fp",
        F.col("val").cast("double").alias("ebitda_val"))


@query
def margin_aligned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """EBITDA and net-income margins of the newest rows when periods align."""
    wide = M.company_wide(_summary(spark, sf_dir, ["revenue", "ebitda", "net_income"]))
    return wide.select("cik", M.aligned_margin("ebitda", "revenue").alias("ebitda_margin"),
                       M.aligned_margin("net_income", "revenue").alias("net_income_margin"))


@query
def component_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cash and debt as per-period sums of the components present."""
    s = _series(spark, sf_dir, ["cash", "debt"])
    return s.select("cik", "metric", "tag", F.col("end").alias("period_end"), "form", "fy", "fp",
                    F.col("val").cast("double").alias("val"))


@query
def tag_priority(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The revenue tag each company resolves to, and its row count."""
    from ledgerline.operators.series import attach_metric_map, resolve_tags
    mmap = S.metric_map(spark).where(F.col("metric") == "revenue")
    chosen = resolve_tags(attach_metric_map(D.lineitem_facts(spark, sf_dir), mmap))
    return chosen.groupBy("cik", "tag").agg(F.count(F.lit(1)).alias("n_rows"))


@query
def unit_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P5: facts kept per metric, tag and allowed unit (other units drop out)."""
    from ledgerline.operators.series import attach_metric_map
    tagged = attach_metric_map(D.lineitem_facts(spark, sf_dir), S.metric_map(spark))
    return tagged.groupBy("metric", "tag", "unit").agg(F.count(F.lit(1)).alias("n_facts"))


@query
def scale_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw fact entries (text value, text scale) → value × 10^scale."""
    from ledgerline.sources.facts import normalise_entries
    raw = D.lineitem_raw_entries(spark, sf_dir)
    return normalise_entries(raw).select("l_orderkey", "l_linenumber", "val", "scale_applied")


@query
def facts_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Company-facts documents, landed as text and read back, to the long fact frame."""
    from ledgerline.session import scratch_table_path
    from ledgerline.sources import facts as FA
    path = scratch_table_path(spark, f"landed-{uuid.uuid4().hex}")
    D.facts_documents(spark, sf_dir).write.text(path)
    f = FA.entries_frame(FA.variant_entries(FA.read_fact_texts(spark, path)))
    return f.select("cik", "namespace", "tag", "unit", F.col("end").alias("period_end"), "form", "fy", "fp", "qtrs",
                    "val", "scale_applied")


@query
def report_stamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Report date / fiscal year / period per company, with fallbacks."""
    f = _fundamentals(spark, sf_dir)
    return f.select("cik", "report_date", "fiscal_year", "fiscal_period")


@query
def audit_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K5: one provenance row per company and metric with a chosen newest row."""
    from ledgerline.session import cut_lineage
    # the summary feeds both the stamps and the audit rows: computed once
    summ = cut_lineage(_summary(spark, sf_dir, [m for m, _ in M.AUDIT_METRICS] + ["operating_income"]), "summary")
    fund = M.fundamentals_frame(D.supplier_companies(spark, sf_dir), summ, D.supplier_filing_dates(spark, sf_dir))
    return M.audit_frame(summ, fund).drop("id")


def _fundamentals(spark: SparkSession, sf_dir: str) -> DataFrame:
    all_metrics = sorted({r[0] for r in S.metric_map_rows()})
    summ = _summary(spark, sf_dir, all_metrics)
    return M.fundamentals_frame(D.supplier_companies(spark, sf_dir), summ, D.supplier_filing_dates(spark, sf_dir))


@query
def fundamentals_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole fundamentals row per company (all metrics, margins, stamps)."""
    return _fundamentals(spark, sf_dir).drop("id")


# --------------------------------------------------------------------------
# Customers as filers: every tier, guard and fallback; landed documents and files read back
# --------------------------------------------------------------------------
def _filers(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(summary, fundamentals) of the customers, with prices and newest filing dates."""
    from ledgerline.session import cut_lineage
    from ledgerline.sources import filers as FL
    from ledgerline.sources.submissions import newest_filing_date
    # the summary feeds both results: computed once
    summ = cut_lineage(M.facts_summary(FL.filer_facts(spark, sf_dir), S.metric_map(spark), S.map_kinds()), "filer-summary")
    dates = newest_filing_date(D.order_filings(spark, sf_dir))
    return summ, M.fundamentals_frame(D.customer_companies(spark, sf_dir), summ, dates, FL.prices(spark, sf_dir))


@query
def fundamentals_tiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fundamentals of companies that file by different tags and forms, or not at all."""
    return _filers(spark, sf_dir)[1].drop("id")


@query
def audit_tiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which tag each figure of ``fundamentals_tiers`` came from."""
    return M.audit_frame(*_filers(spark, sf_dir)).drop("id")


def _landed_submissions(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerline.session import scratch_table_path
    from ledgerline.sources import filers as FL
    from ledgerline.sources.submissions import read_submissions
    path = scratch_table_path(spark, f"submissions-{uuid.uuid4().hex}")
    FL.submission_documents(spark, sf_dir).write.text(path)
    return read_submissions(spark, path, multi_line=False)


@query
def submissions_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Submissions documents, landed as text and read back: each filing with its company's metadata."""
    from ledgerline.sources import submissions as SB
    subs = _landed_submissions(spark, sf_dir)
    return SB.company_metadata(subs).join(SB.recent_filings(subs), "cik", "left")


@query
def companies_both(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Companies with both documents, and those skipped for want of one."""
    from ledgerline.sources import filers as FL
    from ledgerline.sources import submissions as SB
    subs = SB.company_metadata(_landed_submissions(spark, sf_dir))
    both, skipped = SB.companies_with_both(FL.filer_facts(spark, sf_dir), subs)
    return both.withColumn("loaded", F.lit(True)).unionByName(skipped.withColumn("loaded", F.lit(False)))


def _landed_directory(df: DataFrame, name: str) -> DataFrame:
    """A symbol directory written as pipe-delimited files with headers and a trailer line, and read back."""
    from ledgerline.session import scratch_table_path
    from ledgerline.sources import symbols as Y
    spark = df.sparkSession
    path = scratch_table_path(spark, f"{name}-{uuid.uuid4().hex}")
    cols = [c for c in df.columns if c != "pos"]
    rows = df.select(*[F.col(f"`{c}`").cast("string") for c in cols])
    trailer = spark.range(1).select(F.lit(Y.TRAILER_PREFIX + ": 0101202521:30").alias(cols[0]),
                                    *[F.lit(None).cast("string").alias(c) for c in cols[1:]])
    rows.unionByName(trailer).write.option("sep", "|").option("header", True).csv(path)
    return Y.read_symbol_directory(spark, path)


@query
def directory_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both symbol directories landed as pipe-delimited files and read back into one directory."""
    from ledgerline.sources import symbols as Y
    both = Y.symbol_directory(_landed_directory(D.nasdaq_listed(spark, sf_dir), "nasdaqlisted"),
                              _landed_directory(D.other_listed(spark, sf_dir), "otherlisted"))
    return both.select("ticker", "exchange", "name", "etf", "test")


# --------------------------------------------------------------------------
# Phase 2: symbols, tickers, universe, filings
# --------------------------------------------------------------------------
def _directory(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerline.sources import symbols as Y
    return Y.symbol_directory(D.nasdaq_listed(spark, sf_dir), D.other_listed(spark, sf_dir))


def _ticker_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerline.sources import symbols as Y
    return Y.ticker_map(D.ticker_map_entries(spark, sf_dir))


@query
def symbol_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both directories unioned, cleaned, first row per ticker."""
    return _directory(spark, sf_dir).select("ticker", "exchange", "name", "etf", "test")


@query
def universe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Directories ⟕ ticker map; no tests, no ETFs, three exchanges."""
    from ledgerline.sources import symbols as Y
    return Y.universe(_directory(spark, sf_dir), _ticker_map(spark, sf_dir),
                      include_etfs=False, exchanges=["NASDAQ", "n", "A"])


@query
def ticker_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requested tickers resolved to a CIK (last map entry wins)."""
    from ledgerline.sources import symbols as Y
    req = Y.tickers_from_text(D.requested_ticker_lines(spark, sf_dir))
    found, _ = Y.resolve_tickers(req, _ticker_map(spark, sf_dir))
    return found.select("ticker", "cik", F.col("pos").alias("first_pos"))


@query
def ticker_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J6 (anti): requested tickers without a CIK (warned and skipped)."""
    from ledgerline.sources import symbols as Y
    req = Y.tickers_from_text(D.requested_ticker_lines(spark, sf_dir))
    _, missing = Y.resolve_tickers(req, _ticker_map(spark, sf_dir))
    return missing.select("ticker", F.col("pos").alias("first_pos"))


@query
def raw_facts_last4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K9: the last four entries per company, concept and unit (the raw-facts store)."""
    from ledgerline.sources.facts import last_entries
    f = D.lineitem_facts(spark, sf_dir).where(F.col("namespace") == S.US_GAAP)
    return last_entries(f, 4).select(
        "cik", F.col("tag").alias("concept"), "unit", F.col("end").cast("string").alias("end"), "fy", "fp",
        "form", F.col("val").cast("double").alias("val"), F.lit("null").alias("dims"))


@query
def ticker_map_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The deduplicated ticker → CIK map."""
    return _ticker_map(spark, sf_dir).select("ticker", "cik", "title")


@query
def latest_filing_url(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Newest 10-Q, 10-K and S-1 link per company."""
    from ledgerline.sources.submissions import latest_filing_links
    return latest_filing_links(D.order_filings(spark, sf_dir))


# --------------------------------------------------------------------------
# Phase 3: SQL-summary analytics and table maintenance
# --------------------------------------------------------------------------
@query
def company_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1: companies in the table."""
    from ledgerline.operators import analytics as A
    return A.company_count(D.customer_companies(spark, sf_dir))


@query
def coverage_pct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A2: row count and non-NULL share of six key columns."""
    from ledgerline.operators import analytics as A
    return A.coverage(D.order_fundamentals(spark, sf_dir))


@query
def null_pct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A3: NULL share of seven key columns."""
    from ledgerline.operators import analytics as A
    return A.null_ratios(D.order_fundamentals(spark, sf_dir))


@query
def rows_per_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows on the five newest report dates."""
    from ledgerline.operators import analytics as A
    return A.rows_per_date(D.order_fundamentals(spark, sf_dir))


@query
def sample_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten rows with revenue and net income, with tickers."""
    from ledgerline.operators import analytics as A
    return A.sample_rows(D.order_fundamentals(spark, sf_dir), D.customer_companies(spark, sf_dir))


@query
def margin_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A5: EBITDA-margin buckets."""
    from ledgerline.operators import analytics as A
    return A.margin_histogram(D.order_fundamentals(spark, sf_dir))


@query
def margin_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Top 20 margins beyond ±100 with their latest 10-Q/10-K link."""
    from ledgerline.operators import analytics as A
    return A.margin_outliers(D.order_fundamentals(spark, sf_dir), D.customer_companies(spark, sf_dir),
                             D.customer_filings(spark, sf_dir))


@query
def snapshot_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each company's rows on its newest report date, with ticker."""
    from ledgerline.operators import analytics as A
    return A.latest_snapshot(D.order_fundamentals(spark, sf_dir), D.customer_companies(spark, sf_dir))


def _company_halves(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    c = D.customer_companies(spark, sf_dir)
    target = c.where(F.col("sic_description").isin("AUTOMOBILE", "BUILDING", "FURNITURE"))
    source = (c.where(F.col("sic_description").isin("FURNITURE", "HOUSEHOLD", "MACHINERY"))
              .withColumn("name", F.upper("name")).withColumn("ticker", F.lower("ticker"))
              .withColumn("business_state", F.concat(F.lit("X"), F.col("business_state")))
              .withColumn("sic", F.lit("9999")))
    return target, source


@query
def upsert_company(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1: company upsert on cik (all columns replaced)."""
    from ledgerline.operators.upsert import upsert
    target, source = _company_halves(spark, sf_dir)
    return upsert(target, source, S.COMPANIES_KEY)


@query
def upsert_company_partial(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K2: company upsert replacing five columns only."""
    from ledgerline.operators.upsert import upsert_columns
    target, source = _company_halves(spark, sf_dir)
    src = source.select("cik", "ticker", "name", "business_state", "last_price", "market_cap")
    return upsert_columns(target, src, S.COMPANIES_KEY,
                          ["ticker", "name", "business_state", "last_price", "market_cap"])


@query
def upsert_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K3: fundamentals upsert on (cik, report_date); the overlap year is replaced."""
    from ledgerline.operators.upsert import upsert
    f = D.order_fundamentals(spark, sf_dir)
    target = f.where(F.col("report_date") < "1999-01-01")
    source = (f.where(F.col("report_date") >= "1998-01-01")
              .withColumn("revenue_lq", F.col("revenue_lq") * F.lit(2.0)))
    return upsert(target, source, S.FUNDAMENTALS_KEY)


@query
def insert_ignore(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K4: filings insert-ignore on (cik, filing_type, url)."""
    from ledgerline.operators.upsert import insert_ignore as ins
    links = D.customer_filings(spark, sf_dir)
    target = links.where(F.col("filing_type") == "10-K")
    return ins(target, links, S.FILINGS_KEY, required=["url"]).drop("id")


def _stored(spark: SparkSession, rows: DataFrame, name: str, keys: list[str]) -> tuple[str, str]:
    """A bucketed table of its own for one run of a query: (name, folder)."""
    from ledgerline.operators import bucketed
    from ledgerline.session import scratch_table_path
    name = f"{name}_{uuid.uuid4().hex[:12]}"
    path = scratch_table_path(spark, name)
    bucketed.create(rows, name, keys, path=path)
    return name, path


@query
def bucketed_upsert_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K3 on a catalog table in buckets of (cik, report_date): the stored rows are not shuffled."""
    from ledgerline.operators import bucketed
    f = D.order_fundamentals(spark, sf_dir)
    name, path = _stored(spark, f.where(F.col("report_date") < "1999-01-01"), "fundamentals", S.FUNDAMENTALS_KEY)
    batch = (f.where(F.col("report_date") >= "1998-01-01")
             .withColumn("revenue_lq", F.col("revenue_lq") * F.lit(2.0)))
    return spark.table(bucketed.upsert(spark, name, batch, path=path)).drop(bucketed.PART)


def _raw_last4(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = raw_facts_last4(spark, sf_dir)
    return f.withColumn("fy", F.col("fy").cast("int"))


@query
def raw_facts_insert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K9: raw facts inserted on their unique key; the stored 10-K rows (other values) stay, a batch brought twice adds nothing."""
    from ledgerline.operators import bucketed
    from ledgerline.operators.upsert import new_rows
    from ledgerline.session import cut_lineage
    raw = cut_lineage(_raw_last4(spark, sf_dir), "raw-facts")  # read by the held rows, and by each insert for its parts and its rows
    held = raw.where("form = '10-K'").withColumn("val", F.col("val") + F.lit(1.0))
    name, _ = _stored(spark, new_rows(held.limit(0), held, S.FACTS_RAW_KEY), "facts_raw", S.FACTS_RAW_KEY)
    for _ in range(2):
        bucketed.insert(spark, name, raw)
    return spark.table(name)


@query
def key_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Uniqueness of the stored tables' keys; the raw facts repeat theirs, companies and fundamentals have planted repeats."""
    from ledgerline.operators import upsert as U
    target, source = _company_halves(spark, sf_dir)
    f = D.order_fundamentals(spark, sf_dir)
    planted = f.unionByName(f.where(F.col("fiscal_year") == 1997)).withColumn(
        "report_date", F.when(F.col("fiscal_period") == "Q4", None).otherwise(F.col("report_date")))
    return U.key_report({
        "companies": (target.unionByName(source), S.COMPANIES_KEY), "fundamentals": (planted, S.FUNDAMENTALS_KEY),
        "filings": (D.customer_filings(spark, sf_dir), S.FILINGS_KEY), "facts_raw": (_raw_last4(spark, sf_dir), S.FACTS_RAW_KEY)})


# --------------------------------------------------------------------------
# Phase 4: text cells, feature selection, imputation, scaling, splits
# --------------------------------------------------------------------------
@query
def parse_money(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Money cells ("$9,001.00", "null", "–")."""
    from ledgerline.functions.cells import parse_money as pm
    s = D.part_sheet(spark, sf_dir)
    return s.select(F.col("Ticker").alias("ticker"), pm(F.col("Last Quarter Revenue")).alias("last_quarter_revenue"),
                    pm(F.col("total debt")).alias("total_debt"), pm(F.col("Employee Count")).alias("employee_count"))


@query
def parse_percent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """percent cells to fractions (|v| > 2 read as percent)."""
    from ledgerline.functions.cells import parse_percent as pp
    s = D.part_sheet(spark, sf_dir)
    return s.select(F.col("Ticker").alias("ticker"), pp(F.col("YoY Growth%")).alias("yoy_growth"),
                    pp(F.col("EBITDA Margin")).alias("ebitda_margin"), pp(F.col("total debt")).alias("debt_as_percent"))


@query
def parse_float(spark: SparkSession, sf_dir: str) -> DataFrame:
    """generic cells (commas and ``$`` are not stripped)."""
    from ledgerline.functions.cells import to_float
    s = D.part_sheet(spark, sf_dir)
    return s.select(F.col("Ticker").alias("ticker"), to_float(F.col(" revenue multiple ")).alias("revenue_multiple"),
                    to_float(F.col("Employee Count")).alias("employee_count"),
                    to_float(F.col("Last Quarter Revenue")).alias("revenue_as_float"))


def _sheet_parsed(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, list[str]]:
    from ledgerline.operators import features as X
    df = X.with_target(X.normalise_headers(D.part_sheet(spark, sf_dir)))
    cands = X.candidate_columns(df)
    plan = X.parser_plan(df, cands)
    return X.parse_columns(df, plan, [X.TICKER]), cands


def _long_features(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.select(F.col("Ticker").alias("ticker"), F.explode(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(f"`{c}`").cast("double").alias("value")) for c in cols])).alias("s")
    ).select("ticker", "s.feature", "s.value")


@query
def parse_dispatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every candidate column parsed by its name/`$` rule (long form)."""
    parsed, cands = _sheet_parsed(spark, sf_dir)
    return _long_features(parsed, cands)


@query
def valid_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Share of parsable cells per candidate column, from the one-scan profile."""
    from ledgerline.operators import features as X
    df = X.with_target(X.normalise_headers(D.part_sheet(spark, sf_dir)))
    seen = X.profile(df, X.candidate_columns(df))
    return spark.createDataFrame([(c, p.valid_ratio) for c, p in seen.items()], "feature string, valid_ratio double")


def _kept_columns(spark: SparkSession, sf_dir: str):
    """(parsed columns that are valid often enough, written once; their names; the profile of all candidates)."""
    from ledgerline.operators import features as X
    from ledgerline.session import cut_lineage
    df = X.with_target(X.normalise_headers(D.part_sheet(spark, sf_dir)))
    seen = X.profile(df, X.candidate_columns(df))
    kept = [c for c, p in seen.items() if p.valid_ratio >= X.VALID_RATIO]
    return cut_lineage(X.parse_columns(df, {c: seen[c].kind for c in kept}, [X.TICKER]), "parsed"), kept, seen


@query
def impute_median(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kept columns with NULLs filled by the column median (long form)."""
    from ledgerline.operators import features as X
    parsed, kept, _ = _kept_columns(spark, sf_dir)
    return _long_features(X.impute(parsed, X.fit_medians(parsed, kept), kept), kept)


@query
def constant_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sample std of each imputed column (≤ 1e-12 means constant, dropped)."""
    from ledgerline.operators import features as X
    parsed, kept, seen = _kept_columns(spark, sf_dir)
    fill = X.fit_medians(parsed, kept).first()
    rows = [(c, seen[c].imputed_std(fill[c])) for c in kept]  # a row a column
    stds = spark.createDataFrame(rows, "feature string, std double")
    return stds.withColumn("is_constant", F.coalesce(F.col("std") <= X.CONSTANT_STD, F.lit(True)))


def _snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerline.operators import analytics as A
    return A.latest_snapshot(D.order_fundamentals(spark, sf_dir), D.customer_companies(spark, sf_dir))


@query
def standardize(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leakage-safe numeric columns of the snapshot, median-imputed
    and standardised with population std (std 0 → 1)."""
    from ledgerline.operators import features as X
    from ledgerline.session import cut_lineage
    snap = cut_lineage(_snapshot(spark, sf_dir), "snapshot")  # read by the medians, the scaler and the result
    cols = X.leakage_safe_columns(snap)
    med = X.fit_medians(snap, cols)
    scaler = X.fit_scaler(snap, cols, med)
    return X.standardize(snap.select("cik", "report_date", *cols), cols, med, scaler)


@query
def split_chronological(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Oldest 80 % of report rows → train, newest 20 % → val."""
    from ledgerline.operators import features as X
    h = D.order_fundamentals(spark, sf_dir).select("cik", "report_date")
    return X.chronological_split(h, "report_date", ["cik"], 0.2)


@query
def ps_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    """market cap (price × shares) ÷ LTM revenue, non-finite → NULL."""
    from ledgerline.operators import features as X
    h = D.order_fundamentals(spark, sf_dir).drop("market_cap")
    c = D.customer_companies(spark, sf_dir).select("cik", F.col("last_price"))
    j = h.join(c, "cik", "left").withColumn("market_cap", F.col("last_price") * F.col("shares_outstanding"))
    return j.select("cik", "report_date", X.ps_ratio(j).alias("ps"))


@query
def teacher_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Snapshot ids with teacher predictions joined on the shared key columns."""
    from ledgerline.operators import features as X
    ids = _snapshot(spark, sf_dir).select("cik", "ticker", "report_date")
    urgent = F.when(F.col("o_orderpriority") == "1-URGENT", F.col("o_totalprice"))  # customers without one have no prediction
    teacher = (D.table(spark, sf_dir, "orders").groupBy(F.concat(F.lit("C"), F.col("o_custkey").cast("string")).alias("ticker"))
               .agg((F.max(urgent) / F.lit(1000.0)).alias("pred")))
    return X.join_teacher(ids, teacher)


@query
def split_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M2: seeded hash hold-out flag per row (no DuckDB twin of xxhash64: rows-only)."""
    from ledgerline.operators import features as X
    h = D.order_fundamentals(spark, sf_dir).select("cik", "report_date")
    return X.hash_split(h, ["cik", "report_date"], 0.2, 42)


# --------------------------------------------------------------------------
# Phase 5: evaluation tables and models
# --------------------------------------------------------------------------
_KEYS = ["l_orderkey", "l_linenumber"]
_FEATURES = ["f_price", "f_discount", "f_tax", "f_line", "f_month"]


@query
def regression_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MAE, RMSE, R², median/p90/p95 AE, safe MAPE, n."""
    from ledgerline.operators.evaluation import regression_metrics as rm
    return rm(D.labelled_lines(spark, sf_dir))


@query
def residual_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    """30-bin residual histogram."""
    from ledgerline.operators.evaluation import residual_histogram as rh
    return rh(D.labelled_lines(spark, sf_dir))


@query
def top_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """15 largest absolute errors with their keys."""
    from ledgerline.operators.evaluation import top_errors as te
    return te(D.labelled_lines(spark, sf_dir), _KEYS)


@query
def clip_scale(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Percentile-clipped point sizes of the price column."""
    from ledgerline.operators.evaluation import clip_scale as cs
    return cs(D.labelled_lines(spark, sf_dir).select(*_KEYS, "f_price"), "f_price")


@query
def kd_loss(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distillation loss (α = 0.7) with a partly missing label and teacher."""
    from ledgerline.operators.evaluation import kd_loss as kd
    return kd(D.labelled_lines(spark, sf_dir), "predicted", "y_kd", "teacher")


@query
def ensemble_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-row mean ± population std over five member predictions."""
    from ledgerline.operators.evaluation import ensemble_stats as es
    d = D.labelled_lines(spark, sf_dir)
    return es(d, [f"m{i}" for i in range(5)]).select(*_KEYS, "pred_mean", "pred_std")


@query
def sorted_parity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hold-out rows ranked by actual (ties by key)."""
    from ledgerline.operators.evaluation import sorted_parity as sp
    d = D.labelled_lines(spark, sf_dir).where(F.col("holdout"))
    return sp(d, _KEYS)


def _ml_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerline.operators.features import hash_split
    return hash_split(D.labelled_lines(spark, sf_dir), _KEYS, 0.2, 42)


@query
def gbt_train_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M4/M8: fit boosted trees on the train split, score the hold-out rows."""
    from ledgerline.operators import models as ML
    d = _ml_data(spark, sf_dir)
    fit = ML.train_model(d.where(~F.col("is_test")), _FEATURES, "label", ML.DEFAULTS)
    return ML.predict(fit, d.where(F.col("is_test"))).select(*_KEYS, "label", "prediction")


#: Trials, folds and ensemble members of the recorded run.
TRIALS, FOLDS, MEMBERS = 10, 5, 5


@query
def gbt_tune(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seeded search of the whole space by successive halving; fold mean of every scored setting."""
    from ledgerline.operators import models as ML
    from ledgerline.operators.tuning import tune
    d = _ml_data(spark, sf_dir).where(~F.col("is_test"))
    return tune(d, _FEATURES, _KEYS, "label", ML.sample_space(TRIALS, 42), FOLDS, 42)[1]


@query
def gbt_bagging(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five bootstrap members (Poisson weights), mean ± std on hold-out rows."""
    from ledgerline.operators import models as ML
    d = _ml_data(spark, sf_dir)
    fits = ML.train_ensemble(d.where(~F.col("is_test")), _FEATURES, _KEYS, "label", ML.DEFAULTS, MEMBERS)
    return ML.predict_ensemble(fits, d.where(F.col("is_test"))).select(*_KEYS, "label", "pred_mean", "pred_std")


@query
def feature_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean importance over five members, top 20."""
    from ledgerline.operators import models as ML
    d = _ml_data(spark, sf_dir).where(~F.col("is_test"))
    fits = ML.train_ensemble(d, _FEATURES, _KEYS, "label", ML.DEFAULTS, MEMBERS)
    return ML.feature_importance(spark, fits)


@query
def distil_train(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Student boosted on the mixed loss, the best round chosen on the validation rows;
    hold-out predictions beside the label and the teacher."""
    from ledgerline.operators.distillation import fit_student, predict_student
    d = _ml_data(spark, sf_dir)
    fit = fit_student(d.where(~F.col("is_test")), _FEATURES, "y_kd", "teacher", "holdout")
    return predict_student(fit, d.where(F.col("is_test"))).select(*_KEYS, "y_kd", "teacher", "prediction")


@query
def ticker_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J11/O4/M1 (batch): stored-median feature rows for requested tickers
    (upper/trim match, first sheet row per ticker; no match → NULL features)."""
    from ledgerline.operators import features as X
    sheet = D.part_sheet(spark, sf_dir)
    med, names, plan = X.fit_features(sheet)
    feats = X.apply_features(sheet, med, names, plan, with_label=False)
    li = D.table(spark, sf_dir, "lineitem")
    req = li.select(F.concat(F.lit(" p"), F.col("l_partkey").cast("string")).alias("ticker")).distinct()
    return X.lookup_rows(feats, req)


@query
def metric_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q1 opt-in: calendar LTM / YoY addressed by (fiscal year, quarter), not by row position."""
    from ledgerline.operators.series import calendar_summary
    return calendar_summary(_series(spark, sf_dir, M.FLOW_METRICS)).select("cik", "metric", "lq", "ltm", "yoy")
