"""All-company fundamentals load (M14): landed documents → four tables.

One lineage keyed by company replaces the reference's per-company loop:

    ticker map ⋈ requested tickers          (J6)
    facts docs ∩ submissions docs           (J7)
    facts → series → summary → fundamentals (S4/S5 … W10)
    summary → audit rows                    (K5)
    submissions → metadata, filing links    (S6, S7, W11)

``build_tables`` is pure; ``apply_to_store`` merges the result into the store
(upsert / insert-ignore / append). Data go to folders with unique names; one
small manifest, written last, names the folders that make up every table, so
the four tables change together and a failed run leaves only folders that
nobody reads. Keyed tables lie in hash buckets of the company and only touched
buckets are rewritten; filings and audit rows are appended. The manifest also
keeps the last batch of every stream, so a replayed batch changes nothing.
"""

from __future__ import annotations

import json
import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline import schemas as S
from ledgerline.operators import metrics as M
from ledgerline.operators import upsert as U
from ledgerline.session import cut_lineage
from ledgerline.sources import facts as FA
from ledgerline.sources import submissions as SU
from ledgerline.sources import symbols as SY

ID_BATCH_STRIDE = 10 ** 12


def build_tables(spark: SparkSession, facts_docs: DataFrame, submissions: DataFrame, tmap: DataFrame,
                 requested: DataFrame | None = None, prices: DataFrame | None = None,
                 batch_id: int = 0) -> dict[str, DataFrame]:
    """New rows for ``companies``, ``fundamentals``, ``fundamentals_audit``, ``filings``.

    ``tmap`` is the output of ``symbols.ticker_map``; ``requested`` (ticker,
    pos) restricts the run (``None`` = every mapped ticker, as ``ALL``).
    ``prices`` (cik, price) is optional.
    """
    if requested is None:
        wanted = tmap.select("ticker", "cik", "pos")
    else:
        wanted, _ = SY.resolve_tickers(requested, tmap)
    # Several tickers on one CIK: the last processed one names the company (Q12).
    tick = wanted.groupBy("cik").agg(F.max_by("ticker", "pos").alias("ticker"))

    subs = submissions
    have_both, _ = SU.companies_with_both(FA.document_ciks(facts_docs), SU.company_metadata(subs).select("cik"))
    ciks = tick.join(have_both, "cik", "left_semi")

    facts = FA.facts_frame(facts_docs).join(ciks.select("cik"), "cik", "left_semi")
    # one row per (company, metric); it feeds the fundamentals row and the audit rows
    summary = cut_lineage(M.facts_summary(facts, S.metric_map(spark)), "summary")
    filings_long = SU.recent_filings(subs).join(ciks.select("cik"), "cik", "left_semi")
    filing_dates = filings_long.select("cik", "filing_date")

    fundamentals = M.fundamentals_frame(ciks, summary, filing_dates, prices)
    audit = M.audit_frame(summary, fundamentals).withColumn("batch_id", F.lit(batch_id).cast("bigint"))

    meta = SU.company_metadata(subs).join(ciks, "cik", "inner")
    companies = meta.select(
        "cik", "ticker", "name", "business_state", "state_incorp", "sic", "sic_description", "fiscal_year_end")
    companies = companies.join(fundamentals.select("cik", F.col("stock_price").alias("last_price"), "market_cap"),
                               "cik", "left")
    companies = companies.select(*[F.col(f.name).cast(f.dataType) for f in S.COMPANIES_SCHEMA.fields])

    links = SU.latest_filing_links(filings_long)
    filings = links.select(
        (F.lit(batch_id).cast("bigint") * F.lit(ID_BATCH_STRIDE) + F.col("cik").cast("bigint") * 10
         + SU.form_order(F.col("filing_type"))).alias("id"), "cik", "filing_type", "url")
    return {"companies": companies, "fundamentals": fundamentals, "fundamentals_audit": audit,
            "filings": filings}


def skipped_companies(facts_docs: DataFrame, submissions: DataFrame) -> DataFrame:
    """Companies left out because one of the two documents is absent (for the run's report)."""
    return SU.companies_with_both(FA.document_ciks(facts_docs), SU.company_metadata(submissions).select("cik"))[1]


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


#: Hash buckets of a keyed table; a store keeps the number it was made with.
BUCKETS = 16
_BUCKET = "store_bucket"


def read_manifest(spark: SparkSession, store: str) -> dict:
    """The newest manifest of a store (``version`` 0 and no tables when there is none)."""
    fs, p = _fs(spark, os.path.join(store, "manifests"))
    names = [f.getPath().getName() for f in fs.listStatus(p)] if fs.exists(p) else []
    versions = [int(n.removesuffix(".json")) for n in names if n.removesuffix(".json").isdigit()]
    if not versions:
        return {"version": 0, "buckets": BUCKETS, "tables": {}, "streams": {}}
    path = os.path.join(store, "manifests", f"{max(versions)}.json")
    return json.loads(spark.read.text(path, wholetext=True).first()[0])


def _write_manifest(spark: SparkSession, store: str, manifest: dict) -> None:
    """Put the manifest in place by a rename, which fails if the version is taken."""
    folder = os.path.join(store, "manifests")
    fs, p = _fs(spark, folder)
    fs.mkdirs(p)
    tmp, final = _fs(spark, os.path.join(folder, f".{uuid.uuid4().hex}"))[1], _fs(spark, os.path.join(folder, f"{manifest['version']}.json"))[1]
    out = fs.create(tmp, False)
    out.write(bytearray(json.dumps(manifest).encode()))
    out.close()
    if fs.exists(final) or not fs.rename(tmp, final):
        raise RuntimeError(f"store version {manifest['version']} was written by someone else")


def _read_paths(spark: SparkSession, store: str, paths: list[str]) -> DataFrame | None:
    return spark.read.parquet(*[os.path.join(store, x) for x in paths]) if paths else None


def read_current(spark: SparkSession, store: str, table: str) -> DataFrame | None:
    """The current rows of a table, or None before the first load."""
    return _read_paths(spark, store, sorted(read_manifest(spark, store)["tables"].get(table, {}).values()))


def _bucketed(df: DataFrame, buckets: int) -> DataFrame:
    return df.withColumn(_BUCKET, F.pmod(F.xxhash64("cik"), F.lit(buckets)).cast("int"))


def apply_to_store(spark: SparkSession, new: dict[str, DataFrame], store: str, stream: str | None = None,
                   batch_id: int | None = None) -> dict[str, str]:
    """Merge new rows into the store; returns the folder written for each table.

    companies: upsert on cik (K1) · fundamentals: upsert on (cik, report_date)
    (K3; NULL dates never conflict) · filings: insert-ignore (K4) · audit:
    append (K5). A ``batch_id`` that ``stream`` has already brought writes nothing.
    """
    manifest = read_manifest(spark, store)
    if stream is not None and batch_id <= manifest["streams"].get(stream, -1):
        return {}
    out, tables = {}, {t: dict(x) for t, x in manifest["tables"].items()}
    for table, df in new.items():
        parts = tables.setdefault(table, {})
        folder = os.path.join("data", table, uuid.uuid4().hex)
        path = os.path.join(store, folder)
        if table in ("companies", "fundamentals"):
            keys = S.COMPANIES_KEY if table == "companies" else S.FUNDAMENTALS_KEY
            df = cut_lineage(_bucketed(df, manifest["buckets"]), table)
            touched = sorted(str(r[0]) for r in df.select(_BUCKET).distinct().collect())  # one row a bucket at most
            cur = _read_paths(spark, store, [parts[b] for b in touched if b in parts])
            df = df.drop(_BUCKET)
            merged = df if cur is None else U.upsert(cur, df.select(*cur.columns), keys)
            U.write_table(_bucketed(merged, manifest["buckets"]), path, partition_by=[_BUCKET])
            parts |= {b: os.path.join(folder, f"{_BUCKET}={b}") for b in touched}
        else:
            if table == "filings":
                cur = _read_paths(spark, store, sorted(parts.values()))
                df = U.new_rows(df.limit(0) if cur is None else cur, df, S.FILINGS_KEY, required=["url"])
            U.write_table(df, path)
            parts[f"{manifest['version'] + 1:012d}"] = folder
        out[table] = path
    streams = dict(manifest["streams"], **({stream: batch_id} if stream is not None else {}))
    _write_manifest(spark, store, dict(manifest, version=manifest["version"] + 1, tables=tables, streams=streams))
    return out


def run(spark: SparkSession, facts_path: str, submissions_path: str, ticker_map_path: str, store: str,
        tickers: str | None = None, tickers_file: str | None = None, batch_id: int | None = None) -> dict[str, str]:
    """Read landed files, build, merge and write (the ETL entry point)."""
    if batch_id is None:
        batch_id = read_manifest(spark, store)["version"] + 1
    tmap = SY.ticker_map(SY.read_ticker_map_json(spark, ticker_map_path))
    requested = None
    if tickers and tickers.strip().upper() != "ALL":
        requested = SY.tickers_from_arg(spark, tickers)
    if tickers_file:
        f = SY.read_tickers_file(spark, tickers_file)
        requested = f if requested is None else (
            requested.unionByName(f).groupBy("ticker").agg(F.min("pos").alias("pos")))
    new = build_tables(spark, FA.read_company_facts(spark, facts_path),
                       SU.read_submissions(spark, submissions_path), tmap, requested, batch_id=batch_id)
    return apply_to_store(spark, new, store)
