"""Ticker map, symbol directories, ticker lists and the trading universe
(S1–S3, S8, S9, P2–P4, F9, F10, J1, J6, O1, A11).

Positions (``pos``) carry the input order where the reference's rule
depends on it ("last wins", "first wins"); dedupes are partial aggregates
(``min_by``/``max_by`` on the position), never a window over the ticker or
a driver-side loop.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.functions.scalars import pad_cik, strip, upper_trim, yes_flag

TICKER_MAP_SCHEMA = T.MapType(T.StringType(), T.StructType([
    T.StructField("ticker", T.StringType(), True),
    T.StructField("cik_str", T.StringType(), True),
    T.StructField("title", T.StringType(), True),
]))

# Directory layout.
TRAILER_PREFIX = "File Creation Time"
SPECIAL_SYMBOL_RE = r"[\^~$.]"
NASDAQ = "NASDAQ"


def read_ticker_map_json(spark: SparkSession, path: str) -> DataFrame:
    """The ticker map document (``{"0": {ticker, cik_str, title}, ...}``) as rows with positions."""
    doc = spark.read.text(path, wholetext=True)
    return (doc.select(F.posexplode(F.from_json("value", TICKER_MAP_SCHEMA)).alias("pos", "key", "v"))
            .select(F.col("pos").cast("bigint").alias("pos"), "v.ticker", "v.cik_str", "v.title"))


def ticker_map(entries: DataFrame) -> DataFrame:
    """(ticker, cik) with ticker upper/trimmed, cik padded; blank ticker or cik
    dropped; a ticker listed twice keeps its last position."""
    t = entries.select(upper_trim(F.col("ticker").cast("string")).alias("ticker"),
                       F.trim(F.col("cik_str").cast("string")).alias("cik_raw"),
                       F.col("title"), F.col("pos"))
    t = t.where((F.col("ticker") != "") & F.col("ticker").isNotNull()
                & (F.col("cik_raw") != "") & F.col("cik_raw").isNotNull())
    # last wins, as a partial aggregate (a ticker listed many times never lands whole in one task)
    last = t.groupBy("ticker").agg(F.max_by(F.struct("cik_raw", "title", "pos"), "pos").alias("r"))
    return last.select("ticker", pad_cik(F.col("r.cik_raw")).alias("cik"), F.col("r.title").alias("title"),
                       F.col("r.pos").alias("pos"))


def read_symbol_directory(spark: SparkSession, path: str) -> DataFrame:
    """A pipe-delimited directory with header; the trailer line is removed."""
    df = spark.read.option("sep", "|").option("header", True).csv(path)
    first = df.columns[0]
    return (df.where(F.col(first).isNotNull() & ~F.col(first).startswith(TRAILER_PREFIX))
            .withColumn("pos", F.monotonically_increasing_id()))


def normalise_nasdaq_listed(df: DataFrame) -> DataFrame:
    return df.select(upper_trim(F.col("`Symbol`")).alias("ticker"), F.lit(NASDAQ).alias("exchange"),
                     F.col("`Security Name`").alias("name"), yes_flag(F.col("`ETF`")).alias("etf"),
                     yes_flag(F.col("`Test Issue`")).alias("test"), F.lit(0).alias("src"), "pos")


def normalise_other_listed(df: DataFrame) -> DataFrame:
    return df.select(upper_trim(F.col("`ACT Symbol`")).alias("ticker"), upper_trim(F.col("`Exchange`")).alias("exchange"),
                     F.col("`Security Name`").alias("name"), yes_flag(F.col("`ETF`")).alias("etf"),
                     yes_flag(F.col("`Test Issue`")).alias("test"), F.lit(1).alias("src"), "pos")


def symbol_directory(nasdaq: DataFrame, other: DataFrame) -> DataFrame:
    """S3: union both directories, drop missing and special-symbol tickers, and keep
    the first row per ticker (NASDAQ-listed rows before other-listed)."""
    u = normalise_nasdaq_listed(nasdaq).unionByName(normalise_other_listed(other))
    u = u.where(F.col("ticker").isNotNull() & ~F.col("ticker").rlike(SPECIAL_SYMBOL_RE))
    cols = [c for c in u.columns if c != "ticker"]
    first = u.groupBy("ticker").agg(F.min_by(F.struct(*cols), F.struct("src", "pos")).alias("r"))
    return first.select("ticker", *[F.col("r")[c].alias(c) for c in cols])


def universe(directory: DataFrame, tmap: DataFrame, include_etfs: bool = False,
             exchanges: list[str] | None = None) -> DataFrame:
    """J1 + P3 + P4 + T2: directories left-joined to the ticker map; test issues
    always dropped, ETFs unless asked, optional exchange list; ordered.

    When the directories are empty the ticker map alone is the universe
    (exchange ``UNKNOWN``) — decided with a one-row probe, not a count.
    """
    sec = tmap.select("ticker", "cik")
    if directory.isEmpty():
        u = sec.select("ticker", "cik", F.lit("UNKNOWN").alias("exchange"),
                       F.lit(None).cast("string").alias("name"), F.lit(False).alias("etf"),
                       F.lit(False).alias("test"))
    else:
        u = directory.join(sec, "ticker", "left").select("ticker", "cik", "exchange", "name", "etf", "test")
    u = u.where(~F.col("test"))
    if not include_etfs:
        u = u.where(~F.col("etf"))
    if exchanges:
        u = u.where(F.upper(F.col("exchange")).isin([e.upper() for e in exchanges]))
    return u.orderBy("exchange", "ticker")


def tickers_from_text(lines: DataFrame, text_col: str = "value", pos_col: str = "pos") -> DataFrame:
    """Requested tickers from lines/comma lists: trim, skip blanks and ``#``
    lines, upper-case, keep the first position of each ticker."""
    t = lines.select(strip(F.col(text_col)).alias("t"), F.col(pos_col).alias("pos"))
    t = t.where((F.col("t") != "") & ~F.col("t").startswith("#"))
    return t.groupBy(F.upper("t").alias("ticker")).agg(F.min("pos").alias("pos"))


def tickers_from_arg(spark: SparkSession, arg: str) -> DataFrame:
    """Comma-separated argument as a tickers frame (positions in argument order)."""
    df = spark.createDataFrame([(arg,)], "value string")
    return tickers_from_text(df.select(F.posexplode(F.split("value", ",")).alias("pos", "value")))


def read_tickers_file(spark: SparkSession, path: str, offset: int = 1 << 40) -> DataFrame:
    """A tickers file (one per line); positions come after any argument tickers."""
    df = spark.read.text(path).withColumn("pos", F.monotonically_increasing_id() + F.lit(offset))
    return tickers_from_text(df)


def resolve_tickers(requested: DataFrame, tmap: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(found, missing): requested tickers with their CIK, and those without one."""
    req = requested.select("ticker", "pos")
    found = req.join(tmap.select("ticker", "cik"), "ticker", "inner")
    missing = req.join(tmap.select("ticker"), "ticker", "left_anti")
    return found, missing


def all_tickers(tmap: DataFrame) -> DataFrame:
    """``ALL`` — every mapped ticker, sorted."""
    return tmap.select("ticker", "cik").orderBy("ticker")

