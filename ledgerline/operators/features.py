"""Feature preparation for the regression models (M1–M3, P9–P14, A12, A13,
F7, F14, F17, F18, W12, M2, J10, J11, S11, S12).

Column *selection* is decided on the driver from the schema and from one
aggregated row of statistics; all row work stays in Spark. Fitted
statistics are a one-row DataFrame that is stored and re-applied, so
serving uses the training medians (the reference recomputes them).
"""

from __future__ import annotations

import math
import weakref
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.functions.cells import PARSERS, parser_kind, to_float
from ledgerline.functions.scalars import finite_or_null, strip, upper_trim
from ledgerline.session import cut_lineage

# Valuation words that leak the target (case-insensitive substrings).
LEAKY_KEYWORDS = [
    "market cap", "market capitalization", "stock price", "share price", "shares outstanding",
    "enterprise value", "ev/revenue", "ev to revenue", "revenue multiple", "rev multiple",
    "rev_multiple", "revmultiple", "price/sales", "price to sales", "ps ratio", "p/s",
]
# Identifier and text columns of the spreadsheet.
TICKER, TARGET = "Ticker", "Revenue Multiple"
EXCLUDED_COLUMNS = [
    TARGET, TICKER, "Company", "Stock Price", "Market Cap", "Founder(s)", "Headquarters",
    "Lead Investor(s) Pre-IPO", "Product Description", "Company Website",
    "Company Investor Relations Page", "S-1 Filing", "2023 10-K Filing",
]
# Canonical headers restored case/space-insensitively.
CANONICAL_HEADERS = [TARGET, "Cash and Short Term Investments", "Total Debt", "Net Income Margin", TICKER,
                     "Annual Revenue per Employee (estimate)"]
# Numeric-table leak patterns and always-excluded stamps.
LEAKY_PATTERNS = ["price", "market_cap", "marketcap", "stock_price", "shares_outstanding", "shares"]
ALWAYS_EXCLUDED = ["id", "fiscal_year", "fiscal_period", "cik"]

VALID_RATIO = 0.7
CONSTANT_STD = 1e-12
FEATURE_SUFFIX = "__num"


def is_leaky(name: str) -> bool:
    """The column name contains a valuation keyword."""
    n = name.lower().strip()
    return any(k in n for k in LEAKY_KEYWORDS)


def normalise_headers(df: DataFrame) -> DataFrame:
    """Rename known headers that differ only by case or surrounding spaces."""
    canon = {c.lower().strip(): c for c in CANONICAL_HEADERS}
    ren = {c: canon[c.lower().strip()] for c in df.columns
           if c.lower().strip() in canon and c != canon[c.lower().strip()]}
    return df.withColumnsRenamed(ren) if ren else df


def require_columns(df: DataFrame, cols: list[str]) -> None:
    """Fail before any job runs when a required column is missing."""
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"input is missing expected columns: {missing}")


def candidate_columns(df: DataFrame) -> list[str]:
    """P9 + P10: every column except identifiers/text and leaky names."""
    return [c for c in df.columns if c not in EXCLUDED_COLUMNS and not is_leaky(c)]


@dataclass(frozen=True)
class ColumnProfile:
    """What one scan tells of a text column: its parser and the parsed values' count, mean and squared deviations."""

    kind: str
    rows: int
    valid: int
    mean: float | None
    m2: float

    @property
    def valid_ratio(self) -> float:
        return self.valid / self.rows if self.rows else 0.0

    def imputed_std(self, fill: float | None) -> float | None:
        """Sample deviation of the column once its missing cells hold ``fill``: the two groups' moments merged."""
        if self.rows < 2:
            return None
        gap = (self.mean if self.mean is not None else 0.0) - (fill if fill is not None else 0.0)
        return math.sqrt(max(0.0, self.m2 + gap * gap * self.valid * (self.rows - self.valid) / self.rows) / (self.rows - 1))


def profile(df: DataFrame, columns: list[str]) -> dict[str, ColumnProfile]:
    """Parser choice, valid ratio and moments of all columns in one scan.

    A column's name leaves at most two parsers, with and without a ``$`` in some
    cell; its values are profiled by both, and the flag chooses."""
    if not columns:
        return {}
    kinds = {c: list(dict.fromkeys((parser_kind(c, True), parser_kind(c, False)))) for c in columns}
    aggs = [F.count(F.lit(1)).alias("n")]
    for i, c in enumerate(columns):
        aggs.append(F.max(F.coalesce(F.instr(F.col(f"`{c}`").cast("string"), "$") > 0, F.lit(False))).alias(f"f{i}"))
    parsed = df.select(*[F.col(f"`{c}`") for c in columns], *[
        PARSERS[k](F.col(f"`{c}`")).alias(f"__p{i}_{k}") for i, c in enumerate(columns) for k in kinds[c]])
    for i, c in enumerate(columns):
        for k in kinds[c]:
            v = F.col(f"__p{i}_{k}")
            aggs.append(F.struct(F.count(v).alias("valid"), F.avg(v).alias("mean"), F.var_pop(v).alias("var")).alias(f"s{i}_{k}"))
    r = parsed.agg(*aggs).first()
    out = {}
    for i, c in enumerate(columns):
        kind = parser_kind(c, bool(r[f"f{i}"]))
        s = r[f"s{i}_{kind}"]
        out[c] = ColumnProfile(kind, r["n"], s["valid"], s["mean"], (s["var"] or 0.0) * s["valid"])
    return out


def parser_plan(df: DataFrame, columns: list[str]) -> dict[str, str]:
    """parser kind per column; the "any cell has $" test is one aggregate row."""
    if not columns:
        return {}
    flags = df.agg(*[F.max(F.coalesce(F.instr(F.col(f"`{c}`").cast("string"), "$") > 0, F.lit(False)))
                     .alias(f"f{i}") for i, c in enumerate(columns)]).first()
    return {c: parser_kind(c, bool(flags[f"f{i}"])) for i, c in enumerate(columns)}


def parse_columns(df: DataFrame, plan: dict[str, str], keep: list[str]) -> DataFrame:
    """Apply the chosen parser to every planned column in one projection."""
    return df.select(*[F.col(f"`{k}`") for k in keep],
                     *[PARSERS[kind](F.col(f"`{c}`")).alias(c) for c, kind in plan.items()])


def with_target(df: DataFrame) -> DataFrame:
    """Parse the target with the float rule and drop rows where it is missing."""
    return df.withColumn("rev_multiple", to_float(F.col(f"`{TARGET}`"))).where(F.col("rev_multiple").isNotNull())


def valid_ratios(parsed: DataFrame, columns: list[str]) -> DataFrame:
    """Share of parsed (non-NULL) cells per column, all columns in one pass."""
    n = F.count(F.lit(1))
    row = parsed.agg(*[(F.count(F.col(f"`{c}`")) / n).alias(c) for c in columns])
    return _long(row, columns, "feature", "valid_ratio")


def _long(one_row: DataFrame, columns: list[str], key: str, value: str) -> DataFrame:
    return one_row.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias(key), F.col(f"`{c}`").cast("double").alias(value)) for c in columns
    ])).alias("s")).select("s.*")


def fit_medians(parsed: DataFrame, columns: list[str]) -> DataFrame:
    """One-row table of exact, interpolated column medians.

    All columns together, in two scans (``evaluation.exact_quantile_table``):
    no column is sorted or held in one task.
    """
    from ledgerline.operators.evaluation import exact_quantile_table
    m = exact_quantile_table(parsed, {c: [0.5] for c in columns})
    one = parsed.sparkSession.range(1)
    return one.select(*[F.lit(m[c][0]).cast("double").alias(c) for c in columns])


_FITTED: "weakref.WeakKeyDictionary[DataFrame, dict]" = weakref.WeakKeyDictionary()


def _one_row(stats: DataFrame) -> dict:
    """The single row of a fitted-statistics table (one row: a proven bound).

    Fetched once per DataFrame object: a fitted table is immutable, so
    re-applying it (scaler fit, then transform) does not recompute it.
    """
    if stats not in _FITTED:
        r = stats.first()
        _FITTED[stats] = r.asDict() if r is not None else {}
    return _FITTED[stats]


def impute(parsed: DataFrame, medians: DataFrame, columns: list[str], default: float = 0.0) -> DataFrame:
    """fill NULLs with the fitted medians (applied as literals from the one-row table)."""
    m = _one_row(medians)
    out = [F.coalesce(F.col(f"`{c}`"), F.lit(m.get(c)).cast("double"), F.lit(default)).alias(c) for c in columns]
    keep = [F.col(f"`{c}`") for c in parsed.columns if c not in columns]
    return parsed.select(*keep, *out)


def column_stddevs(df: DataFrame, columns: list[str]) -> DataFrame:
    """P14 input: sample standard deviation of each (imputed) column."""
    row = df.agg(*[F.stddev_samp(F.col(f"`{c}`")).alias(c) for c in columns])
    return _long(row, columns, "feature", "std")


def fit_features(sheet: DataFrame) -> tuple[DataFrame, list[str], dict[str, str]]:
    """M1 (fit): returns (one-row medians table, kept feature names, parser plan).

    Steps: headers → required columns → target → candidate columns →
    profile (parser plan, valid ratios ≥ 0.7, moments) → medians → constant
    filter. One scan of the text profiles all columns; medians take two of the
    parsed table; no per-column job.
    """
    df = normalise_headers(sheet)
    require_columns(df, [TICKER, TARGET])
    df = with_target(df)
    cands = candidate_columns(df)
    seen = profile(df, cands)
    kept = [c for c in cands if seen[c].valid_ratio >= VALID_RATIO]
    parsed = cut_lineage(parse_columns(df, {c: seen[c].kind for c in kept}, []), "parsed")  # read by both quantile scans
    medians = fit_medians(parsed, kept)
    fill = _one_row(medians)
    stds = {c: seen[c].imputed_std(fill.get(c)) for c in kept}
    names = [c for c in kept if stds[c] is not None and stds[c] > CONSTANT_STD]
    if not names:
        raise ValueError("no numeric feature columns detected after parsing")
    return medians.select(*[F.col(f"`{c}`") for c in names]), names, {c: seen[c].kind for c in names}


def apply_features(sheet: DataFrame, medians: DataFrame, names: list[str], plan: dict[str, str],
                   with_label: bool = True, carry: list[str] | None = None) -> DataFrame:
    """M1 (apply): parse, impute with the stored medians, rename to ``<name>__num``; ``carry`` columns stay as they are."""
    df = normalise_headers(sheet)
    if with_label:
        df = with_target(df)
    keep = [TICKER] + (["rev_multiple"] if with_label else []) + (carry or [])
    parsed = parse_columns(df, {c: plan[c] for c in names}, keep)
    filled = impute(parsed, medians, names)
    return filled.select(*[F.col(f"`{k}`") for k in keep],
                         *[F.col(f"`{c}`").alias(c.strip() + FEATURE_SUFFIX) for c in names])


def leakage_safe_columns(df: DataFrame) -> list[str]:
    """Numeric columns minus leak patterns, identifiers and fiscal stamps."""
    out = []
    for f in df.schema.fields:
        if not isinstance(f.dataType, T.NumericType):
            continue
        low = f.name.lower()
        if any(p in low for p in LEAKY_PATTERNS) or f.name in ALWAYS_EXCLUDED:
            continue
        out.append(f.name)
    return out


def fit_scaler(df: DataFrame, columns: list[str], medians: DataFrame) -> DataFrame:
    """Mean and population std of the imputed columns; std 0 → 1 (one row)."""
    filled = impute(df, medians, columns)
    aggs = []
    for c in columns:
        aggs.append(F.avg(F.col(f"`{c}`")).alias(f"mean__{c}"))
        sd = F.stddev_pop(F.col(f"`{c}`"))
        aggs.append(F.when(sd == 0, F.lit(1.0)).otherwise(sd).alias(f"std__{c}"))
    return filled.agg(*aggs)


def standardize(df: DataFrame, columns: list[str], medians: DataFrame, scaler: DataFrame) -> DataFrame:
    """``(coalesce(x, median) - mean) / std`` with the fitted one-row tables as literals."""
    filled = impute(df, medians, columns)
    sc = _one_row(scaler)
    keep = [F.col(f"`{c}`") for c in df.columns if c not in columns]
    return filled.select(*keep, *[((F.col(f"`{c}`") - F.lit(sc[f"mean__{c}"])) / F.lit(sc[f"std__{c}"])).alias(c)
                                  for c in columns])


def ps_ratio(df: DataFrame) -> Column:
    """market cap ÷ LTM revenue, non-finite → NULL; all NULL if a column is absent."""
    if "market_cap" not in df.columns or "revenue_ltm" not in df.columns:
        return F.lit(None).cast("double")
    return finite_or_null(F.try_divide(F.col("market_cap").cast("double"), F.col("revenue_ltm").cast("double")))


def join_teacher(ids: DataFrame, teacher: DataFrame) -> DataFrame:
    """Left join teacher predictions on those of (ticker, cik) present on both sides."""
    cols = [c for c in ("ticker", "cik") if c in ids.columns and c in teacher.columns]
    if not cols:
        return ids.withColumn("teacher_pred", F.lit(None).cast("double"))
    t = teacher.select(*cols, finite_or_null(F.col("pred")).alias("teacher_pred"))
    return ids.join(t, cols, "left")


def hash_split(df: DataFrame, key_cols: list[str], test_frac: float = 0.2, seed: int = 42) -> DataFrame:
    """M2: deterministic hold-out flag from a hash of the key (stable under repartition)."""
    h = F.pmod(F.xxhash64(*[F.col(c) for c in key_cols], F.lit(seed)), F.lit(10000))
    return df.withColumn("is_test", h < F.lit(int(round(10000 * test_frac))))


def global_rank(df: DataFrame, order: list[Column], name: str = "rank") -> DataFrame:
    """Dense 1-based rank in a total order, computed without a single-task window.

    Sort (range-partitioned, distributed) → checkpoint so the partitioning
    is fixed → per-partition counts (one row per partition, a proven bound,
    broadcast) → running offsets → row_number inside each partition + offset.
    """
    s = cut_lineage(df.orderBy(*order).withColumn("__pid", F.spark_partition_id()))
    counts = s.groupBy("__pid").agg(F.count(F.lit(1)).alias("__n"))
    offs = counts.withColumn("__off", F.coalesce(
        F.sum("__n").over(Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    j = s.join(F.broadcast(offs.select("__pid", "__off")), "__pid")
    w = Window.partitionBy("__pid").orderBy(*order)
    return j.withColumn(name, F.row_number().over(w) + F.col("__off")).drop("__pid", "__off")


#: Text dates that are read besides the standard form.
DATE_FORMATS = ("M/d/yyyy", "yyyy/M/d", "yyyyMMdd", "d MMM yyyy", "MMM d, yyyy")


#: The steps of the date histogram: each counts inside the step that the one before chose.
DATE_STEPS = (86_400_000_000, 1_000_000, 1)


def _cut_date(d: DataFrame, micros: str, rank: int) -> tuple[int | None, int]:
    """(the date of 0-based rank ``rank`` in microseconds, rows before it); NULL dates come last.

    A cumulative histogram of days, then of seconds in the chosen day, then of
    microseconds in the chosen second: at most 3.7 million, 86,400 and 10^6 rows."""
    inside, before = F.lit(True), 0
    for step in DATE_STEPS:
        at = F.floor(F.col(micros) / F.lit(step)) if step > 1 else F.col(micros)
        bins = d.where(inside).groupBy(at.alias("at")).agg(F.count(F.lit(1)).alias("n"), F.min(micros).alias("lo"), F.max(micros).alias("hi"))
        for b in bins.orderBy(F.col("at").asc_nulls_last()).collect():
            if before + b["n"] > rank:
                break
            before += b["n"]
        if b["lo"] == b["hi"]:  # one date left (or none: text that is no date)
            return b["lo"], before
        inside = F.col(micros).between(b["lo"], b["hi"])
    raise AssertionError("unreachable: a microsecond is one date")


def chronological_split(df: DataFrame, date_col: str, key_cols: list[str], val_frac: float = 0.2) -> DataFrame:
    """Drop missing dates, order by date, the first ``int(n·(1−frac))`` rows are train.

    Text dates are parsed first (``DATE_FORMATS``); text that is no date
    counts as present, so it stays and sorts last. Rows sharing a date are
    ordered by ``key_cols`` (the reference's order there is unspecified).

    A histogram of the dates gives the date on which the cut falls; all other
    rows are compared with it, and only the rows of that date are ranked.
    """
    d = df.where(F.col(date_col).isNotNull())
    when = F.col(date_col)
    if isinstance(df.schema[date_col].dataType, T.StringType):
        text = strip(when)
        when = F.coalesce(text.try_cast("timestamp"), *[F.try_to_timestamp(text, F.lit(f)) for f in DATE_FORMATS])
    d = d.withColumn("__at", F.unix_micros(when.cast("timestamp")))
    n = d.count()
    cut = int(n * (1.0 - val_frac))
    label = lambda c: F.when(c, F.lit("train")).otherwise(F.lit("val"))
    if not 0 < cut < n:
        return d.drop("__at").withColumn("split", F.lit("train" if n and cut >= n else "val"))
    date, before = _cut_date(d, "__at", cut - 1)
    same = F.col("__at").eqNullSafe(F.lit(date).cast("long"))
    earlier = F.lit(True) if date is None else F.coalesce(F.col("__at") < F.lit(date), F.lit(False))
    others = d.where(~same).withColumn("split", label(earlier))
    tied = global_rank(d.where(same), [F.col(k) for k in key_cols], "__rk")
    tied = tied.withColumn("split", label(F.col("__rk") <= F.lit(cut - before))).drop("__rk")
    return others.unionByName(tied).drop("__at")


def lookup_rows(features: DataFrame, requests: DataFrame, ticker_col: str = "ticker") -> DataFrame:
    """J11 (batch): feature rows for requested tickers, first match per ticker
    (upper/trim equality); requests without a match get NULL features."""
    f = features.withColumn("__k", upper_trim(F.col(TICKER))).withColumn("__p", F.monotonically_increasing_id())
    first = f.groupBy("__k").agg(F.min_by(F.struct(*[F.col(f"`{c}`") for c in features.columns]), "__p").alias("r"))
    req = requests.withColumn("__k", upper_trim(F.col(ticker_col)))
    j = req.join(first, "__k", "left")
    return j.select(*[F.col(f"`{c}`") for c in requests.columns],
                    *[F.col("r")[c].alias(c) for c in features.columns if c != TICKER]).drop("__k")
