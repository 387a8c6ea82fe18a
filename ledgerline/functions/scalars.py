"""Scalar column functions (all JVM-side, codegen friendly)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _c(x: ColumnOrName) -> Column:
    return F.col(x) if isinstance(x, str) else x


#: Fixed value: the characters that Python's ``str.strip`` removes.
STRIPPED = ("\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008"
            "\u2009\u200a\u2028\u2029\u202f\u205f\u3000")


def strip(c: ColumnOrName) -> Column:
    """Text without white space at either end, as Python strips it (Spark's ``trim`` removes spaces only)."""
    return F.btrim(_c(c).cast("string"), F.lit(STRIPPED))


def pad_cik(c: ColumnOrName) -> Column:
    """Trim and left-pad with zeros to 10 characters; never truncates.

    Plain ``lpad`` would cut longer values, so it is only applied when short.
    """
    t = strip(c)
    return F.when(F.length(t) < 10, F.lpad(t, 10, "0")).otherwise(t)


def upper_trim(c: ColumnOrName) -> Column:
    return F.upper(strip(c))


def yes_flag(c: ColumnOrName) -> Column:
    """``upper(x) == 'Y'``, with a missing cell read as ``N``."""
    return F.upper(F.coalesce(_c(c).cast("string"), F.lit("N"))) == F.lit("Y")


def finite_or_null(c: ColumnOrName) -> Column:
    """Turn NaN and +/-Infinity into NULL (pandas skips NaN, Spark does not)."""
    x = _c(c).cast("double")
    return F.when(F.isnan(x) | (F.abs(x) == F.lit(float("inf"))), F.lit(None).cast("double")).otherwise(x)


def try_int(c: ColumnOrName) -> Column:
    """Integer or NULL; accepts integral text and integral numbers."""
    x = _c(c)
    return F.coalesce(x.try_cast("int"), x.try_cast("double").try_cast("int"))


def scale_int(scale: ColumnOrName) -> Column:
    """The power of ten of a value: integral text or number (``3``, ``3.0``); bad or missing is 0."""
    return F.coalesce(try_int(scale), F.lit(0))


def filing_url(cik: ColumnOrName, accession: ColumnOrName, document: ColumnOrName) -> Column:
    """``.../edgar/data/{int cik}/{accession without dashes}/{document}``."""
    # Fixed value: the archive prefix of filing links.
    prefix = "https://www.sec.gov/Archives/edgar/data/"
    return F.concat(
        F.lit(prefix),
        _c(cik).cast("bigint").cast("string"), F.lit("/"),
        F.regexp_replace(_c(accession), "-", ""), F.lit("/"),
        _c(document),
    )


def safe_ratio_pct(num: ColumnOrName, den: ColumnOrName, limit: float = 100.0) -> Column:
    """Margin guardrail: ``num/den*100`` when ``den > 0`` and |result| <= limit."""
    n = _c(num).cast("double")
    d = _c(den).cast("double")
    m = F.when(d > 0, n / d * F.lit(100.0))
    return F.when(F.abs(m) <= F.lit(limit), m)

