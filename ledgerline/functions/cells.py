"""Parsing of text cells into numbers, as column expressions.

The number rule follows Python's ``float()`` on text, which differs from a
plain Spark cast: ``float()`` accepts ``1_000`` and rejects ``1.0d``/``1f``,
while ``try_cast`` does the opposite. A guard regex makes the cast agree.
NaN and infinities become NULL (pandas would skip them; Spark would not).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerline.functions.scalars import STRIPPED, strip

ColumnOrName = Column | str

# Cell texts read as missing (the en dash is U+2013).
MISSING_TOKENS = ["", "N/A", "NA", "na", "null", "None", "–", "-"]

# Fixed value: the shape of a finite decimal number accepted by float(), single underscores between digits included.
_DIGITS = r"\d+(?:_\d+)*"
_NUMBER = rf"[+-]?(?:{_DIGITS}\.?(?:{_DIGITS})?|\.{_DIGITS})(?:[eE][+-]?{_DIGITS})?"
#: A character class of what ``str.strip`` removes.
_SPACE = "[" + "".join(f"\\x{{{ord(c):x}}}" for c in STRIPPED) + "]*"
_NON_FINITE = ["inf", "+inf", "-inf", "infinity", "+infinity", "-infinity", "nan", "+nan", "-nan"]


def is_missing(c: ColumnOrName) -> Column:
    """NULL, or trimmed text in the missing-token list (F2)."""
    t = strip(c)
    return t.isNull() | t.isin(MISSING_TOKENS)


def _text(c: ColumnOrName) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def py_float_parsed(c: ColumnOrName) -> Column:
    """TRUE when Python's ``float()`` would accept the text (non-finite included)."""
    t = _text(c)
    return F.coalesce(t.rlike(rf"^{_SPACE}{_NUMBER}{_SPACE}\z") | F.lower(strip(t)).isin(_NON_FINITE), F.lit(False))


def _finite(text: Column) -> Column:
    """An array of the number that the text is, empty if it is none or too large for a double.

    One match strips, checks and cuts out the number, so that the text is read
    once; no missing token has the shape of a number."""
    number = F.regexp_extract(text, rf"^{_SPACE}({_NUMBER}){_SPACE}\z", 1)
    return F.filter(F.array(F.translate(number, "_", "").try_cast("double")), lambda v: F.abs(v) < F.lit(float("inf")))


def py_float(c: ColumnOrName) -> Column:
    """Finite number per Python's ``float()`` text rule, else NULL."""
    return F.get(_finite(_text(c)), F.lit(0))


def parse_money(c: ColumnOrName) -> Column:
    """Money cell: strip ``$`` and ``,``, then the float rule."""
    return py_float(F.translate(_text(c), "$,", ""))


def parse_percent(c: ColumnOrName) -> Column:
    """Percent cell → fraction: strip one trailing ``%`` and commas; |v| > 2 is read as percent."""
    t = F.translate(F.regexp_replace(_text(c), rf"%{_SPACE}\z", ""), ",", "")
    return F.get(F.transform(_finite(t), lambda v: F.when(F.abs(v) > 2, v / F.lit(100.0)).otherwise(v)), F.lit(0))


def to_float(c: ColumnOrName) -> Column:
    """Generic cell: trim + float rule; commas are not stripped."""
    return py_float(c)


# Name hints choosing the parser of a column.
PERCENT_HINTS = ["%", "yoy", "margin", "growth"]
MONEY_HINTS = ["revenue", "income", "ebitda", "cash", "debt", "price", "cap", "funding", "investments"]


def parser_kind(name: str, has_dollar: bool) -> str:
    """``percent`` / ``money`` / ``float`` for a column (decided on the driver from names
    and one aggregated flag, never from the data rows themselves)."""
    low = name.lower()
    if any(h in low for h in PERCENT_HINTS):
        return "percent"
    if has_dollar or any(h in low for h in MONEY_HINTS):
        return "money"
    return "float"


PARSERS = {"percent": parse_percent, "money": parse_money, "float": to_float}
