"""Column -> Column helpers for cleaning and derived columns.

All of them are built-in Spark expressions, so they stay inside whole-stage codegen.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


# Unicode-aware outer whitespace (tab, NBSP, ...): Spark's trim() strips only U+0020.
_OUTER_WS = r"(?U)^\s+|\s+$"


def unicode_trim(c: ColumnOrName) -> Column:
    return F.regexp_replace(_c(c), _OUTER_WS, "")


def is_missing(c: ColumnOrName) -> Column:
    """NULL, or NaN for floating columns (R's is.na is true for both)."""
    c = _c(c)
    return c.isNull() | F.isnan(c)


def is_missing_typed(c: str, dtype: str) -> Column:
    """``is_missing`` that only applies isnan where the type allows it."""
    if dtype in ("double", "float"):
        return is_missing(c)
    return F.col(c).isNull()


# C1 -------------------------------------------------------------------------
def tolerant_int(c: ColumnOrName) -> Column:
    """Text -> number -> int; bad text gives NULL, fractions are truncated ('1994.7' -> 1994)."""
    return _c(c).try_cast("double").try_cast("int")


# C2 -------------------------------------------------------------------------
def normalize_title(c: ColumnOrName) -> Column:
    """Trim all Unicode outer whitespace, then lower case. Inner text is kept as is."""
    return F.lower(unicode_trim(c))


# C5 -------------------------------------------------------------------------
def release_year(c: ColumnOrName) -> Column:
    """Year of a date, timestamp or date text (year-month-day or year/month/day, padded or
    not, trailing text ignored); anything else gives NULL."""
    head = F.regexp_extract(_c(c).cast("string"), r"^\s*(\d{4}([-/])\d{1,2}\2\d{1,2})", 1)
    return F.year(F.try_to_date(F.replace(head, F.lit("/"), F.lit("-")), "yyyy-M-d"))


# C7 -------------------------------------------------------------------------
def rescale(c: ColumnOrName, factor: float = 10.0) -> Column:
    """0-100 score -> 0-10 scale (divide by ``factor``)."""
    return _c(c) / F.lit(float(factor))


# D1 -------------------------------------------------------------------------
def diff(a: ColumnOrName, b: ColumnOrName) -> Column:
    return _c(a) - _c(b)


# D2 -------------------------------------------------------------------------
def primary_item(c: ColumnOrName, sep: str = ",") -> Column:
    """Text before the first separator, trimmed; NULL stays NULL."""
    return unicode_trim(F.split_part(_c(c), F.lit(sep), F.lit(1)))


# D3 -------------------------------------------------------------------------
def decade(c: ColumnOrName) -> Column:
    """floor(year / 10) * 10, flooring negative years too."""
    return (F.floor(_c(c) / F.lit(10)) * F.lit(10)).cast("int")


# D4 -------------------------------------------------------------------------
def low_count_flag(c: ColumnOrName, threshold: int = 20) -> Column:
    """``c < threshold``; NULL when c is NULL."""
    return _c(c) < F.lit(threshold)


# D5 -------------------------------------------------------------------------
def bucketize(c: ColumnOrName, breaks: Sequence[float], labels: Sequence[str]) -> tuple[Column, Column]:
    """Right-closed intervals with the lowest edge included: [b0,b1] (b1,b2] ...

    Returns (label, order) columns; values outside the breaks, NULL and NaN give NULL.
    """
    if len(labels) != len(breaks) - 1:
        raise ValueError("need exactly len(breaks) - 1 labels")
    x = _c(c)
    label = None
    order = None
    for i, lab in enumerate(labels):
        lo, hi = float(breaks[i]), float(breaks[i + 1])
        cond = (x >= lo) & (x <= hi) if i == 0 else (x > lo) & (x <= hi)
        cond = cond & ~F.isnan(x.cast("double"))
        label = F.when(cond, F.lit(lab)) if label is None else label.when(cond, F.lit(lab))
        order = F.when(cond, F.lit(i + 1)) if order is None else order.when(cond, F.lit(i + 1))
    return label, order


# The reference's vote-count breaks and bucket labels.
VOTE_BREAKS = (0, 100000, 500000, 1000000, 5000000)
VOTE_LABELS = ("<100k", "100k–500k", "500k–1M", ">1M")


# D6 -------------------------------------------------------------------------
def safe_log10(c: ColumnOrName) -> Column:
    x = _c(c)
    return F.when(x > 0, F.log10(x))


# D7 -------------------------------------------------------------------------
# Strength cut points of |r| (strictly below each) and their texts.
CORR_CUTS = (0.2, 0.4, 0.6, 0.8)
CORR_LABELS = ("very weak correlation", "weak correlation", "moderate correlation",
               "strong correlation", "very strong correlation")
CORR_NA_LABEL = "correlation not computable"


def corr_label(c: ColumnOrName, labels: Sequence[str] = CORR_LABELS,
               na_label: str = CORR_NA_LABEL) -> Column:
    r = _c(c)
    out = F.when(r.isNull() | F.isnan(r), F.lit(na_label))
    for cut, lab in zip(CORR_CUTS, labels):
        out = out.when(F.abs(r) < cut, F.lit(lab))
    return out.otherwise(F.lit(labels[-1]))


# D8 -------------------------------------------------------------------------
def fmt_p(c: ColumnOrName) -> Column:
    p = _c(c)
    return F.when(p < 0.001, F.lit("< 0.001")).when(p.isNotNull(), F.format_string("%.3f", p))


def fmt_ci(lo: ColumnOrName, hi: ColumnOrName) -> Column:
    return F.format_string("[%.3f, %.3f]", _c(lo), _c(hi))


# D9 -------------------------------------------------------------------------


def round_numeric(df, digits: int = 2):
    """Round every floating/decimal column half-even to ``digits``; integers untouched."""
    cols = []
    for name, dtype in df.dtypes:
        if dtype in ("double", "float") or dtype.startswith("decimal"):
            cols.append(F.bround(F.col(name), digits).alias(name))
        else:
            cols.append(F.col(name))
    return df.select(*cols)


# D10 ------------------------------------------------------------------------
def num_text(c: ColumnOrName, digits: int = 2) -> Column:
    """Rounded half-even, as plain decimal text: no exponent, no trailing zeros."""
    s = F.bround(_c(c).cast("double"), digits).cast(f"decimal(38,{max(digits, 1)})").cast("string")
    # a decimal has a point: no zero before it goes
    return F.rtrim(F.rtrim(s, F.lit("0")), F.lit("."))


def thousands(c: ColumnOrName) -> Column:
    """Integer text with thousands separators ('1,234,567'), half-even to units."""
    return F.format_number(F.bround(_c(c).cast("double"), 0), 0)


def point_label(title: ColumnOrName, year: ColumnOrName,
                parts: Sequence[tuple[str, ColumnOrName]], sep: str = " / ") -> Column:
    """'title (year) / a: x / b: y ...'; values of named columns rounded to 2 digits, Column
    values taken as the text they are."""
    head = F.concat(_c(title), F.lit(" ("), _c(year).cast("string"), F.lit(")"))
    items = [head] + [F.concat(F.lit(f"{name}: "), num_text(v) if isinstance(v, str) else v) for name, v in parts]
    return F.concat_ws(sep, *items)


# D11 ------------------------------------------------------------------------
def sign_class(c: ColumnOrName, pos: str = "a", neg: str = "b") -> Column:
    return F.when(_c(c) > 0, F.lit(pos)).otherwise(F.lit(neg))
