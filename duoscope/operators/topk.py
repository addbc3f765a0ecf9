"""Top-k with ties, presentation tables and the table-browsing query (K1-K9)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import num_text, round_numeric

# Columns of the top-k table.
TOP_COLUMNS = ("title", "year", "rating_a", "b_norm", "rating_diff")


# K1, K2 ---------------------------------------------------------------------
def kth_value(df: DataFrame, col: str, k: int, largest: bool = True) -> DataFrame:
    """One row: the k-th largest (smallest) value, NULL and NaN left out; the last one if
    there are fewer than k, NULL if there are none.

    ``orderBy(...).limit(k)`` plans as TakeOrderedAndProject: every task keeps its own
    k best values and only those travel.
    """
    c = F.col(col)
    base = df.where(c.isNotNull() & ~F.isnan(c.cast("double")))
    rows = base.select(c.alias("v")).orderBy(F.col("v").desc() if largest else F.col("v").asc()).limit(k)
    return rows.agg((F.min("v") if largest else F.max("v")).alias("v"))


def top_k(df: DataFrame, col: str = "rating_diff", k: int = 5, largest: bool = True,
          columns: Sequence[str] | None = TOP_COLUMNS) -> DataFrame:
    """All rows whose value ranks within the top ``k`` — ties kept, so possibly > k rows
    (``rank() <= k``, not ``limit k``). NULL values never rank.

    The threshold is a scalar subquery: nothing runs while the plan is built, and its own
    scan reads the one column.
    """
    c = F.col(col)
    thr = kth_value(df, col, k, largest).scalar()
    out = df.where((c >= thr if largest else c <= thr) & ~F.isnan(c.cast("double")))
    if columns is not None:
        out = out.select(*columns)
    return out.orderBy(c.desc() if largest else c.asc())


# K3 -------------------------------------------------------------------------
# Display names of the presentation tables.
DISPLAY_NAMES = {
    "title": "Title", "year": "Year", "rating_a": "Rating A", "b_norm": "Score B",
    "c_norm": "Score C", "rating_diff": "Difference", "abs_diff": "|Difference|",
    "score_b": "Score B (%)", "n_reviews": "Reviews", "status": "Status", "votes": "Votes",
    "primary_genre": "Genre", "match_type": "Match type", "vote_bucket": "Vote bucket",
    "avg_a": "Mean A", "avg_diff": "Mean difference", "count": "Count",
}


def rename_display(df: DataFrame, names: Mapping[str, str] = DISPLAY_NAMES) -> DataFrame:
    return df.withColumnsRenamed({k: v for k, v in names.items() if k in df.columns})


def top_table(df: DataFrame, col: str = "rating_diff", k: int = 5, largest: bool = True,
              digits: int = 2, display: bool = True) -> DataFrame:
    out = round_numeric(top_k(df, col, k, largest), digits)
    return rename_display(out) if display else out


# K4 -------------------------------------------------------------------------
# Columns of the low-review table.
LOW_COLUMNS = ("title", "year", "rating_a", "score_b", "n_reviews", "rating_diff")


def low_review_table(df: DataFrame, flag: str = "low_count", digits: int = 2,
                     display: bool = True) -> DataFrame:
    out = df.where(F.col(flag)).select(*LOW_COLUMNS).orderBy(F.col("n_reviews").asc_nulls_last())
    out = round_numeric(out, digits)
    return rename_display(out) if display else out


# K5 -------------------------------------------------------------------------
def bucket_table(vote_stats: DataFrame, digits: int = 3, display: bool = True) -> DataFrame:
    out = round_numeric(vote_stats.drop("vote_bucket_ord"), digits)
    return rename_display(out) if display else out


# K6 -------------------------------------------------------------------------
# Columns of the full table.
FULL_COLUMNS = ("title", "year", "primary_genre", "rating_a", "b_norm", "c_norm", "rating_diff",
                "abs_diff", "n_reviews", "status", "votes")


def full_table(df: DataFrame, digits: int = 2, display: bool = True, keys: Sequence[str] = ()) -> DataFrame:
    """The display table; ``keys`` are carried along (for a stable sort while browsing)."""
    cols = list(FULL_COLUMNS) + (["match_type"] if "match_type" in df.columns else []) + list(keys)
    out = round_numeric(df.select(*cols), digits)
    return rename_display(out) if display else out


# K7 -------------------------------------------------------------------------
def _text(df: DataFrame, col: str):
    """The column as the table shows it: numbers as plain text."""
    kind = dict(df.dtypes)[col]
    if kind in ("double", "float") or kind.startswith("decimal"):
        return num_text(col)
    return F.col(f"`{col}`").cast("string")


def _condition(df: DataFrame, col: str, kind: str, value):
    c = F.col(f"`{col}`")
    if kind == "range":
        lo, hi = value
        out = F.lit(True)
        if lo is not None:
            out = out & (c >= F.lit(lo))
        return out & (c <= F.lit(hi)) if hi is not None else out
    if kind == "in":
        if isinstance(value, str):
            raise ValueError(f"filter on {col}: 'in' takes a list of values, not one text")
        return c.isin(list(value))
    if kind == "contains":
        return F.contains(F.lower(_text(df, col)), F.lit(str(value).lower()))
    raise ValueError(f"filter on {col}: unknown kind {kind!r} (range, in, contains)")


def browse(df: DataFrame, filters: Mapping[str, tuple[str, object]] | None = None, search: str | None = None,
           order_by: Sequence[str] = (), tie_break: Sequence[str] = (), page: int = 1,
           size: int = 15, ascending: bool = True, hidden: Sequence[str] = (),
           after: Sequence | None = None) -> DataFrame:
    """One page of a table: column filters, a global search, a stable sort.

    ``filters``: column -> ("range", (lo, hi)), ("in", values) or ("contains", text).
    ``search``: case-insensitive text looked for in all displayed columns, numbers as shown;
    ``hidden`` columns (sort keys, say) are neither searched nor returned.
    ``page`` skips (page - 1) * size rows, which costs more the further it goes; ``after``
    continues instead behind the sort and tie-break values of the last row seen, at the same
    cost for any page (the keys must then have no missing values).
    """
    out = df
    for col, (kind, value) in (filters or {}).items():
        out = out.where(_condition(df, col, kind, value))
    shown = [c for c in df.columns if c not in hidden]
    if search:
        needle = F.lit(search.lower())
        hit = F.lit(False)
        for n in shown:
            hit = hit | F.coalesce(F.contains(F.lower(_text(df, n)), needle), F.lit(False))
        out = out.where(hit)
    keys = list(order_by) + [k for k in tie_break if k not in order_by]
    if after is not None:
        if len(after) != len(keys):
            raise ValueError("after needs one value for each sort and tie-break column")
        behind = F.lit(False)
        for i, (k, v) in enumerate(zip(keys, after)):
            same = F.lit(True)
            for k0, v0 in zip(keys[:i], after[:i]):
                same = same & (F.col(k0) == F.lit(v0))
            behind = behind | (same & (F.col(k) > F.lit(v) if ascending else F.col(k) < F.lit(v)))
        out = out.where(behind)
    if keys:
        out = out.orderBy(*[F.col(k).asc_nulls_first() if ascending else F.col(k).desc_nulls_last()
                            for k in keys])
    if after is None and page > 1:
        out = out.offset((page - 1) * size)
    return out.limit(size).select(*[F.col(f"`{c}`") for c in shown])


# K8 -------------------------------------------------------------------------
def choices(stats: DataFrame, col: str = "primary_genre") -> DataFrame:
    return stats.select(col).where(F.col(col).isNotNull()).distinct().orderBy(col)


# K9 -------------------------------------------------------------------------
def filter_in(df: DataFrame, col: str, values: Sequence | None) -> DataFrame:
    """Rows whose ``col`` is in ``values``; an empty or missing selection keeps all."""
    if not values:
        return df
    return df.where(F.col(col).isin(list(values)))
