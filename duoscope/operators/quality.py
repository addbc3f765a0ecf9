"""Data-quality profile and hard gates (Q1-Q13, S4).

Every report is one aggregation pass (partial aggregation per task, one tiny final
merge); the only action is ``assert_quality`` collecting its one-row report.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import is_missing_typed


class QualityGateError(AssertionError):
    """Raised when the linked table fails a hard gate."""


def _missing_count(df: DataFrame, col: str) -> F.Column:
    dtype = dict(df.dtypes)[col]
    return F.count_if(is_missing_typed(col, dtype))


# S4 -------------------------------------------------------------------------
def ingest_profile(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """One row: row count and total missing cells over ``cols`` (default: all)."""
    cols = list(cols or df.columns)
    dtypes = dict(df.dtypes)
    missing = sum((is_missing_typed(c, dtypes[c]).cast("long") for c in cols), F.lit(0).cast("long"))
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.sum(missing).alias("n_missing"))


# Q1-Q4, Q6 ------------------------------------------------------------------
def quality_report(df: DataFrame, title: str = "title", year: str = "year",
                   rating_a: str = "rating_a", b_norm: str = "b_norm",
                   low_flag: str = "low_count") -> DataFrame:
    """One-row report: NULL ratings, duplicates by (title, year), ranges, flagged rows.

    Duplicates treat NULL = NULL (count distinct over a struct, not over two columns,
    which would skip rows with a NULL part).
    """
    return df.agg(
        _missing_count(df, rating_a).alias("null_rating_a"),
        _missing_count(df, b_norm).alias("null_b_norm"),
        (F.count(F.lit(1)) - F.count_distinct(F.struct(title, year))).alias("duplicates"),
        F.min(rating_a).alias("min_rating_a"),
        F.max(rating_a).alias("max_rating_a"),
        F.min(b_norm).alias("min_b_norm"),
        F.max(b_norm).alias("max_b_norm"),
        F.count_if(F.col(low_flag)).alias("n_low_count"),
    )


# Q5 -------------------------------------------------------------------------
def assert_quality(df: DataFrame, **names) -> dict:
    """Collect the one-row report; raise if NULL ratings or duplicates exist.

    Ranges and flagged counts are only reported, as in the reference.
    """
    row = quality_report(df, **names).first().asDict()
    problems = []
    if row["null_rating_a"]:
        problems.append(f"NULL values in rating_a: {row['null_rating_a']}")
    if row["null_b_norm"]:
        problems.append(f"NULL values in b_norm: {row['null_b_norm']}")
    if row["duplicates"]:
        problems.append(f"duplicate (title, year) rows: {row['duplicates']}")
    if problems:
        raise QualityGateError("; ".join(problems))
    return row


def gated(df: DataFrame, title: str = "title", year: str = "year", rating_a: str = "rating_a",
          b_norm: str = "b_norm") -> DataFrame:
    """``df`` behind the gate: whatever writes or reads it fails inside its own job if a rating is
    NULL or a (title, year) repeats. No row reaches the driver, and nothing runs beforehand.

    NULL ratings fail the row's task; repeats are counted by an aggregation over (title, year) that is
    a scalar subquery of the plan, so the message has their number.
    """
    dtypes = dict(df.dtypes)
    repeats = df.groupBy(F.col(title).alias("t"), F.col(year).alias("y")).agg((F.count(F.lit(1)) - 1).alias("n"))
    repeats = repeats.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).scalar()
    fails = F.when(repeats > 0, F.raise_error(F.concat(F.lit("duplicate (title, year) rows: "), repeats.cast("string"))))
    for c in (rating_a, b_norm):
        fails = fails.when(is_missing_typed(c, dtypes[c]), F.raise_error(F.lit(f"NULL values in {c}")))
    return df.where(fails.otherwise(F.lit(True)).cast("boolean"))


def gate_report(df: DataFrame, **names) -> DataFrame:
    """The one-row report with ``passed``: no NULL ratings and no duplicates."""
    bad = F.col("null_rating_a") + F.col("null_b_norm") + F.col("duplicates")
    return quality_report(df, **names).withColumn("passed", bad == 0)


# Q7, Q8 ---------------------------------------------------------------------
# The seven core variables of the missing-value table, in this order.
CORE_MISSING = ("rating_a", "b_norm", "c_norm", "n_reviews", "votes", "primary_genre", "year")


def missing_by_column(df: DataFrame, cols: Sequence[str] = CORE_MISSING,
                      desc: bool = True) -> DataFrame:
    """Long table (variable, n_missing): one aggregation, then unpivot (no rescans)."""
    wide = df.agg(*[_missing_count(df, c).alias(c) for c in cols])
    long = wide.unpivot([], list(cols), "variable", "n_missing")
    order = F.col("n_missing").desc() if desc else F.col("n_missing").asc()
    return long.orderBy(order, "variable")


# Q9 -------------------------------------------------------------------------
def missing_total(df: DataFrame, cols: Sequence[str] = CORE_MISSING[:5]) -> DataFrame:
    dtypes = dict(df.dtypes)
    total = sum((is_missing_typed(c, dtypes[c]).cast("long") for c in cols), F.lit(0).cast("long"))
    return df.agg(F.sum(total).alias("n_missing"))


# Q10 ------------------------------------------------------------------------
def duplicate_count(df: DataFrame, keys: Sequence[str] = ("title", "year"),
                    as_text: bool = True) -> DataFrame:
    """Rows after the first per key; ``as_text`` pastes the key as text first
    ('NA' for NULL), so NULL parts and colliding concatenations count as equal."""
    if as_text:
        key = F.concat_ws(" ", *[F.coalesce(F.col(k).cast("string"), F.lit("NA")) for k in keys])
    else:
        key = F.struct(*keys)
    return df.agg((F.count(F.lit(1)) - F.count_distinct(key)).alias("duplicates"))


# Q11, Q12 -------------------------------------------------------------------
def match_type_counts(df: DataFrame, col: str = "match_type") -> DataFrame:
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("n").desc(), col)


def match_type_number(df: DataFrame, col: str = "match_type") -> DataFrame:
    return df.agg(F.count_distinct(F.coalesce(F.col(col), F.lit("\u0000NULL"))).alias("n_match_types"))


# Q13 ------------------------------------------------------------------------
# The eleven QA metric names, in display order.
QA_METRICS = ("rows", "missing_rating_a", "missing_b_norm", "missing_c_norm", "duplicates",
              "rating_a_min", "rating_a_max", "b_norm_min", "b_norm_max", "n_low_count",
              "distinct_genres")


def qa_metrics(df: DataFrame, title: str = "title", year: str = "year") -> DataFrame:
    """Key/value table of 11 metrics from one aggregation (values as double)."""
    paste = F.concat_ws(" ", F.coalesce(F.col(title).cast("string"), F.lit("NA")),
                        F.coalesce(F.col(year).cast("string"), F.lit("NA")))
    wide = df.agg(
        F.count(F.lit(1)).cast("double").alias("rows"),
        _missing_count(df, "rating_a").cast("double").alias("missing_rating_a"),
        _missing_count(df, "b_norm").cast("double").alias("missing_b_norm"),
        _missing_count(df, "c_norm").cast("double").alias("missing_c_norm"),
        (F.count(F.lit(1)) - F.count_distinct(paste)).cast("double").alias("duplicates"),
        F.bround(F.min("rating_a"), 2).alias("rating_a_min"),
        F.bround(F.max("rating_a"), 2).alias("rating_a_max"),
        F.bround(F.min("b_norm"), 2).alias("b_norm_min"),
        F.bround(F.max("b_norm"), 2).alias("b_norm_max"),
        F.count_if(F.col("low_count")).cast("double").alias("n_low_count"),
    )
    # its own small aggregation: a second distinct would multiply the rows before the shuffle
    genres = df.groupBy("primary_genre").agg(F.lit(1).alias("one")).agg(F.count("primary_genre").cast("double"))
    wide = wide.withColumn("distinct_genres", genres.scalar())
    return wide.unpivot([], list(QA_METRICS), "metric", "value")
