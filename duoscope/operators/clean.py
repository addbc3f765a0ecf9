"""Cleaning (C3, C4, C6) and the derived columns of the linked table (D1-D6)."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..functions import scalars as S


# C3 -------------------------------------------------------------------------
def clean_a(df: DataFrame, year_text: str = "year_text", year: str = "year",
            title: str = "title", rating: str = "rating_a") -> DataFrame:
    """Tolerant year (C1), title_clean (C2); keep rows with a year and a rating."""
    out = df.withColumn(year, S.tolerant_int(F.col(year_text)))
    if year != year_text:
        out = out.drop(year_text)
    out = out.withColumn("title_clean", S.normalize_title(F.col(title)))
    return out.where(F.col(year).isNotNull() & ~S.is_missing(rating))


# C4 -------------------------------------------------------------------------
def clean_b(df: DataFrame, score: str = "score_b", title: str = "title",
            release_date: str | None = "release_date", release_year: str = "release_year") -> DataFrame:
    """Keep rows with a score and a title; add release_year (C5) and title_clean (C2)."""
    out = df.where(~S.is_missing(score) & F.col(title).isNotNull())
    if release_date is not None:
        out = out.withColumn(release_year, S.release_year(F.col(release_date)))
    return out.withColumn("title_clean", S.normalize_title(F.col(title)))


# C6 -------------------------------------------------------------------------
def cleaning_report(raw: DataFrame, keep_condition, source: str) -> DataFrame:
    """One row: rows before, after and removed, as one conditional aggregation
    over the uncleaned frame (a single pass, no second scan)."""
    return raw.agg(
        F.lit(source).alias("source"),
        F.count(F.lit(1)).alias("rows_before"),
        F.count_if(keep_condition).alias("rows_after"),
    ).withColumn("rows_removed", F.col("rows_before") - F.col("rows_after"))


def observed(raw: DataFrame, keep_condition, source: str) -> tuple[DataFrame, Observation]:
    """``raw`` with its accounting attached: rows before and after cleaning, counted by the job that
    cleans it. ``accounting`` reads the numbers once that job has run."""
    seen = Observation(f"cleaning {source} {uuid.uuid4().hex[:8]}")
    return raw.observe(seen, F.count(F.lit(1)).alias("rows_before"), F.count_if(keep_condition).alias("rows_after")), seen


def accounting(seen: dict[str, Observation]) -> list[dict]:
    """source, rows_before, rows_after, rows_removed of each observation; waits for their jobs."""
    return [{"source": source, **o.get, "rows_removed": o.get["rows_before"] - o.get["rows_after"]}
            for source, o in seen.items()]


def keep_condition_a(year_text: str = "year_text", rating: str = "rating_a"):
    return S.tolerant_int(F.col(year_text)).isNotNull() & ~S.is_missing(rating)


def keep_condition_b(score: str = "score_b", title: str = "title"):
    return ~S.is_missing(score) & F.col(title).isNotNull()


# C7 + D1-D6 -----------------------------------------------------------------
def derive(df: DataFrame, rating_a: str = "rating_a", score_b: str | None = "score_b",
           score_c: str | None = "score_c", year: str | None = "year", genre_list: str = "genre_list",
           n_reviews: str = "n_reviews", votes: str = "votes", low_threshold: int = 20,
           vote_breaks=S.VOTE_BREAKS, vote_labels=S.VOTE_LABELS) -> DataFrame:
    """Rescaled scores and every derived column of the linked table, in one projection."""
    cols = {}
    if score_b is not None:
        cols["b_norm"] = S.rescale(F.col(score_b))
    if score_c is not None:
        cols["c_norm"] = S.rescale(F.col(score_c))
    out = df.withColumns(cols) if cols else df
    label, order = S.bucketize(F.col(votes), vote_breaks, vote_labels)
    return out.withColumns({
        "rating_diff": S.diff(rating_a, "b_norm"),
        "abs_diff": F.abs(S.diff(rating_a, "b_norm")),
        "primary_genre": S.primary_item(F.col(genre_list)),
        "decade": S.decade(F.col(year)) if year else F.lit(None).cast("int"),
        "low_count": S.low_count_flag(F.col(n_reviews), low_threshold),
        "vote_bucket": label,
        "vote_bucket_ord": order,
        "votes_log10": S.safe_log10(F.col(votes)),
    })


def derive_sql(src: str, year: str = "year") -> str:
    """DuckDB form of ``derive`` (used by the oracles)."""
    return f"""
SELECT *,
  rating_a - b_norm AS rating_diff,
  abs(rating_a - b_norm) AS abs_diff,
  trim(split_part(genre_list, ',', 1)) AS primary_genre,
  CAST(floor({year} / 10) * 10 AS integer) AS decade,
  n_reviews < 20 AS low_count,
  CASE WHEN votes >= 0 AND votes <= 100000 THEN '<100k'
       WHEN votes > 100000 AND votes <= 500000 THEN '100k–500k'
       WHEN votes > 500000 AND votes <= 1000000 THEN '500k–1M'
       WHEN votes > 1000000 AND votes <= 5000000 THEN '>1M' END AS vote_bucket,
  CASE WHEN votes >= 0 AND votes <= 100000 THEN 1
       WHEN votes > 100000 AND votes <= 500000 THEN 2
       WHEN votes > 500000 AND votes <= 1000000 THEN 3
       WHEN votes > 1000000 AND votes <= 5000000 THEN 4 END AS vote_bucket_ord,
  CASE WHEN votes > 0 THEN log10(votes) END AS votes_log10
FROM (SELECT *, score_b / 10.0 AS b_norm, score_c / 10.0 AS c_norm FROM ({src}) s0) s1
"""
