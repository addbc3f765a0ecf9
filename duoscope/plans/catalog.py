"""Registered queries: one Spark builder per operator, each paired with DuckDB SQL.

Inputs are the fixture adapters over the given tables (F: facts, L: linkage of page
titles, T: whole texts); every query runs over whole tables and whole titles. Oracles are
written independently in SQL (window ``row_number`` for the best match, ``rank`` for top-k,
``quantile_cont`` for boxes, Simpson's rule on the density for the t distribution).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import clean as C
from ..operators import feeds as G
from ..operators import link as J
from ..operators import moments as M
from ..operators import pages as P
from ..operators import quality as Q
from ..operators import stats as A
from ..operators import topk as K
from ..session import cut_lineage
from ..sources import catalogs as R
from ..sources import fixtures as fx
from . import pipeline as X

# ============================================================== shared inputs
KEYS = ["l_orderkey", "l_linenumber"]


def facts_raw(spark: SparkSession, d: str) -> DataFrame:
    return fx.facts(spark, d)


def facts_prepared(spark: SparkSession, d: str) -> DataFrame:
    """F cleaned (C1-C3) and derived (C7, D1-D6): the 'linked table' of the F queries."""
    return C.derive(C.clean_a(fx.facts(spark, d)))


# DuckDB's Jaro uses the floored transposition count.
L_CFG = X.RunConfig(floor_transpositions=True, decade_min_n=5, enforce_gate=False)


def l_sides(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    return X.clean_sides(fx.link_left(spark, d), fx.link_right(spark, d), L_CFG)


def l_link(spark: SparkSession, d: str) -> J.LinkResult:
    a, b = l_sides(spark, d)
    return J.link(a, b, L_CFG.a_block, L_CFG.b_block, L_CFG.order_col, b_cols=L_CFG.b_cols, floor=True)


def l_data(spark: SparkSession, d: str) -> DataFrame:
    a, b = l_sides(spark, d)
    return X.link_and_derive(a, b, L_CFG)[0]


def l_run(spark: SparkSession, d: str) -> dict:
    """X1 over L with one row per title on either side: the gate is enforced and passes."""
    left = fx.unique_titles(fx.link_left(spark, d), "a_id")
    right = fx.unique_titles(fx.link_right(spark, d), "b_id")
    return X.run(left, right, X.RunConfig(floor_transpositions=True, decade_min_n=5))


def t_sides(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    return J.prepare_sides(fx.text_left(spark, d), fx.text_right(spark, d))


F_RAW_SQL = fx.F_SQL
YEAR_SQL = "try_cast(trunc(try_cast(year_text AS double)) AS integer)"
FP_BASE_SQL = f"""
SELECT * EXCLUDE (year_text), {YEAR_SQL} AS year, lower(trim(title)) AS title_clean
FROM ({F_RAW_SQL}) f
WHERE {YEAR_SQL} IS NOT NULL AND NOT (rating_a IS NULL OR isnan(rating_a))
"""
FP_SQL = C.derive_sql(FP_BASE_SQL)

def clean_title_sql(col: str) -> str:
    return f"lower(regexp_replace({col}, '^\\s+|\\s+$', '', 'g'))"


# DuckDB's jaro_similarity compares bytes: each non-ASCII letter of the titles becomes one
# byte that lower-case titles do not use. Jaro needs equality only.
def one_byte_sql(col: str) -> str:
    return f"translate({col}, 'äçèéêíñóöüß', 'ABCDEFGHIJK')"


A_COLS = "a.a_id, a.title, a.year, a.rating_a, a.votes, a.genre_list"
B_COLS = "b.b_id, b.b_norm, b.c_norm, b.score_b, b.n_reviews, b.status"


def link_cte(left: str, right: str) -> str:
    return f"""
WITH a AS (SELECT * EXCLUDE (year_text), {YEAR_SQL} AS year, {clean_title_sql('title')} AS title_clean
           FROM ({left}) l WHERE {YEAR_SQL} IS NOT NULL AND rating_a IS NOT NULL),
b AS (SELECT *, CAST(regexp_extract(release_date, '^(\\d+)-', 1) AS integer) AS release_year,
             {clean_title_sql('title')} AS title_clean, score_b / 10.0 AS b_norm, score_c / 10.0 AS c_norm
      FROM ({right}) r WHERE score_b IS NOT NULL AND title IS NOT NULL),
ex AS (SELECT {A_COLS}, a.title_clean, {B_COLS}, 'exact' AS match_type
       FROM a JOIN b ON a.title_clean = b.title_clean AND a.year = b.release_year),
u AS (SELECT * FROM a WHERE NOT EXISTS (SELECT 1 FROM ex WHERE ex.title_clean = a.title_clean)),
uk AS (SELECT DISTINCT title_clean AS a_t, year AS blk FROM u WHERE title_clean <> ''),
bk AS (SELECT title_clean AS b_t, release_year AS blk, min(b_id) AS b_ord FROM b WHERE title_clean <> '' GROUP BY 1, 2),
pairs AS (SELECT uk.a_t, uk.blk, bk.b_t, bk.b_ord,
                 round(1 - jaro_similarity({one_byte_sql('uk.a_t')}, {one_byte_sql('bk.b_t')}), 12) AS dist
          FROM uk JOIN bk ON uk.blk = bk.blk),
best AS (SELECT a_t, blk, b_t, b_ord, dist FROM (
           SELECT *, row_number() OVER (PARTITION BY a_t, blk ORDER BY dist, b_ord) AS rn
           FROM pairs WHERE dist < 0.12) w WHERE rn = 1),
fz AS (SELECT {A_COLS.replace('a.', 'u.')}, CAST(NULL AS varchar) AS title_clean, {B_COLS}, 'fuzzy' AS match_type
       FROM u JOIN best ON u.title_clean = best.a_t AND u.year = best.blk
              JOIN b ON b.title_clean = best.b_t AND b.release_year = best.blk AND b.b_id = best.b_ord),
linked AS (SELECT * FROM ex UNION ALL SELECT * FROM fz)
"""


DERIVED_SQL = """, d0 AS (
SELECT *, rating_a - b_norm AS rating_diff, abs(rating_a - b_norm) AS abs_diff,
  trim(split_part(genre_list, ',', 1)) AS primary_genre,
  CAST(floor(year / 10) * 10 AS integer) AS decade,
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
FROM linked) """
LINK_CTE = link_cte(fx.L_LEFT_SQL, fx.L_RIGHT_SQL)
RUN_CTE = link_cte(fx.unique_sql(fx.L_LEFT_SQL, "a_id"),
                   fx.unique_sql(fx.L_RIGHT_SQL, "b_id")) + DERIVED_SQL


def fp(sql_tail: str) -> str:
    """SQL over the prepared facts view ``fp``."""
    return f"WITH fp AS ({FP_SQL}) {sql_tail}"


def ld(sql_tail: str) -> str:
    """SQL over the derived linked view ``d0`` of adapter L."""
    return f"{LINK_CTE}{DERIVED_SQL} {sql_tail}"


def rd(sql_tail: str) -> str:
    """SQL over the linked table of the whole run (``d0``, under the name ``fp`` too)."""
    return f"{RUN_CTE}, fp AS (SELECT * FROM d0) {sql_tail}"


CATALOG: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {}


def register(name: str, sql: str | None):
    def deco(fn):
        CATALOG[name] = (fn, sql)
        return fn
    return deco


# ============================================================== S: sources
@register("ingest_profile", f"""
SELECT CAST(count(*) AS BIGINT) AS n_rows,
       CAST(sum((l_orderkey IS NULL)::int + (l_linenumber IS NULL)::int + (title IS NULL)::int
           + (year_text IS NULL)::int + (release_date IS NULL)::int + (genre_list IS NULL)::int
           + (rating_a IS NULL OR isnan(rating_a))::int + (score_b IS NULL OR isnan(score_b))::int
           + (score_c IS NULL OR isnan(score_c))::int + (n_reviews IS NULL)::int
           + (status IS NULL)::int + (votes IS NULL OR isnan(votes))::int) AS BIGINT) AS n_missing
FROM ({F_RAW_SQL}) f""")
def q_ingest_profile(spark, d):
    return Q.ingest_profile(facts_raw(spark, d))


# ============================================================== C: cleaning
@register("tolerant_int", f"""
SELECT l_orderkey, l_linenumber, year_text, {YEAR_SQL} AS year FROM ({F_RAW_SQL}) f""")
def q_tolerant_int(spark, d):
    return facts_raw(spark, d).select(*KEYS, "year_text", S.tolerant_int("year_text").alias("year"))


@register("normalize_title", f"SELECT doc_id, {clean_title_sql('text')} AS title_clean FROM documents")
def q_normalize_title(spark, d):
    docs = spark.read.parquet(f"{d}/documents.parquet")
    return docs.select("doc_id", S.normalize_title("text").alias("title_clean"))


@register("clean_a", f"SELECT * FROM ({FP_BASE_SQL}) c")
def q_clean_a(spark, d):
    return C.clean_a(facts_raw(spark, d))


@register("clean_b", f"""
SELECT *, CAST(year(release_date) AS INTEGER) AS release_year, lower(trim(title)) AS title_clean
FROM ({F_RAW_SQL}) f WHERE NOT (score_c IS NULL OR isnan(score_c)) AND title IS NOT NULL""")
def q_clean_b(spark, d):
    return C.clean_b(facts_raw(spark, d), score="score_c")


@register("release_year", f"""
SELECT l_orderkey, l_linenumber, CAST(year(release_date) AS INTEGER) AS release_year FROM ({F_RAW_SQL}) f""")
def q_release_year(spark, d):
    return facts_raw(spark, d).select(*KEYS, S.release_year("release_date").alias("release_year"))


@register("cleaning_report", f"""
SELECT 'a' AS source, CAST(count(*) AS BIGINT) AS rows_before,
       CAST(count_if({YEAR_SQL} IS NOT NULL AND NOT (rating_a IS NULL OR isnan(rating_a))) AS BIGINT) AS rows_after,
       CAST(count(*) - count_if({YEAR_SQL} IS NOT NULL AND NOT (rating_a IS NULL OR isnan(rating_a))) AS BIGINT) AS rows_removed
FROM ({F_RAW_SQL}) f
UNION ALL
SELECT 'b', CAST(count(*) AS BIGINT),
       CAST(count_if(NOT (score_c IS NULL OR isnan(score_c)) AND title IS NOT NULL) AS BIGINT),
       CAST(count(*) - count_if(NOT (score_c IS NULL OR isnan(score_c)) AND title IS NOT NULL) AS BIGINT)
FROM ({F_RAW_SQL}) f""")
def q_cleaning_report(spark, d):
    raw = facts_raw(spark, d)
    return (C.cleaning_report(raw, C.keep_condition_a(), "a")
            .unionByName(C.cleaning_report(raw, C.keep_condition_b("score_c"), "b")))


@register("rescale", f"""
SELECT l_orderkey, l_linenumber, score_b / 10.0 AS b_norm, score_c / 10.0 AS c_norm FROM ({F_RAW_SQL}) f""")
def q_rescale(spark, d):
    return facts_raw(spark, d).select(*KEYS, S.rescale("score_b").alias("b_norm"),
                                      S.rescale("score_c").alias("c_norm"))


# ============================================================== J: linkage
# Exact stage on whole texts (adapter T); both stages on whole page titles (adapter L).
TEXT_CTE = f"""
WITH a AS (SELECT *, {clean_title_sql('title')} AS title_clean FROM ({fx.T_LEFT_SQL}) l),
b AS (SELECT * EXCLUDE (title), {clean_title_sql('title')} AS title_clean FROM ({fx.T_RIGHT_SQL}) r)"""


@register("exact_link", TEXT_CTE + """
SELECT a.a_id, a.title, a.block, a.source, a.title_clean, b.b_id, b.n_chars, 'exact' AS match_type
FROM a JOIN b ON a.title_clean = b.title_clean AND a.block = b.block""")
def q_exact_link(spark, d):
    a, b = t_sides(spark, d)
    return J.exact_link(a, b.drop("title"), "block", "block")


@register("unmatched", TEXT_CTE + """
SELECT * FROM a WHERE title_clean IS NULL OR title_clean NOT IN (
  SELECT a.title_clean FROM a JOIN b ON a.title_clean = b.title_clean AND a.block = b.block)""")
def q_unmatched(spark, d):
    return J.unmatched(*t_sides(spark, d), "block", "block")


@register("exact_link_titles", LINK_CTE + " SELECT * FROM ex")
def q_exact_link_titles(spark, d):
    return l_link(spark, d).exact


@register("fuzzy_pairs", LINK_CTE + " SELECT a_t, blk, b_t, b_ord, dist FROM pairs WHERE dist < 0.12")
def q_fuzzy_pairs(spark, d):
    """J3 + J4: every same-block pair under the threshold, with its Jaro distance.
    The Spark side prunes with the lossless bounds first, so equality with the
    unpruned SQL also checks that no pair was lost."""
    return l_link(spark, d).close


@register("best_match", LINK_CTE + " SELECT * FROM best")
def q_best_match(spark, d):
    return l_link(spark, d).best


@register("fuzzy_link", LINK_CTE + " SELECT * EXCLUDE (title_clean) FROM fz")
def q_fuzzy_link(spark, d):
    return l_link(spark, d).fuzzy


@register("link", LINK_CTE + " SELECT * FROM linked")
def q_link(spark, d):
    return l_link(spark, d).linked


@register("link_report", LINK_CTE + """
SELECT CAST(count_if(match_type = 'exact') AS BIGINT) AS n_exact,
       CAST(count_if(match_type = 'fuzzy') AS BIGINT) AS n_fuzzy,
       CAST(count(*) AS BIGINT) AS n_total, avg(rating_a) AS avg_rating_a, avg(b_norm) AS avg_b_norm
FROM linked""")
def q_link_report(spark, d):
    return J.link_report(l_link(spark, d).linked)


@register("unlinked", LINK_CTE + """
SELECT * FROM u WHERE NOT EXISTS (SELECT 1 FROM best WHERE best.a_t = u.title_clean AND best.blk = u.year)""")
def q_unlinked(spark, d):
    return l_link(spark, d).unlinked


# ============================================================== D: derived columns (F)
@register("derive", fp("""
SELECT l_orderkey, l_linenumber, b_norm, c_norm, rating_diff, abs_diff, primary_genre, decade,
       low_count, vote_bucket, vote_bucket_ord, votes_log10 FROM fp"""))
def q_derive(spark, d):
    return facts_prepared(spark, d).select(
        *KEYS, "b_norm", "c_norm", "rating_diff", "abs_diff", "primary_genre", "decade", "low_count",
        "vote_bucket", "vote_bucket_ord", "votes_log10")


CORR_BY_DECADE_SQL = """
corr_w AS (SELECT decade,
  corr(rating_a, b_norm) AS r0, CAST(regr_count(b_norm, rating_a) AS BIGINT) AS n0,
  corr(rating_a, c_norm) AS r1, CAST(regr_count(c_norm, rating_a) AS BIGINT) AS n1,
  corr(b_norm, c_norm) AS r2, CAST(regr_count(c_norm, b_norm) AS BIGINT) AS n2
  FROM fp GROUP BY decade),
corr_l AS (SELECT decade, 'rating_a' AS x, 'b_norm' AS y, r0 AS r, n0 AS n FROM corr_w
  UNION ALL SELECT decade, 'rating_a', 'c_norm', r1, n1 FROM corr_w
  UNION ALL SELECT decade, 'b_norm', 'c_norm', r2, n2 FROM corr_w)"""

CORR_COLS_SQL = """
  CASE WHEN n > 3 AND r IS NOT NULL AND abs(r) < 1 THEN tanh(atanh(r) - 1.959963984540054 / sqrt(n - 3.0)) END AS ci_lo,
  CASE WHEN n > 3 AND r IS NOT NULL AND abs(r) < 1 THEN tanh(atanh(r) + 1.959963984540054 / sqrt(n - 3.0)) END AS ci_hi,
  CASE WHEN n > 2 THEN n - 2 END AS df,
  CASE WHEN n > 2 AND abs(r) < 1 THEN r * sqrt((n - 2.0) / (1 - r * r)) END AS t"""


@register("corr_label", fp(f""", {CORR_BY_DECADE_SQL.strip()}
SELECT decade, x, y, r,
  CASE WHEN r IS NULL OR isnan(r) THEN 'correlation not computable'
       WHEN abs(r) < 0.2 THEN 'very weak correlation' WHEN abs(r) < 0.4 THEN 'weak correlation'
       WHEN abs(r) < 0.6 THEN 'moderate correlation' WHEN abs(r) < 0.8 THEN 'strong correlation'
       ELSE 'very strong correlation' END AS label
FROM corr_l"""))
def q_corr_label(spark, d):
    c = A.correlations(facts_prepared(spark, d), by=["decade"], with_p=False)
    return c.select("decade", "x", "y", "r", S.corr_label("r").alias("label"))


@register("format_ci", fp(f""", {CORR_BY_DECADE_SQL.strip()}
SELECT decade, x, y, CASE WHEN ci_lo IS NOT NULL THEN printf('[%.3f, %.3f]', ci_lo, ci_hi) END AS ci_text
FROM (SELECT *, {CORR_COLS_SQL} FROM corr_l) c"""))
def q_format_ci(spark, d):
    c = A.correlations(facts_prepared(spark, d), by=["decade"], with_p=False)
    return c.select("decade", "x", "y",
                    F.when(F.col("ci_lo").isNotNull(), S.fmt_ci("ci_lo", "ci_hi")).alias("ci_text"))


@register("round_numeric", fp("""
SELECT primary_genre, round_even(avg(rating_a), 2) AS avg_a, round_even(avg(b_norm), 2) AS avg_b,
       round_even(avg(c_norm), 2) AS avg_c, round_even(avg(rating_diff), 2) AS avg_diff,
       CAST(count(*) AS BIGINT) AS count
FROM fp GROUP BY primary_genre HAVING count(*) >= 5"""))
def q_round_numeric(spark, d):
    return S.round_numeric(A.genre_stats(facts_prepared(spark, d)), 2)


NUM_TXT = ("regexp_replace(regexp_replace(CAST(CAST(round_even(CAST({x} AS DOUBLE), 2) AS DECIMAL(38, 2)) AS VARCHAR), "
           "'(\\.\\d*?)0+$', '\\1'), '\\.$', '')")


def _num_sql(x: str) -> str:
    return NUM_TXT.format(x=x)


@register("point_label", fp(f"""
SELECT l_orderkey, l_linenumber, {_num_sql('votes')} AS votes_plain, {_num_sql('n_reviews / 8')} AS eighths,
  title || ' (' || CAST(year AS VARCHAR) || ')' || ' / a: ' || {_num_sql('rating_a')}
    || ' / b: ' || {_num_sql('b_norm')} || ' / diff: ' || {_num_sql('rating_diff')} AS label,
  format('{{:,}}', CAST(round_even(votes, 0) AS BIGINT)) AS votes_text
FROM fp"""))
def q_point_label(spark, d):
    df = facts_prepared(spark, d)
    lab = S.point_label("title", "year", [("a", "rating_a"), ("b", "b_norm"), ("diff", "rating_diff")])
    return df.select(*KEYS, S.num_text("votes").alias("votes_plain"), S.num_text(F.col("n_reviews") / 8).alias("eighths"),
                     lab.alias("label"), S.thousands("votes").alias("votes_text"))


# ============================================================== Q: quality
@register("quality_report", fp("""
SELECT CAST(count_if(rating_a IS NULL OR isnan(rating_a)) AS BIGINT) AS null_rating_a,
       CAST(count_if(b_norm IS NULL OR isnan(b_norm)) AS BIGINT) AS null_b_norm,
       CAST(count(*) - count(DISTINCT struct_pack(title, year)) AS BIGINT) AS duplicates,
       min(rating_a) AS min_rating_a, max(rating_a) AS max_rating_a,
       min(b_norm) AS min_b_norm, max(b_norm) AS max_b_norm,
       CAST(count_if(low_count) AS BIGINT) AS n_low_count
FROM fp"""))
def q_quality_report(spark, d):
    return Q.quality_report(facts_prepared(spark, d))


MISSING_SQL = """
SELECT 'rating_a' AS variable, CAST(count_if(rating_a IS NULL OR isnan(rating_a)) AS BIGINT) AS n_missing FROM fp
UNION ALL SELECT 'b_norm', CAST(count_if(b_norm IS NULL OR isnan(b_norm)) AS BIGINT) FROM fp
UNION ALL SELECT 'c_norm', CAST(count_if(c_norm IS NULL OR isnan(c_norm)) AS BIGINT) FROM fp
UNION ALL SELECT 'n_reviews', CAST(count_if(n_reviews IS NULL) AS BIGINT) FROM fp
UNION ALL SELECT 'votes', CAST(count_if(votes IS NULL OR isnan(votes)) AS BIGINT) FROM fp
UNION ALL SELECT 'primary_genre', CAST(count_if(primary_genre IS NULL) AS BIGINT) FROM fp
UNION ALL SELECT 'year', CAST(count_if(year IS NULL) AS BIGINT) FROM fp"""


@register("missing_by_column", fp(MISSING_SQL))
def q_missing_by_column(spark, d):
    return Q.missing_by_column(facts_prepared(spark, d))


@register("missing_total", fp("""
SELECT CAST(sum((rating_a IS NULL OR isnan(rating_a))::int + (b_norm IS NULL OR isnan(b_norm))::int
  + (c_norm IS NULL OR isnan(c_norm))::int + (n_reviews IS NULL)::int
  + (votes IS NULL OR isnan(votes))::int) AS BIGINT) AS n_missing FROM fp"""))
def q_missing_total(spark, d):
    return Q.missing_total(facts_prepared(spark, d))


@register("duplicate_count", fp("""
SELECT CAST(count(*) - count(DISTINCT coalesce(title, 'NA') || ' ' || coalesce(CAST(year AS VARCHAR), 'NA'))
            AS BIGINT) AS duplicates FROM fp"""))
def q_duplicate_count(spark, d):
    return Q.duplicate_count(facts_prepared(spark, d))


@register("match_type_counts", ld("SELECT match_type, CAST(count(*) AS BIGINT) AS n FROM d0 GROUP BY 1"))
def q_match_type_counts(spark, d):
    return Q.match_type_counts(l_data(spark, d))


@register("match_type_number", ld("""
SELECT CAST(count(DISTINCT coalesce(match_type, '<NULL>')) AS BIGINT) AS n_match_types FROM d0"""))
def q_match_type_number(spark, d):
    return Q.match_type_number(l_data(spark, d))


@register("qa_metrics", fp("""
, m AS (SELECT CAST(count(*) AS double) AS rows,
  CAST(count_if(rating_a IS NULL OR isnan(rating_a)) AS double) AS missing_rating_a,
  CAST(count_if(b_norm IS NULL OR isnan(b_norm)) AS double) AS missing_b_norm,
  CAST(count_if(c_norm IS NULL OR isnan(c_norm)) AS double) AS missing_c_norm,
  CAST(count(*) - count(DISTINCT coalesce(title, 'NA') || ' ' || coalesce(CAST(year AS VARCHAR), 'NA')) AS double) AS duplicates,
  round_even(min(rating_a), 2) AS rating_a_min, round_even(max(rating_a), 2) AS rating_a_max,
  round_even(min(b_norm), 2) AS b_norm_min, round_even(max(b_norm), 2) AS b_norm_max,
  CAST(count_if(low_count) AS double) AS n_low_count,
  CAST(count(DISTINCT primary_genre) AS double) AS distinct_genres FROM fp)
SELECT metric, value FROM m UNPIVOT (value FOR metric IN (rows, missing_rating_a, missing_b_norm,
  missing_c_norm, duplicates, rating_a_min, rating_a_max, b_norm_min, b_norm_max, n_low_count,
  distinct_genres))"""))
def q_qa_metrics(spark, d):
    return Q.qa_metrics(facts_prepared(spark, d))


# ============================================================== A: statistics (F)
@register("correlations", fp(f"""
, w AS (SELECT corr(rating_a, b_norm) AS r0, CAST(regr_count(b_norm, rating_a) AS BIGINT) AS n0,
  corr(rating_a, c_norm) AS r1, CAST(regr_count(c_norm, rating_a) AS BIGINT) AS n1,
  corr(b_norm, c_norm) AS r2, CAST(regr_count(c_norm, b_norm) AS BIGINT) AS n2 FROM fp),
l AS (SELECT 'rating_a' AS x, 'b_norm' AS y, r0 AS r, n0 AS n FROM w
  UNION ALL SELECT 'rating_a', 'c_norm', r1, n1 FROM w UNION ALL SELECT 'b_norm', 'c_norm', r2, n2 FROM w)
SELECT x, y, r, n, {CORR_COLS_SQL} FROM l"""))
def q_correlations(spark, d):
    return A.correlations(facts_prepared(spark, d), with_p=False)


@register("correlations_by_decade", fp(f""", {CORR_BY_DECADE_SQL.strip()}
SELECT decade, x, y, r, n, {CORR_COLS_SQL} FROM corr_l"""))
def q_correlations_by_decade(spark, d):
    return A.correlations(facts_prepared(spark, d), by=["decade"], with_p=False)


def p_sql(t: str, df: str) -> str:
    """Two-sided p of a t value: Simpson's rule on the density over 0 .. |t| (40 at most)."""
    n = 2000
    top = f"(CASE WHEN {t} IS NOT NULL THEN least(abs({t}), 40.0) END)"
    dens = (f"exp(lgamma(({df} + 1) / 2.0) - lgamma({df} / 2.0)) / sqrt({df} * pi()) "
            f"* pow(1 + pow({top} * i / {n}, 2) / {df}, -({df} + 1) / 2.0)")
    weight = f"CASE WHEN i = 0 OR i = {n} THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END"
    return (f"(1 - 2 * {top} / {n} / 3 * list_sum(list_transform(range({n + 1}), "
            f"lambda i: ({weight}) * {dens})))")


P_TEXT_SQL = "CASE WHEN p_value < 0.001 THEN '< 0.001' WHEN p_value IS NOT NULL THEN printf('%.3f', p_value) END"
# Pairs with p far from 0 (independent columns) and one with p near 0.
P_PAIRS = (("rating_a", "n_reviews"), ("c_norm", "n_reviews"), ("n_reviews", "votes_log10"), ("rating_a", "b_norm"))


@register("corr_pvalues", fp(", w AS (" + " UNION ALL ".join(
    f"SELECT decade, '{x}' AS x, '{y}' AS y, "
    f"CASE WHEN regr_sxx({y}, {x}) > 0 AND regr_syy({y}, {x}) > 0 THEN corr({x}, {y}) END AS r, CAST(regr_count({y}, {x}) AS BIGINT) AS n FROM fp GROUP BY decade"
    for x, y in P_PAIRS) + f"""),
p AS (SELECT *, {p_sql('t', 'df')} AS p_value FROM (SELECT *, {CORR_COLS_SQL} FROM w) c)
SELECT decade, x, y, r, n, p_value, {P_TEXT_SQL} AS p_text FROM p"""))
def q_corr_pvalues(spark, d):
    """Two-sided p of r (t distribution, native expression) by decade."""
    return A.correlations(facts_prepared(spark, d), P_PAIRS, by=["decade"]).select(
        "decade", "x", "y", "r", "n", "p_value", S.fmt_p("p_value").alias("p_text"))


@register("ttest", fp("""
SELECT avg(rating_diff) AS mean, stddev_samp(rating_diff) AS sd, CAST(count(rating_diff) AS BIGINT) AS n,
  stddev_samp(rating_diff) / sqrt(count(rating_diff)) AS se,
  CASE WHEN count(rating_diff) > 1 THEN CAST(count(rating_diff) - 1 AS BIGINT) END AS df,
  avg(rating_diff) / (stddev_samp(rating_diff) / sqrt(count(rating_diff))) AS t FROM fp"""))
def q_ttest(spark, d):
    return A.ttest_1samp(facts_prepared(spark, d), "rating_diff", with_p=False)


# The t test per genre of column v, with p and the 95 % interval of the mean; the quantile by
# bisection of p(q) = 0.05.
def ttest_sql(col: str, group: str) -> str:
    return f"""
, g AS (SELECT {group}, avg({col}) AS mean, stddev_samp({col}) AS sd, CAST(count({col}) AS BIGINT) AS n,
               stddev_samp({col}) / sqrt(count({col})) AS se,
               CASE WHEN count({col}) > 1 THEN CAST(count({col}) - 1 AS BIGINT) END AS df FROM fp GROUP BY {group}),
dfs AS (SELECT DISTINCT CAST(df AS double) AS v FROM g WHERE df > 2),
bis(v, k, lo, hi) AS (
  SELECT v, 0, CAST(0 AS double), CAST(8 AS double) FROM dfs
  UNION ALL
  SELECT v, k + 1, CASE WHEN {p_sql('((lo + hi) / 2)', 'v')} > 0.05 THEN (lo + hi) / 2 ELSE lo END,
         CASE WHEN {p_sql('((lo + hi) / 2)', 'v')} > 0.05 THEN hi ELSE (lo + hi) / 2 END
  FROM bis WHERE k < 40)
SELECT {group}, mean, sd, n, se, df, mean / nullif(se, 0) AS t, {p_sql('(mean / nullif(se, 0))', 'df')} AS p_value,
       mean - (lo + hi) / 2 * se AS ci_lo, mean + (lo + hi) / 2 * se AS ci_hi
FROM g LEFT JOIN bis ON k = 40 AND v = df"""


@register("ttest_by_genre_pvalue", fp(ttest_sql("rating_diff", "primary_genre")).replace("WITH fp", "WITH RECURSIVE fp", 1))
def q_ttest_pvalue(spark, d):
    """t-test per genre with p and CI of the mean (t distribution)."""
    return A.ttest_1samp(facts_prepared(spark, d), "rating_diff", by=["primary_genre"])


@register("cohens_d", fp("SELECT avg(rating_diff) / stddev_samp(rating_diff) AS cohens_d FROM fp"))
def q_cohens_d(spark, d):
    return A.cohens_d(facts_prepared(spark, d))


GENRE_SQL = """
SELECT primary_genre, avg(rating_a) AS avg_a, avg(b_norm) AS avg_b, avg(c_norm) AS avg_c,
       avg(rating_diff) AS avg_diff, CAST(count(*) AS BIGINT) AS count
FROM fp GROUP BY primary_genre HAVING count(*) >= {n}"""
DECADE_SQL = """
SELECT decade, avg(rating_a) AS avg_a, avg(b_norm) AS avg_b, CAST(count(*) AS BIGINT) AS count
FROM fp GROUP BY decade HAVING count(*) >= {n}"""


@register("genre_stats", fp(GENRE_SQL.format(n=5)))
def q_genre_stats(spark, d):
    return A.genre_stats(facts_prepared(spark, d))


@register("genre_stats_min9800", fp(GENRE_SQL.format(n=9800)))
def q_genre_stats_9800(spark, d):
    return A.genre_stats(facts_prepared(spark, d), min_n=9800)


@register("decade_stats", fp(DECADE_SQL.format(n=48)))
def q_decade_stats(spark, d):
    return A.decade_stats(facts_prepared(spark, d))


@register("decade_stats_min5000", fp(DECADE_SQL.format(n=5000)))
def q_decade_stats_5000(spark, d):
    return A.decade_stats(facts_prepared(spark, d), min_n=5000)


@register("vote_stats", fp("""
SELECT vote_bucket, vote_bucket_ord, avg(rating_a) AS avg_a, avg(rating_diff) AS avg_diff,
       CAST(count(*) AS BIGINT) AS count FROM fp GROUP BY 1, 2"""))
def q_vote_stats(spark, d):
    return A.vote_stats(facts_prepared(spark, d))


@register("status_stats", fp("""
SELECT status, avg(rating_a) AS avg_a, avg(rating_diff) AS avg_diff, CAST(count(*) AS BIGINT) AS count
FROM fp GROUP BY 1"""))
def q_status_stats(spark, d):
    return A.status_stats(facts_prepared(spark, d))


@register("overall_summary", fp("""
SELECT CAST(count(*) AS BIGINT) AS n_total, avg(rating_diff) AS avg_diff, avg(rating_a) AS avg_a,
       avg(b_norm) AS avg_b, CAST(count_if(low_count) AS BIGINT) AS n_low_count,
       min(rating_a) AS min_a, max(rating_a) AS max_a FROM fp"""))
def q_overall_summary(spark, d):
    return A.overall_summary(facts_prepared(spark, d))


@register("share_at_least", fp("SELECT avg(CAST(b_norm >= 9 AS double)) AS share FROM fp"))
def q_share_at_least(spark, d):
    return A.share_at_least(facts_prepared(spark, d), "b_norm", 9.0)


@register("median_reviews", fp("""
SELECT quantile_cont(CAST(n_reviews AS double), 0.5) AS median,
       round_even(quantile_cont(CAST(n_reviews AS double), 0.5), 0) AS median_display FROM fp"""))
def q_median_reviews(spark, d):
    return A.median_of(facts_prepared(spark, d), "n_reviews")


@register("count_certified", fp("SELECT CAST(count_if(status = 'certified') AS BIGINT) AS n FROM fp"))
def q_count_certified(spark, d):
    return A.count_where(facts_prepared(spark, d), F.col("status") == "certified")


@register("pair_mean_diffs", fp("""
SELECT 'rating_a' AS x, 'b_norm' AS y, avg(rating_a - b_norm) AS mean_diff FROM fp
UNION ALL SELECT 'rating_a', 'c_norm', avg(rating_a - c_norm) FROM fp
UNION ALL SELECT 'b_norm', 'c_norm', avg(b_norm - c_norm) FROM fp"""))
def q_pair_mean_diffs(spark, d):
    return A.pair_mean_diffs(facts_prepared(spark, d))


@register("status_share", fp("SELECT avg(CAST(coalesce(status = 'certified', false) AS double)) AS share FROM fp"))
def q_status_share(spark, d):
    return A.status_share(facts_prepared(spark, d), "certified")


@register("spread_ratio", fp("""
SELECT max(b_norm) - min(b_norm) AS spread_num, max(rating_a) - min(rating_a) AS spread_den,
       (max(b_norm) - min(b_norm)) / nullif(max(rating_a) - min(rating_a), 0) AS spread_ratio FROM fp"""))
def q_spread_ratio(spark, d):
    return A.spread_ratio(facts_prepared(spark, d))


# ============================================================== K: top-k and tables (F)
TOP_SQL = """
SELECT title, year, rating_a, b_norm, rating_diff FROM (
  SELECT *, rank() OVER (ORDER BY rating_diff {dir}) AS rk FROM fp WHERE rating_diff IS NOT NULL) t
WHERE rk <= 5"""


@register("top5_largest", fp(TOP_SQL.format(dir="DESC")))
def q_top5_largest(spark, d):
    return K.top_k(facts_prepared(spark, d), "rating_diff", 5, largest=True)


@register("top5_smallest", fp(TOP_SQL.format(dir="ASC")))
def q_top5_smallest(spark, d):
    return K.top_k(facts_prepared(spark, d), "rating_diff", 5, largest=False)


@register("top_table", fp("""
SELECT title AS "Title", year AS "Year", round_even(rating_a, 2) AS "Rating A",
       round_even(b_norm, 2) AS "Score B", round_even(rating_diff, 2) AS "Difference" FROM (
  SELECT *, rank() OVER (ORDER BY rating_diff DESC) AS rk FROM fp WHERE rating_diff IS NOT NULL) t
WHERE rk <= 5"""))
def q_top_table(spark, d):
    return K.top_table(facts_prepared(spark, d), "rating_diff", 5, True)


@register("low_review_table", fp("""
SELECT title AS "Title", year AS "Year", round_even(rating_a, 2) AS "Rating A",
       round_even(score_b, 2) AS "Score B (%)", n_reviews AS "Reviews",
       round_even(rating_diff, 2) AS "Difference" FROM fp WHERE low_count"""))
def q_low_review_table(spark, d):
    return K.low_review_table(facts_prepared(spark, d))


@register("bucket_table", fp("""
SELECT vote_bucket AS "Vote bucket", round_even(avg(rating_a), 3) AS "Mean A",
       round_even(avg(rating_diff), 3) AS "Mean difference", CAST(count(*) AS BIGINT) AS "Count"
FROM fp GROUP BY vote_bucket, vote_bucket_ord"""))
def q_bucket_table(spark, d):
    return K.bucket_table(A.vote_stats(facts_prepared(spark, d)))


@register("full_table", fp("""
SELECT title AS "Title", year AS "Year", primary_genre AS "Genre", round_even(rating_a, 2) AS "Rating A",
       round_even(b_norm, 2) AS "Score B", round_even(c_norm, 2) AS "Score C",
       round_even(rating_diff, 2) AS "Difference", round_even(abs_diff, 2) AS "|Difference|",
       n_reviews AS "Reviews", status AS "Status", round_even(votes, 2) AS "Votes" FROM fp"""))
def q_full_table(spark, d):
    return K.full_table(facts_prepared(spark, d))


BROWSE_KEYS = ["l_orderkey", "l_linenumber"]
BROWSE = dict(filters={"Year": ("range", (1960, 1990)), "Status": ("in", ["fresh", "rotten"]), "Title": ("contains", "RE")},
              search="1.5", order_by=["Difference"], tie_break=BROWSE_KEYS, size=15, hidden=BROWSE_KEYS)
SHOWN_SQL = {"Title": '"Title"', "Year": 'CAST("Year" AS VARCHAR)', "Genre": '"Genre"', "Status": '"Status"',
             "Reviews": 'CAST("Reviews" AS VARCHAR)'} | {
    c: _num_sql(f'"{c}"') for c in ("Rating A", "Score B", "Score C", "Difference", "|Difference|", "Votes")}
# (the facts are materialised in the SQL: DuckDB fails on dictionary columns otherwise)
BROWSE_SQL = f"""
SELECT * FROM (
  SELECT l_orderkey, l_linenumber, title AS "Title", year AS "Year", primary_genre AS "Genre", round_even(rating_a, 2) AS "Rating A",
       round_even(b_norm, 2) AS "Score B", round_even(c_norm, 2) AS "Score C",
       round_even(rating_diff, 2) AS "Difference", round_even(abs_diff, 2) AS "|Difference|",
       n_reviews AS "Reviews", status AS "Status", round_even(votes, 2) AS "Votes" FROM fp) s
WHERE "Year" BETWEEN 1960 AND 1990 AND "Status" IN ('fresh', 'rotten') AND contains(lower("Title"), 're')
  AND ({" OR ".join(f"coalesce(contains(lower({x}), '1.5'), false)" for x in SHOWN_SQL.values())})"""


@register("browse", fp(f"""SELECT * EXCLUDE (l_orderkey, l_linenumber) FROM ({BROWSE_SQL}) t
ORDER BY "Difference" ASC NULLS FIRST, l_orderkey, l_linenumber LIMIT 15 OFFSET 30""").replace("fp AS (", "fp AS MATERIALIZED (", 1))
def q_browse(spark, d):
    return K.browse(K.full_table(facts_prepared(spark, d), keys=BROWSE_KEYS), page=3, **BROWSE)


@register("browse_after", fp(f"""SELECT * EXCLUDE (l_orderkey, l_linenumber) FROM ({BROWSE_SQL}) t
WHERE "Difference" > 1.5 OR ("Difference" = 1.5 AND (l_orderkey > 1000 OR (l_orderkey = 1000 AND l_linenumber > 2)))
ORDER BY "Difference" ASC NULLS FIRST, l_orderkey, l_linenumber LIMIT 15""").replace("fp AS (", "fp AS MATERIALIZED (", 1))
def q_browse_after(spark, d):
    """The page behind a given last row (seek paging)."""
    return K.browse(K.full_table(facts_prepared(spark, d), keys=BROWSE_KEYS), after=[1.5, 1000, 2], **BROWSE)


# (all columns as sort keys: order and line repeat in these tables, and equal rows may stand in any order)
PAGE_SORT = ["Difference", *BROWSE_KEYS, "Title", "Votes", "Score B", "Score C", "Rating A"]
PAGE_SQL_ORDER = ", ".join(f'"{c}" ASC NULLS FIRST' for c in PAGE_SORT)
FULL_SQL = BROWSE_SQL.split("WHERE \"Year\" BETWEEN")[0]


def _directory(spark: SparkSession, d: str) -> P.PageDirectory:
    return P.PageDirectory(K.full_table(facts_prepared(spark, d), keys=BROWSE_KEYS), PAGE_SORT, hidden=BROWSE_KEYS)


@register("browse_deep", fp(f"""SELECT * EXCLUDE (l_orderkey, l_linenumber) FROM ({FULL_SQL}) t
ORDER BY {PAGE_SQL_ORDER} LIMIT 15 OFFSET 29985""").replace("fp AS (", "fp AS MATERIALIZED (", 1))
def q_browse_deep(spark, d):
    """Page 2,000 from the page directory."""
    with _directory(spark, d) as pages:
        return cut_lineage(pages.page(2000))


@register("browse_search", fp(f"""SELECT * EXCLUDE (l_orderkey, l_linenumber) FROM ({FULL_SQL}) t
WHERE {" OR ".join(f"coalesce(contains(lower({x}), '2.5'), false)" for x in SHOWN_SQL.values())}
ORDER BY {PAGE_SQL_ORDER} LIMIT 15 OFFSET 15""").replace("fp AS (", "fp AS MATERIALIZED (", 1))
def q_browse_search(spark, d):
    """The second page of a search through the trigram postings."""
    with _directory(spark, d) as pages:
        return cut_lineage(pages.search("2.5", page=2))


@register("genre_choices", fp(GENRE_SQL.format(n=5).replace(
    "SELECT primary_genre, avg(rating_a)", "SELECT DISTINCT primary_genre FROM (SELECT primary_genre, avg(rating_a)")
    + ") g WHERE primary_genre IS NOT NULL"))
def q_genre_choices(spark, d):
    return K.choices(A.genre_stats(facts_prepared(spark, d)))


GENRE_PICK = ["PROMO", "STANDARD", "no such genre"]


@register("genre_filter", fp(f"""
SELECT * FROM ({GENRE_SQL.format(n=5)}) g
WHERE primary_genre IN ('PROMO', 'STANDARD', 'no such genre')"""))
def q_genre_filter(spark, d):
    return K.filter_in(A.genre_stats(facts_prepared(spark, d)), "primary_genre", GENRE_PICK)


# ============================================================== G: chart data (F)
HIST_SQL = """
, h AS (SELECT CAST(least(greatest(ceil(({col} - 0.0) / (10.0 / 14) - 0.5), 0), 14) AS BIGINT) AS bin,
               count(*) AS n
        FROM fp WHERE {col} IS NOT NULL AND NOT isnan({col}) AND {col} >= 0 AND {col} <= 10 GROUP BY 1)
SELECT g.bin, 0.0 + g.bin * (10.0 / 14) AS center, CAST(coalesce(h.n, 0) AS BIGINT) AS count,
       (SELECT avg({col}) FROM fp WHERE NOT isnan({col})) AS mean
FROM (SELECT range AS bin FROM range(15)) g LEFT JOIN h ON g.bin = h.bin"""


@register("histogram_a", fp(HIST_SQL.format(col="rating_a")))
def q_histogram_a(spark, d):
    return G.histogram(facts_prepared(spark, d), "rating_a")


@register("histogram_b", fp(HIST_SQL.format(col="b_norm")))
def q_histogram_b(spark, d):
    return G.histogram(facts_prepared(spark, d), "b_norm")


OLS_SQL = """SELECT regr_slope({y}, {x}) AS slope, regr_intercept({y}, {x}) AS intercept,
       regr_r2({y}, {x}) AS r2, CAST(regr_count({y}, {x}) AS BIGINT) AS n FROM fp"""


@register("ols_a_b", fp(OLS_SQL.format(y="rating_a", x="b_norm")))
def q_ols_a_b(spark, d):
    return G.ols(facts_prepared(spark, d), "rating_a", "b_norm")


@register("ols_diff_votes", fp(OLS_SQL.format(y="rating_diff", x="votes_log10")))
def q_ols_diff_votes(spark, d):
    return G.ols(facts_prepared(spark, d), "rating_diff", "votes_log10")


@register("ols_absdiff_reviews", fp(OLS_SQL.format(y="abs_diff", x="n_reviews")))
def q_ols_absdiff_reviews(spark, d):
    return G.ols(facts_prepared(spark, d), "abs_diff", "n_reviews")


def _scatter_sql(x: str, y: str, color: str | None, parts: list[tuple[str, str]]) -> str:
    label = "title || ' (' || CAST(year AS VARCHAR) || ')'" + "".join(
        f" || ' / {n}: ' || {_num_sql(c)}" for n, c in parts)
    col = f", {color} AS color" if color else ""
    return fp(f"SELECT {x} AS x, {y} AS y{col}, {label} AS label FROM fp "
              f"WHERE {x} IS NOT NULL AND {y} IS NOT NULL")


THREE_PANELS = [("rating_a", "b_norm"), ("rating_a", "c_norm"), ("b_norm", "c_norm")]


@register("scatter_three_panels", " UNION ALL ".join(
    f"SELECT '{x}~{y}' AS panel, * FROM ({_scatter_sql(y, x, None, [(x, x), (y, y)])}) p{i}"
    for i, (x, y) in enumerate(THREE_PANELS)))
def q_scatter_three_panels(spark, d):
    return G.scatter_panels(facts_prepared(spark, d), THREE_PANELS)


@register("box_diff_by_bucket", fp("""
, q AS (SELECT vote_bucket AS grp, CAST(count(*) AS BIGINT) AS n,
         quantile_cont(rating_diff, 0.25) AS q1, quantile_cont(rating_diff, 0.5) AS median,
         quantile_cont(rating_diff, 0.75) AS q3 FROM fp WHERE rating_diff IS NOT NULL GROUP BY 1),
f AS (SELECT *, q1 - 1.5 * (q3 - q1) AS lo_f, q3 + 1.5 * (q3 - q1) AS hi_f FROM q)
SELECT f.grp AS vote_bucket, f.n, f.q1, f.median, f.q3,
       min(CASE WHEN v.rating_diff BETWEEN lo_f AND hi_f THEN v.rating_diff END) AS whisker_lo,
       max(CASE WHEN v.rating_diff BETWEEN lo_f AND hi_f THEN v.rating_diff END) AS whisker_hi,
       CAST(count_if(NOT (v.rating_diff BETWEEN lo_f AND hi_f)) AS BIGINT) AS n_outliers
FROM f JOIN fp v ON v.vote_bucket IS NOT DISTINCT FROM f.grp AND v.rating_diff IS NOT NULL
GROUP BY f.grp, f.n, f.q1, f.median, f.q3"""))
def q_box_diff_by_bucket(spark, d):
    return G.box_stats(facts_prepared(spark, d), "vote_bucket", "rating_diff")


@register("box_a_by_status", fp("""
, b AS (SELECT CASE WHEN status IN ('certified', 'fresh', 'rotten') THEN status END AS grp, rating_a AS v
        FROM fp WHERE rating_a IS NOT NULL),
q AS (SELECT grp, CAST(count(*) AS BIGINT) AS n, quantile_cont(v, 0.25) AS q1,
         quantile_cont(v, 0.5) AS median, quantile_cont(v, 0.75) AS q3 FROM b GROUP BY 1),
f AS (SELECT *, q1 - 1.5 * (q3 - q1) AS lo_f, q3 + 1.5 * (q3 - q1) AS hi_f FROM q)
SELECT f.grp AS status, f.n, f.q1, f.median, f.q3,
       min(CASE WHEN b.v BETWEEN lo_f AND hi_f THEN b.v END) AS whisker_lo,
       max(CASE WHEN b.v BETWEEN lo_f AND hi_f THEN b.v END) AS whisker_hi,
       CAST(count_if(NOT (b.v BETWEEN lo_f AND hi_f)) AS BIGINT) AS n_outliers,
       CAST(CASE f.grp WHEN 'certified' THEN 1 WHEN 'fresh' THEN 2 WHEN 'rotten' THEN 3 END AS INTEGER) AS level_ord
FROM f JOIN b ON b.grp IS NOT DISTINCT FROM f.grp
GROUP BY f.grp, f.n, f.q1, f.median, f.q3"""))
def q_box_a_by_status(spark, d):
    return G.box_stats(facts_prepared(spark, d), "status", "rating_a", levels=G.STATUS_LEVELS)


@register("genre_diff_feed", fp(f"""
, g AS ({GENRE_SQL.format(n=5)})
SELECT primary_genre, avg_diff, count,
       CAST(row_number() OVER (ORDER BY avg_diff ASC NULLS LAST, primary_genre) AS INTEGER) AS pos,
       CASE WHEN avg_diff > 0 THEN 'a' ELSE 'b' END AS sign,
       'n=' || CAST(count AS VARCHAR) || ' | Diff=' || {_num_sql('avg_diff')} AS label FROM g"""))
def q_genre_diff_feed(spark, d):
    return G.group_diff_feed(A.genre_stats(facts_prepared(spark, d)))


@register("genre_series_feed", fp(f"""
, g AS ({GENRE_SQL.format(n=5)}),
r AS (SELECT *, CAST(row_number() OVER (ORDER BY avg_a ASC NULLS LAST, primary_genre) AS INTEGER) AS pos FROM g)
SELECT primary_genre, pos, series, value FROM r
UNPIVOT INCLUDE NULLS (value FOR series IN (avg_a, avg_b, avg_c))"""))
def q_genre_series_feed(spark, d):
    return G.group_series_feed(A.genre_stats(facts_prepared(spark, d)))


@register("decade_feed", fp(f"""
, g AS ({DECADE_SQL.format(n=48)}),
l AS (SELECT decade, count, series, value FROM g UNPIVOT INCLUDE NULLS (value FOR series IN (avg_a, avg_b)))
SELECT *, CAST(decade AS VARCHAR) || 's | n=' || CAST(count AS VARCHAR) || ' / ' || {_num_sql('value')} AS label
FROM l"""))
def q_decade_feed(spark, d):
    return G.decade_feed(A.decade_stats(facts_prepared(spark, d)))


@register("scatter_reviews_score", _scatter_sql("n_reviews", "score_b", "status",
                                                [("reviews", "n_reviews"), ("score", "score_b")]))
def q_scatter_reviews_score(spark, d):
    return G.scatter_points(facts_prepared(spark, d), "n_reviews", "score_b", color="status",
                            label_parts=[("reviews", "n_reviews"), ("score", "score_b")])


@register("scatter_reviews_absdiff", _scatter_sql("n_reviews", "abs_diff", None,
                                                  [("reviews", "n_reviews"), ("diff", "abs_diff")]))
def q_scatter_reviews_absdiff(spark, d):
    return G.scatter_points(facts_prepared(spark, d), "n_reviews", "abs_diff",
                            label_parts=[("reviews", "n_reviews"), ("diff", "abs_diff")])


VOTES_TEXT_SQL = "format('{:,}', CAST(round_even(votes, 0) AS BIGINT))"


@register("scatter_votes_diff", fp(f"""
SELECT votes_log10 AS x, rating_diff AS y, rating_a AS color,
       title || ' (' || CAST(year AS VARCHAR) || ')' || ' / a: ' || {_num_sql('rating_a')}
       || ' / votes: ' || {VOTES_TEXT_SQL} || ' / diff: ' || {_num_sql('rating_diff')} AS label
FROM fp WHERE votes_log10 IS NOT NULL AND rating_diff IS NOT NULL"""))
def q_scatter_votes_diff(spark, d):
    return G.scatter_points(facts_prepared(spark, d), "votes_log10", "rating_diff", color="rating_a",
                            label_parts=[("a", "rating_a"), ("votes", S.thousands("votes")), ("diff", "rating_diff")])


# G5, G11, G12 with a bound: the points of smallest MD5 of their key, first of each cell
def _limit_sql(rows: str, limit: int, by: str = "NULL") -> str:
    """``rows``: SQL with x, y and the keys; the ends are those of each ``by`` group."""
    bins = max(1, int((limit // 8) ** 0.5))
    cell = lambda v: (f"CASE WHEN {v}1 > {v}0 THEN least(floor(({v} - {v}0) / ({v}1 - {v}0) * {bins}), {bins - 1}) ELSE 0 END")
    order = f"md5(concat_ws(':', {POINT_KEY_SQL}))"
    return f"""
, p AS ({rows}),
e AS (SELECT *, CAST(min(x) OVER g AS double) AS x0, CAST(max(x) OVER g AS double) AS x1,
             CAST(min(y) OVER g AS double) AS y0, CAST(max(y) OVER g AS double) AS y1 FROM p WINDOW g AS (PARTITION BY {by})),
k AS (SELECT *, row_number() OVER (PARTITION BY {by}, {cell('x')}, {cell('y')} ORDER BY {order}) > {limit // (2 * bins ** 2)} AS rest FROM e),
r AS (SELECT *, row_number() OVER (PARTITION BY {by} ORDER BY rest, {order}) AS rn FROM k)
SELECT * EXCLUDE (l_orderkey, l_linenumber, title, kq, kv, ks, x0, x1, y0, y1, rest, rn) FROM r WHERE rn <= {limit}"""


# (order and line alone repeat in these tables)
POINT_KEY = {"kq": "rating_a * 5", "kv": "votes", "ks": "score_b"}
POINT_KEY_SQL = "CAST(l_orderkey AS varchar), CAST(l_linenumber AS varchar), title, kq, kv, ks"
POINTS = 400
LIMITED = dict(limit=POINTS, key=[*KEYS, "title", *POINT_KEY])


def _keyed(scatter: str) -> str:
    """The inner SELECT of a scatter query with the row's key."""
    key = ", ".join(f"CAST(CAST(round({x}) AS bigint) AS varchar) AS {k}" for k, x in POINT_KEY.items())
    return f"SELECT l_orderkey, l_linenumber, title, {key}, " + scatter.split(") SELECT ", 1)[1]


def keyed_facts(spark: SparkSession, d: str) -> DataFrame:
    return facts_prepared(spark, d).withColumns({k: F.expr(f"CAST(round({x}) AS bigint)") for k, x in POINT_KEY.items()})


@register("scatter_reviews_score_limit", fp(_limit_sql(_keyed(CATALOG["scatter_reviews_score"][1]), POINTS)))
def q_scatter_reviews_score_limit(spark, d):
    return G.scatter_points(keyed_facts(spark, d), "n_reviews", "score_b", color="status",
                            label_parts=[("reviews", "n_reviews"), ("score", "score_b")], **LIMITED)


@register("scatter_reviews_absdiff_limit", fp(_limit_sql(_keyed(CATALOG["scatter_reviews_absdiff"][1]), POINTS)))
def q_scatter_reviews_absdiff_limit(spark, d):
    return G.scatter_points(keyed_facts(spark, d), "n_reviews", "abs_diff",
                            label_parts=[("reviews", "n_reviews"), ("diff", "abs_diff")], **LIMITED)


@register("scatter_three_panels_limit", fp(_limit_sql(" UNION ALL ".join(
    _keyed(_scatter_sql(y, x, None, [(x, x), (y, y)])).replace(" AS ks, ", f" AS ks, '{x}~{y}' AS panel, ")
    for x, y in THREE_PANELS), POINTS, "panel")))
def q_scatter_three_panels_limit(spark, d):
    return G.scatter_panels(keyed_facts(spark, d), THREE_PANELS, **LIMITED)


# ============================================================== statistics from one state (F)
def facts_state(spark: SparkSession, d: str, rows=None) -> DataFrame:
    """Counts, means and co-moments of the facts at the grain of genre, decade, bucket and status."""
    df = facts_prepared(spark, d)
    return M.moment_state(df if rows is None else df.where(rows), M.GRAIN, M.LINKED)


STATE_QUERIES = {
    "correlations": lambda s: M.correlations(s, M.LINKED, with_p=False),
    "correlations_by_decade": lambda s: M.correlations(s, M.LINKED, by=["decade"], with_p=False),
    "ttest_by_genre_pvalue": lambda s: M.ttest_1samp(s, M.LINKED, "rating_diff", by=["primary_genre"]),
    "genre_stats": lambda s: M.group_stats(s, M.LINKED, "primary_genre", A.GENRE_METRICS, 5, ["avg_diff"]),
    "overall_summary": lambda s: M.overall_summary(s, M.LINKED),
    "pair_mean_diffs": lambda s: M.pair_mean_diffs(s, M.LINKED),
    "ols_diff_votes": lambda s: M.ols(s, M.LINKED, "rating_diff", "votes_log10"),
}


def _state_query(name: str, stat):
    def q(spark, d):
        return stat(facts_state(spark, d))
    q.__name__ = f"q_state_{name}"
    return q


for _name, _stat in STATE_QUERIES.items():
    register(f"state_{_name}", CATALOG[_name][1])(_state_query(_name, _stat))


@register("merged_correlations_by_decade", CATALOG["correlations_by_decade"][1])
def q_merged_correlations_by_decade(spark, d):
    """The state of the first line of each order merged with that of all others."""
    parts = [facts_state(spark, d, F.col("l_linenumber") == 1), facts_state(spark, d, F.col("l_linenumber") > 1)]
    return M.correlations(M.merge(parts, M.GRAIN, M.LINKED), M.LINKED, by=["decade"], with_p=False)


# ============================================================== X1: composite (L)
def file_sql(sql: str) -> str:
    return f"SELECT * REPLACE (nullif(trim(title), '') AS title) FROM ({sql}) f0"


LEFT_FILE_SQL, RIGHT_FILE_SQL = file_sql(fx.L_LEFT_SQL), file_sql(fx.L_RIGHT_SQL)


@register("run_pipeline", rd("SELECT * FROM d0"))
def q_run_pipeline(spark, d):
    """Full run over unique titles of L: the gate is enforced and passes."""
    return l_run(spark, d)["data"]


@register("run_gated", rd("SELECT * FROM d0"))
def q_run_gated(spark, d):
    """Q5 in the plan: the linked table behind the gate, which its own job evaluates."""
    return Q.gated(l_run(spark, d)["data"])


@register("run_accounting", f"""
SELECT 'a' AS source, CAST(count(*) AS BIGINT) AS rows_before,
       CAST(count_if({YEAR_SQL} IS NOT NULL AND rating_a IS NOT NULL) AS BIGINT) AS rows_after,
       CAST(count_if({YEAR_SQL} IS NULL OR rating_a IS NULL) AS BIGINT) AS rows_removed FROM ({LEFT_FILE_SQL}) l
UNION ALL
SELECT 'b', CAST(count(*) AS BIGINT), CAST(count_if(score_b IS NOT NULL AND title IS NOT NULL) AS BIGINT),
       CAST(count_if(score_b IS NULL OR title IS NULL) AS BIGINT) FROM ({RIGHT_FILE_SQL}) r""")
def q_run_accounting(spark, d):
    """C6 from the run itself: rows before and after, counted by the jobs that cleaned them."""
    rows = files_run(spark, d)["accounting"]()
    return spark.createDataFrame([tuple(r[c] for c in ("source", "rows_before", "rows_after", "rows_removed")) for r in rows],
                                 "source string, rows_before long, rows_after long, rows_removed long")


# S1-S3 and the run from files: L written as CSV (titles trimmed, empty ones missing), read in byte ranges
@register("read_catalog_a", f"""
SELECT title, year_text, genre_list, rating_a, votes, CAST(NULL AS double) AS meta_score FROM ({LEFT_FILE_SQL}) f""")
def q_read_catalog_a(spark, d):
    with fx.link_files(spark, d) as (left, _):
        return cut_lineage(R.read_catalog_a(spark, left))


_READ_B = """title, release_date, CAST(NULL AS varchar) AS genres, score_b, score_c, n_reviews, status,
       CAST(NULL AS integer) AS fresh_count, CAST(NULL AS integer) AS rotten_count"""


def _numbered(right: DataFrame) -> DataFrame:
    """File order as the number of rows before the row: per file its rows, then the rows of earlier files."""
    file = F.shiftright("b_id", R._ROW_BITS)
    sizes = right.groupBy(file.alias("file")).agg(F.count(F.lit(1)).alias("n"))
    before = sizes.select(F.col("file").alias("f"), (F.sum("n").over(Window.orderBy("file")) - F.col("n")).alias("before"))
    place = F.col("b_id").bitwiseAND((1 << R._ROW_BITS) - 1)
    return right.join(F.broadcast(before), file == F.col("f")).withColumn("b_id", place + F.col("before")).drop("f", "before")


@register("read_catalog_b", f"""
SELECT {_READ_B}, row_number() OVER (ORDER BY b_id) - 1 AS b_id FROM ({RIGHT_FILE_SQL}) f""")
def q_read_catalog_b(spark, d):
    """S2 with the file order, here as the number of rows before."""
    with fx.link_files(spark, d) as (_, right):
        return _numbered(cut_lineage(R.read_catalog_b(spark, right)))


@register("read_catalog_b_parquet", f"""
SELECT {_READ_B}, row_number() OVER (ORDER BY b_id) - 1 AS b_id FROM ({RIGHT_FILE_SQL}) f""")
def q_read_catalog_b_parquet(spark, d):
    """S3: the Parquet copy, which keeps the file order of the CSV."""
    with fx.link_files(spark, d) as (_, right):
        copy = R.convert_to_parquet(R.read_catalog_b(spark, right), f"{right}-parquet")
        return _numbered(cut_lineage(R.read_catalog_b(spark, copy, fmt="parquet")))


def files_run(spark: SparkSession, d: str, **options) -> dict:
    """X1 from CSV to statistics, repeated titles included (so the gate is not enforced)."""
    cfg = X.RunConfig(floor_transpositions=True, decade_min_n=5, enforce_gate=False, **options)
    with fx.link_files(spark, d) as (left, right):
        return X.run(R.read_catalog_a(spark, left).drop("meta_score"), R.read_catalog_b(spark, right), cfg)


FILES_CTE = link_cte(LEFT_FILE_SQL, RIGHT_FILE_SQL) + DERIVED_SQL
FILES_FIRST_CTE = link_cte(LEFT_FILE_SQL, f"""SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (
  PARTITION BY {clean_title_sql('title')}, regexp_extract(release_date, '^([0-9]+)-', 1) ORDER BY b_id) AS rn
  FROM ({RIGHT_FILE_SQL}) r0 WHERE score_b IS NOT NULL AND title IS NOT NULL) r1 WHERE rn = 1""") + DERIVED_SQL


@register("run_from_files", f"{FILES_CTE} SELECT * EXCLUDE (a_id, b_id) FROM d0")
def q_run_from_files(spark, d):
    return files_run(spark, d)["data"].drop("b_id")


@register("run_from_files_first", f"{FILES_FIRST_CTE} SELECT * EXCLUDE (a_id, b_id) FROM d0")
def q_run_from_files_first(spark, d):
    """Of the right rows that repeat a title in a year only the first counts."""
    return files_run(spark, d, dedupe_right=True)["data"].drop("b_id")


@register("quality_gate", ld("""
SELECT CAST(count_if(rating_a IS NULL) AS BIGINT) AS null_rating_a, CAST(count_if(b_norm IS NULL) AS BIGINT) AS null_b_norm,
       CAST(count(*) - count(DISTINCT struct_pack(title, year)) AS BIGINT) AS duplicates,
       min(rating_a) AS min_rating_a, max(rating_a) AS max_rating_a, min(b_norm) AS min_b_norm, max(b_norm) AS max_b_norm,
       CAST(count_if(low_count) AS BIGINT) AS n_low_count,
       count(*) = count(DISTINCT struct_pack(title, year)) AND count(rating_a) = count(*) AND count(b_norm) = count(*) AS passed
FROM d0"""))
def q_quality_gate(spark, d):
    """The gate over all of L, whose repeated titles make it fail."""
    return Q.gate_report(l_data(spark, d))


def _run_stat(name: str):
    def q(spark, d):
        return l_run(spark, d)["stats"][name]
    q.__name__ = f"q_run_{name}"
    return q


RUN_STATS = {
    "correlations": f""", w AS (SELECT corr(rating_a, b_norm) AS r0, CAST(regr_count(b_norm, rating_a) AS BIGINT) AS n0,
  corr(rating_a, c_norm) AS r1, CAST(regr_count(c_norm, rating_a) AS BIGINT) AS n1,
  corr(b_norm, c_norm) AS r2, CAST(regr_count(c_norm, b_norm) AS BIGINT) AS n2 FROM fp),
l AS (SELECT 'rating_a' AS x, 'b_norm' AS y, r0 AS r, n0 AS n FROM w
  UNION ALL SELECT 'rating_a', 'c_norm', r1, n1 FROM w UNION ALL SELECT 'b_norm', 'c_norm', r2, n2 FROM w)
SELECT *, {p_sql('t', 'df')} AS p_value FROM (SELECT x, y, r, n, {CORR_COLS_SQL} FROM l) c""",
    "cohens_d": "SELECT avg(rating_diff) / stddev_samp(rating_diff) AS cohens_d FROM fp",
    "genre_stats": GENRE_SQL.format(n=5),
    "decade_stats": DECADE_SQL.format(n=5),
    "vote_stats": """SELECT vote_bucket, vote_bucket_ord, avg(rating_a) AS avg_a, avg(rating_diff) AS avg_diff,
       CAST(count(*) AS BIGINT) AS count FROM fp GROUP BY 1, 2""",
    "status_stats": """SELECT status, avg(rating_a) AS avg_a, avg(rating_diff) AS avg_diff, CAST(count(*) AS BIGINT) AS count
FROM fp GROUP BY 1""",
    "link_report": """SELECT CAST(count_if(match_type = 'exact') AS BIGINT) AS n_exact,
       CAST(count_if(match_type = 'fuzzy') AS BIGINT) AS n_fuzzy,
       CAST(count(*) AS BIGINT) AS n_total, avg(rating_a) AS avg_rating_a, avg(b_norm) AS avg_b_norm FROM fp""",
    "top_largest": TOP_SQL.format(dir="DESC"),
    "top_smallest": TOP_SQL.format(dir="ASC"),
}
for _name, _sql in RUN_STATS.items():
    register(f"run_{_name}", rd(_sql))(_run_stat(_name))


@register("run_from_files_correlations", f"{FILES_CTE}, fp AS (SELECT * FROM d0) {RUN_STATS['correlations']}")
def q_run_from_files_correlations(spark, d):
    return files_run(spark, d)["stats"]["correlations"]


@register("run_from_files_genre_stats", f"{FILES_CTE}, fp AS (SELECT * FROM d0) {RUN_STATS['genre_stats']}")
def q_run_from_files_genre_stats(spark, d):
    return files_run(spark, d)["stats"]["genre_stats"]
register("run_ttest", rd(ttest_sql("rating_diff", "one").replace("FROM fp GROUP BY", "FROM (SELECT *, 1 AS one FROM fp) f GROUP BY")
                         .replace("SELECT one, mean, sd", "SELECT mean, sd")).replace("WITH a AS", "WITH RECURSIVE a AS", 1))(_run_stat("ttest"))
