"""Deterministic adapters over the driver's TPC-H-ish tables (see FIXTURES.md).

* Adapter F ("facts"): lineitem x orders x part shaped like a linked catalogue table,
  with dirty year text, NULL scores and an out-of-range vote value.
* Adapter L ("linkage"): ``pages`` split by page_id parity into a left and a right
  catalogue. The title is the whole <title> element; the year follows from the page's
  language, as dirty year text on the left and as release-date text (partly unpadded) on
  the right. Every third right title has one character replaced, so fuzzy matches exist.
* Adapter T ("texts"): ``documents`` split by doc_id parity; the title is the whole text,
  the block the language (exact stage only).

Each adapter exists twice, as a Spark DataFrame builder and as DuckDB SQL for the
oracle, and both must stay the same query.
"""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from .catalogs import LEFT_COLUMNS, RIGHT_COLUMNS


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# ---------------------------------------------------------------- adapter F
def facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = _read(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_quantity",
        "l_extendedprice", "l_discount", "l_tax")
    od = _read(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_orderstatus")
    pt = _read(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type", "p_brand", "p_size")
    # Two equi-joins on the keys; Catalyst/AQE pick broadcast or sort-merge from sizes.
    j = li.join(od, li.l_orderkey == od.o_orderkey).join(pt, li.l_partkey == pt.p_partkey)
    c = F.col
    return j.select(
        c("l_orderkey"), c("l_linenumber"),
        c("p_name").alias("title"),
        F.when(c("l_orderkey") % 97 == 0, F.lit("PG"))
         .otherwise((F.year("o_orderdate") - c("p_size")).cast("string")).alias("year_text"),
        c("o_orderdate").cast("date").alias("release_date"),
        F.concat(c("p_type"), F.lit(", "), c("p_brand")).alias("genre_list"),
        (c("l_quantity") / 5.0).alias("rating_a"),
        F.round(c("l_discount") * 500 + c("l_quantity")).cast("double").alias("score_b"),
        F.nullif(F.round(c("l_tax") * 600 + c("l_quantity")).cast("double"), F.lit(25.0)).alias("score_c"),
        F.nullif(c("p_size"), F.lit(13)).alias("n_reviews"),
        F.when(c("o_orderstatus") == "P", "certified").when(c("o_orderstatus") == "F", "fresh")
         .otherwise("rotten").alias("status"),
        F.when(c("l_linenumber") == 7, F.lit(0.0)).otherwise(c("l_extendedprice") * 50).alias("votes"),
    )


F_SQL = """
SELECT l_orderkey, l_linenumber,
       p_name AS title,
       CASE WHEN l_orderkey % 97 = 0 THEN 'PG'
            ELSE CAST(year(o_orderdate) - p_size AS varchar) END AS year_text,
       CAST(o_orderdate AS date) AS release_date,
       p_type || ', ' || p_brand AS genre_list,
       l_quantity / 5.0 AS rating_a,
       CAST(round(l_discount * 500 + l_quantity) AS double) AS score_b,
       nullif(CAST(round(l_tax * 600 + l_quantity) AS double), 25.0) AS score_c,
       nullif(p_size, 13) AS n_reviews,
       CASE o_orderstatus WHEN 'P' THEN 'certified' WHEN 'F' THEN 'fresh' ELSE 'rotten' END AS status,
       CASE WHEN l_linenumber = 7 THEN 0.0 ELSE l_extendedprice * 50 END AS votes
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
"""


# ---------------------------------------------------------------- adapter L
# Languages of the pages and the year that stands for each.
LANG_YEARS = {"en": 1964, "fr": 1972, "de": 1988, "es": 2003}


def _pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col
    p = _read(spark, sf_dir, "pages").select(
        "page_id", F.regexp_extract("html", r"(?s)<title>(.*?)</title>", 1).alias("title"),
        F.regexp_extract("html", r"<html lang=\"([^\"]*)\"", 1).alias("lang"),
        F.length("html").cast("long").alias("size"))
    year = F.coalesce(*[F.when(c("lang") == lang, F.lit(y)) for lang, y in LANG_YEARS.items()])
    return p.withColumn("year", year)


def link_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Left catalogue of L: even page_id; every 97th year text is bad."""
    c = F.col
    return _pages(spark, sf_dir).where(c("page_id") % 2 == 0).select(
        c("page_id").alias("a_id"), "title",
        F.when(c("page_id") % 97 == 0, "PG").otherwise(c("year").cast("string")).alias("year_text"),
        ((c("size") % 101) / 10.0).alias("rating_a"),
        (c("size") * 997.0).alias("votes"),
        F.concat(F.lit("g"), (c("page_id") / 2).cast("long") % 6, F.lit(", "), c("lang")).alias("genre_list"))


def link_right(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Right catalogue of L: odd page_id; every third title has its fourth character replaced."""
    c = F.col
    edited = F.when(c("page_id") % 3 == 0, F.regexp_replace("title", r"(?s)^(.{3}).", "$1x")).otherwise(c("title"))
    return _pages(spark, sf_dir).where(c("page_id") % 2 == 1).select(
        c("page_id").alias("b_id"), edited.alias("title"),
        F.concat(c("year").cast("string"), F.when(c("page_id") % 5 == 0, "-5-7").otherwise("-05-17")).alias("release_date"),
        ((c("page_id") * 7 + c("size")) % 101).cast("double").alias("score_b"),
        F.nullif((c("size") * 3) % 101, F.lit(50)).cast("double").alias("score_c"),
        F.nullif(c("size") % 40, F.lit(7)).cast("int").alias("n_reviews"),
        F.when(c("size") % 3 == 0, "certified").when(c("size") % 3 == 1, "fresh").otherwise("rotten").alias("status"))


def unique_titles(df: DataFrame, id_col: str) -> DataFrame:
    """The row with the smallest id of each title, whatever its case (a catalogue that passes
    the duplicate gate)."""
    rest = [x for x in df.columns if x != id_col]
    return (df.groupBy(F.lower(F.trim("title")).alias("_t")).agg(F.min(F.struct(id_col, *rest)).alias("row"))
            .select("row.*").select(*df.columns))


_PAGES_SQL = """
SELECT *, CASE lang WHEN 'en' THEN 1964 WHEN 'fr' THEN 1972 WHEN 'de' THEN 1988 WHEN 'es' THEN 2003 END AS year
FROM (SELECT page_id, regexp_extract(html, '<title>(.*?)</title>', 1, 's') AS title,
             regexp_extract(html, '<html lang="([^"]*)"', 1) AS lang, CAST(length(html) AS bigint) AS size FROM pages) p0
"""

L_LEFT_SQL = f"""
SELECT page_id AS a_id, title,
       CASE WHEN page_id % 97 = 0 THEN 'PG' ELSE CAST(year AS varchar) END AS year_text,
       CAST(size % 101 AS double) / 10 AS rating_a, CAST(size AS double) * 997 AS votes,
       'g' || CAST((page_id // 2) % 6 AS varchar) || ', ' || lang AS genre_list
FROM ({_PAGES_SQL}) p WHERE page_id % 2 = 0
"""

L_RIGHT_SQL = f"""
SELECT page_id AS b_id,
       CASE WHEN page_id % 3 = 0 THEN regexp_replace(title, '^(...).', '\\1x', 's') ELSE title END AS title,
       CAST(year AS varchar) || CASE WHEN page_id % 5 = 0 THEN '-5-7' ELSE '-05-17' END AS release_date,
       CAST((page_id * 7 + size) % 101 AS double) AS score_b,
       CAST(nullif((size * 3) % 101, 50) AS double) AS score_c,
       CAST(nullif(size % 40, 7) AS integer) AS n_reviews,
       CASE size % 3 WHEN 0 THEN 'certified' WHEN 1 THEN 'fresh' ELSE 'rotten' END AS status
FROM ({_PAGES_SQL}) p WHERE page_id % 2 = 1
"""


def unique_sql(sql: str, id_col: str) -> str:
    return (f"SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY lower(trim(title)) "
            f"ORDER BY {id_col}) AS rn FROM ({sql}) u0) u1 WHERE rn = 1")


# ---------------------------------------------------------------- adapter L as files
@contextmanager
def link_files(spark: SparkSession, sf_dir: str):
    """Paths of the two catalogues of L as CSV folders under their source names, in the shared folder.

    The right rows are written in the order of page_id, which is then their file order. The folders go
    when the block ends: what is read from them must be cut from its lineage before.
    """
    shared = ensure_checkpoint_dir(spark)
    if not shared:
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    folder = f"{shared}/catalogues-{uuid.uuid4().hex}"
    right = link_right(spark, sf_dir).orderBy("b_id").drop("b_id")
    try:
        for name, df, columns in (("left", link_left(spark, sf_dir), LEFT_COLUMNS), ("right", right, RIGHT_COLUMNS)):
            known = df.columns
            df.select(*[(F.col(c) if c in known else F.lit(None)).cast("string").alias(source)
                        for c, (source, _) in columns.items()]
                      ).write.options(header=True, quote='"', escape='"').csv(f"{folder}/{name}")
        yield f"{folder}/left", f"{folder}/right"
    finally:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


# ---------------------------------------------------------------- adapter T
def text_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Even doc_id: the whole text as title, whatever its length or script."""
    d = _read(spark, sf_dir, "documents").where(F.col("doc_id") % 2 == 0)
    return d.select(F.col("doc_id").alias("a_id"), F.col("text").alias("title"), F.col("lang").alias("block"), "source")


def text_right(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = _read(spark, sf_dir, "documents").where(F.col("doc_id") % 2 == 1)
    return d.select(F.col("doc_id").alias("b_id"), F.col("text").alias("title"), F.col("lang").alias("block"), "n_chars")


T_LEFT_SQL = "SELECT doc_id AS a_id, text AS title, lang AS block, source FROM documents WHERE doc_id % 2 = 0"
T_RIGHT_SQL = "SELECT doc_id AS b_id, text AS title, lang AS block, n_chars FROM documents WHERE doc_id % 2 = 1"
