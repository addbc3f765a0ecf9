"""Catalogue readers (S1-S3): tolerant CSV ingestion mapped to generic column names.

CSV rules: header row, RFC-4180 quoting (doubled quotes, commas and line breaks inside
quotes), ``NA`` / empty / quoted empty are missing, outer blanks trimmed. Every column
is read as text (no inference pass) and typed afterwards with ``try_cast``, so dirty
values become NULL instead of failing the job.

Files are read in byte ranges although records may span lines (``sources.quoted``). For jobs that
read a catalogue often, ``convert_to_parquet`` once.

Paths go to Spark as they are (globs, folders, URIs, the cluster's default filesystem).
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .quoted import read_quoted_csv

# Column names of the two source catalogues and their types.
LEFT_COLUMNS = {
    "title": ("Series_Title", "string"),
    "year_text": ("Released_Year", "string"),
    "genre_list": ("Genre", "string"),
    "rating_a": ("IMDB_Rating", "double"),
    "votes": ("No_of_Votes", "double"),
    "meta_score": ("Meta_score", "double"),
}
RIGHT_COLUMNS = {
    "title": ("movie_title", "string"),
    "release_date": ("original_release_date", "string"),
    "genres": ("genres", "string"),
    "score_b": ("tomatometer_rating", "double"),
    "score_c": ("audience_rating", "double"),
    "n_reviews": ("tomatometer_count", "int"),
    "status": ("tomatometer_status", "string"),
    "fresh_count": ("tomatometer_fresh_critics_count", "int"),
    "rotten_count": ("tomatometer_rotten_critics_count", "int"),
}


class SourceNotFoundError(FileNotFoundError):
    """A catalogue path does not exist; the message names the source."""


_CSV = {"quote": '"', "escape": '"', "nullValue": "NA", "ignoreLeadingWhiteSpace": "true",
        "ignoreTrailingWhiteSpace": "true", "mode": "PERMISSIVE"}


def _csv_reader(spark: SparkSession, multi_line: bool = True):
    return spark.read.options(header=True, multiLine=multi_line, inferSchema=False, **_CSV)


def _typed(c: str, dtype: str):
    text = F.nullif(F.trim(F.col(f"`{c}`")), F.lit(""))
    if dtype == "string":
        return text
    if dtype in ("int", "bigint"):
        return text.try_cast("double").try_cast(dtype)
    return text.try_cast(dtype)


#: Bits of the order column that number the rows of one file (of up to 8,192 partitions).
_ROW_BITS = 46


def _file_order(raw: DataFrame) -> DataFrame:
    """``raw`` with ``_order``: rank of the row's file by path, then the row's place in it.

    Spark packs files into partitions by size, so partition order is not path order. A file's
    rows stay in order inside the partitions that read it. The ranks are taken over one row
    per file (as many as the driver lists to plan the scan).
    """
    placed = raw.select("*", F.col("_metadata.file_path").alias("_file"),
                        F.monotonically_increasing_id().alias("_at"))
    # a splittable file spans several partitions: number its rows from the first one's id
    starts = placed.groupBy("_file").agg(F.min("_at").alias("_start"))
    starts = starts.withColumn("_rank", F.row_number().over(Window.orderBy("_file")).cast("long"))
    placed = placed.join(starts, "_file").withColumn("_place", F.col("_at") - F.col("_start"))
    return _ordered(placed.drop("_file", "_at", "_start"))


def _ordered(placed: DataFrame) -> DataFrame:
    """``_order`` of rows with ``_rank`` and ``_place``."""
    order = F.shiftleft(F.col("_rank"), _ROW_BITS) + F.col("_place")
    return placed.withColumn("_order", order).drop("_rank", "_place")


def read_catalog(spark: SparkSession, path: str, columns: Mapping[str, tuple[str, str]],
                 source: str, fmt: str = "csv", order_col: str | None = None,
                 multi_line: bool | str = "split") -> DataFrame:
    """Read ``columns`` (generic name -> (source column, type)) from a CSV or Parquet path.

    A Parquet copy may hold the source names or the generic ones. ``order_col`` is the row's
    position in file order (files in path order): the tie-break for 'first row wins' rules; a
    stored column of that name is kept.

    ``multi_line``: ``"split"`` reads quoted line breaks in byte ranges (``sources.quoted``),
    ``True`` with Spark's own reader (one task per file, any quoting), ``False`` takes every line
    for a record.
    """
    split = fmt == "csv" and multi_line == "split"
    try:
        raw = _csv_reader(spark, bool(multi_line)).csv(path) if fmt == "csv" else spark.read.parquet(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "Path does not exist" in str(e):
            raise SourceNotFoundError(f"{source} catalogue not found: '{path}'") from e
        raise
    found = {name: src if src in raw.columns else name for name, (src, _) in columns.items()}
    missing = [columns[name][0] for name, src in found.items() if src not in raw.columns]
    if missing:
        raise ValueError(f"{source} catalogue lacks columns {missing}")
    stored = fmt != "csv" and order_col in raw.columns
    if split:
        raw = read_quoted_csv(spark, path, raw.columns, _CSV | {"multiLine": "true"})
        raw = _ordered(raw)
    elif order_col and not stored:
        raw = _file_order(raw)
    cols = [_typed(found[name], t).alias(name) if fmt == "csv" else F.col(f"`{found[name]}`").try_cast(t).alias(name)
            for name, (_, t) in columns.items()]
    if order_col:
        cols.append(F.col(order_col if stored else "_order").cast("long").alias(order_col))
    return raw.select(*cols)


# S1 -------------------------------------------------------------------------
def read_catalog_a(spark: SparkSession, path: str, columns=LEFT_COLUMNS, fmt: str = "csv",
                   multi_line: bool | str = "split") -> DataFrame:
    return read_catalog(spark, path, columns, "left", fmt, multi_line=multi_line)


# S2 -------------------------------------------------------------------------
def read_catalog_b(spark: SparkSession, path: str, columns=RIGHT_COLUMNS, fmt: str = "csv",
                   order_col: str = "b_id", multi_line: bool | str = "split") -> DataFrame:
    return read_catalog(spark, path, columns, "right", fmt, order_col, multi_line)


def convert_to_parquet(df: DataFrame, out_path: str, mode: str = "overwrite") -> str:
    """Write a catalogue once as Parquet (splittable, columnar, predicate pushdown).

    For the right catalogue convert the frame from ``read_catalog_b`` (it already
    carries the file-order ``b_id``), so the tie-break survives the conversion.
    """
    df.write.mode(mode).parquet(out_path)
    return out_path
