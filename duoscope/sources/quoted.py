"""Splittable reading of CSV whose quoted fields hold line breaks.

Whether a line break ends a record depends on the number of quotes before it, in the whole file.
Spark's ``multiLine`` reader therefore gives a file to one task. Here a file is read as lines,
in as many byte ranges as any text file, in three passes:

1. every range tells whether its number of quotes is odd, and how many records start in it if it
   begins outside quotes and if it begins inside;
2. a running sum over the ranges of a file (one row each) tells which of the two it is, and
   how many records precede;
3. every range cuts its lines into records, numbered from the file's start. What a range's end cuts
   off meets again by record number: a piece or two per range, or ranges that a record fills.

Records then go through the CSV parser one by one. The quoting must be that of RFC 4180: fields
with quotes are quoted as a whole and quotes inside are doubled. A file with an odd number of quotes
is an error (its records have no end).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import cut_lineage

#: Ranges whose table is broadcast; with more the join shuffles.
_BROADCAST_RANGES = 200_000


def _line_stats(values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Quotes of each line, and whether it is blank."""
    quotes = np.array([v.as_buffer().to_pybytes().count(b'"') if v.is_valid else 0 for v in values], np.int64)
    blank = np.array([not v.is_valid or not v.as_py().strip() for v in values], bool)
    return quotes, blank


def _ranges(batch: pa.RecordBatch, file: str = "file"):
    """(file, start, first row, last row + 1) of the byte ranges in a batch."""
    files, starts = batch[file].to_pylist(), batch["start"].to_pylist()
    at = 0
    for i in range(1, len(files) + 1):
        if i == len(files) or starts[i] != starts[at] or files[i] != files[at]:
            yield files[at], starts[at], at, i
            at = i


def _lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("lineSep", "\n").text(path).select(
        F.col("value").cast("binary").alias("value"), F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"))


def byte_ranges(lines: DataFrame) -> DataFrame:
    """(file, rank, start, odd, inside, crlf, before): the rank of the file's path, whether the range
    begins inside quotes, whether the file's lines end in CR LF, and how many records start before."""
    schema = "file string, start long, odd long, n0 long, n1 long, crlf long"

    def count(batches):
        now, odd, n, crlf = None, 0, [0, 0], 0
        out: list[tuple] = []
        for batch in batches:
            for file, start, i, j in _ranges(batch):
                if now != (file, start):
                    if now is not None:
                        out.append((*now, odd, *n, crlf))
                    now, odd, n = (file, start), 0, [0, 0]
                    crlf = int(start == 0 and (batch["value"][i].as_py() or b"").endswith(b"\r"))
                quotes, blank = _line_stats(batch["value"].slice(i, j - i))
                state = (odd + np.cumsum(quotes) - quotes) % 2     # before each line, if the range begins outside
                for s in (0, 1):
                    n[s] += int(((state == s) & ~blank).sum())
                odd = int((odd + quotes.sum()) % 2)
        if now is not None:
            out.append((*now, odd, *n, crlf))
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*out) if out else [[]] * 6, (pa.string(), *[pa.int64()] * 5))],
            names=["file", "start", "odd", "n0", "n1", "crlf"])

    earlier = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    found = lines.mapInArrow(count, schema).withColumn("inside", F.coalesce(F.sum("odd").over(earlier), F.lit(0)) % 2)
    found = found.withColumn("n", F.when(F.col("inside") == 0, F.col("n0")).otherwise(F.col("n1")))
    found = cut_lineage(found.select("file", "start", "odd", "inside",
                                     (F.max("crlf").over(Window.partitionBy("file")) > 0).alias("crlf"),
                                     F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before")))
    # one row per file
    ranks = found.select("file").distinct().select(
        F.col("file").alias("r_file"), F.row_number().over(Window.orderBy("file")).cast("long").alias("rank"))
    return cut_lineage(found.join(ranks, F.col("file") == F.col("r_file")).drop("r_file"))


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """(rank, place, record): the records of CSV files as text; files ranked by path from 1, records
    numbered from 0 in each. Blank lines between records count for nothing.
    """
    lines = _lines(spark, path)
    ranges = byte_ranges(lines)
    n_ranges, *_ = ranges.agg(F.count(F.lit(1))).first()
    broken = ranges.groupBy("file").agg(F.sum("odd").alias("odd")).where("odd % 2 = 1").select("file").limit(1).collect()
    if broken:
        raise ValueError(f"an odd number of quotes in {broken[0][0]}")
    told = ranges.select(F.col("file").alias("r_file"), F.col("start").alias("r_start"), "rank", "crlf", "inside", "before")
    if n_ranges <= _BROADCAST_RANGES:
        told = F.broadcast(told)
    rows = lines.join(told, (F.col("file") == F.col("r_file")) & (F.col("start") == F.col("r_start"))).select(
        "value", "rank", "start", "crlf", "inside", "before")
    schema = "rank long, start long, crlf boolean, place long, whole boolean, record binary"

    def cut(batches):
        now, crlf, inside, place = None, False, 0, 0
        held: list[bytes] = []      # lines of the record that is open
        whole = True                # whether its first line was in this range
        for batch in batches:
            out = []
            inside_at, before_at, values = batch["inside"].to_pylist(), batch["before"].to_pylist(), batch["value"].to_pylist()

            def put(done: bool):
                out.append((*now, crlf, place, whole and done, b"\n".join(held)))

            for file, start, i, j in _ranges(batch, "rank"):
                if now != (file, start):
                    if held:
                        put(False)
                    now, crlf, inside, held = (file, start), batch["crlf"][i].as_py(), inside_at[i], []
                    place, whole = before_at[i] - 1, False
                for line in values[i:j]:
                    line = line or b""
                    if not inside and not held and not line.strip():
                        continue
                    if not inside:
                        place, whole = place + 1, True
                    held.append(line)
                    inside = (inside + line.count(b'"')) % 2
                    if not inside:
                        put(True)
                        held = []
            if out:
                yield _records(out)
        if held:
            yield _records([(*now, crlf, place, False, b"\n".join(held))])

    def _records(out: list[tuple]) -> pa.RecordBatch:
        types = (pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.bool_(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)],
                                          names=["rank", "start", "crlf", "place", "whole", "record"])

    pieces = rows.mapInArrow(cut, schema).withColumn("record", F.col("record").cast("string"))
    joined = (pieces.where("NOT whole").groupBy("rank", "crlf", "place")
              .agg(F.sort_array(F.collect_list(F.struct("start", "record"))).alias("parts"))
              .select("rank", "crlf", "place", F.array_join(F.col("parts.record"), "\n").alias("record")))
    records = pieces.where("whole").select("rank", "crlf", "place", "record").unionByName(joined)
    # line breaks inside quotes are LF, as Spark's reader gives them
    one_kind = F.when(F.col("crlf"), F.replace("record", F.lit("\r\n"), F.lit("\n"))).otherwise(F.col("record"))
    return records.select("rank", "place", F.regexp_replace(one_kind, "\r$", "").alias("record"))


def read_quoted_csv(spark: SparkSession, path: str, columns: list[str], options: dict) -> DataFrame:
    """The rows of CSV files with these columns (their headers', all text), ``_rank`` (of the file by
    path) and ``_place`` (from 0 in it), as the ``multiLine`` reader reads them but in byte ranges."""
    ddl = ", ".join(f"`{c.replace('`', '``')}` string" for c in columns)
    rows = read_records(spark, path).where("place > 0")
    parsed = rows.select(F.from_csv("record", ddl, options).alias("r"),
                         F.col("rank").alias("_rank"), (F.col("place") - 1).alias("_place"))
    return parsed.select(*[F.col("r").getField(c).alias(c) for c in columns], "_rank", "_place")


