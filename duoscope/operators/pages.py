"""K7 at depth: a table written once in browsing order, with counts per part and trigram postings.

``browse`` filters and sorts the whole table for every page. A ``PageDirectory`` sorts it once, by
range, and writes it in parts (a folder each) with every row's number in its part. The counts of the
parts, one number each, tell which part holds a place, so any page, the ten-thousandth too, reads
the one or two parts that it lies in. For "contains" searches every row posts the trigrams of its
shown texts, in folders by trigram. The task that reads a batch of a part's rows makes the lists of its
trigrams (one row per trigram, with the numbers of all rows that have it), so no posting is shuffled. A search
reads the lists of its own trigrams, keeps rows that have all of them, and looks at those rows'
texts only; rows that have a text of three characters need no second look.
"""

from __future__ import annotations

import sys
import uuid
import zlib
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from ..session import ensure_checkpoint_dir
from .topk import _text

# Ship this module's code with its functions: executors need no import path to the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Folders of the postings.
_BUCKETS = 64


_POSTINGS = "_part long, first long, tri string, places array<int>"


def _code_points(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(code points of all texts in a row, where each text begins, and the end)."""
    texts = pa.concat_arrays([texts.fill_null("").cast(pa.large_string())])
    _, ends, data = texts.buffers()
    at = np.frombuffer(ends, np.int64)[texts.offset:texts.offset + len(texts) + 1]
    raw = np.frombuffer(data, np.uint8)[at[0]:at[-1]] if data else np.zeros(0, np.uint8)
    at = at - at[0]
    if not (raw >= 128).any():
        return raw.astype(np.int64), at
    before = np.append(0, np.cumsum((raw & 0xC0) != 0x80))
    return np.frombuffer(raw.tobytes().decode().encode("utf-32-le"), np.uint32).astype(np.int64), before[at]


def _post(batches):
    """Of every trigram in a batch's rows of one part: their places, counted from ``first``."""
    for batch in batches:
        order = np.lexsort((batch["_row"].to_numpy(), batch["_part"].to_numpy()))
        batch = batch.take(pa.array(order))
        part, row, texts = batch["_part"].to_numpy(), batch["_row"].to_numpy(), batch["t"]
        if not batch.num_rows:
            continue
        first = row[np.searchsorted(part, part, "left")]
        code, at = _code_points(texts.flatten())
        text = np.repeat(np.arange(len(at) - 1), np.diff(at))
        holder = np.repeat(np.arange(len(row)), texts.value_lengths().to_numpy())
        i = np.flatnonzero(text[:-2] == text[2:]) if len(text) > 2 else np.zeros(0, np.int64)
        shift = 7 if not len(code) or code.max() < 128 else 21
        tri = code[i] << 2 * shift | code[i + 1] << shift | code[i + 2] if len(i) else i
        names, number = (None, tri) if shift == 7 else np.unique(tri, return_inverse=True)
        bits = len(row).bit_length()
        found = np.sort(number << bits | holder[text[i]])
        found = found[np.append(True, found[1:] != found[:-1])[:len(found)]]     # each trigram of a row once
        number, place = found >> bits, found & ((1 << bits) - 1)
        new = np.ones(len(found), bool)
        new[1:] = (number[1:] != number[:-1]) | (part[place[1:]] != part[place[:-1]])
        begin = np.flatnonzero(new)
        tri = number[begin] if names is None else names[number[begin]]
        points = np.stack([tri >> 2 * shift, tri >> shift & (1 << shift) - 1, tri & (1 << shift) - 1], 1).astype(np.uint32)
        joined = points.tobytes().decode("utf-32-le")
        lists = pa.ListArray.from_arrays(pa.array(np.append(begin, len(found)), pa.int32()),
                                         pa.array(row[place] - first[place], pa.int32()))
        yield pa.RecordBatch.from_arrays(
            [pa.array(part[place[begin]], pa.int64()), pa.array(first[place[begin]], pa.int64()),
             pa.array([joined[k:k + 3] for k in range(0, len(joined), 3)], pa.string()), lists],
            names=["_part", "first", "tri", "places"])


class PageDirectory:
    """Pages and searches of one table in one order. ``close`` deletes its files."""

    def __init__(self, df: DataFrame, order_by: Sequence[str], tie_break: Sequence[str] = (), ascending: bool = True,
                 hidden: Sequence[str] = (), parts: int | None = None, path: str | None = None):
        """Writes the directory below ``path`` (default: the cluster's shared checkpoint folder).

        ``hidden`` columns are neither searched nor returned; rows equal in all sort and tie-break
        columns may stand in any order. ``parts`` as many ranges (default: Spark's shuffle partitions).
        """
        spark = df.sparkSession
        shared = path or ensure_checkpoint_dir(spark)
        if not shared:
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        self._spark, self._root = spark, f"{shared}/pages-{uuid.uuid4().hex}"
        self._shown = [c for c in df.columns if c not in hidden]
        self._source = df
        names = list(order_by) + [k for k in tie_break if k not in order_by]
        keys = [F.col(f"`{k}`").asc_nulls_first() if ascending else F.col(f"`{k}`").desc_nulls_last() for k in names]
        ranged = df.repartitionByRange(*([parts] if parts else []), *keys).sortWithinPartitions(*keys)
        row = F.monotonically_increasing_id()
        (ranged.withColumn("_row", row).withColumn("_part", F.shiftright("_row", 33))
         .withColumn("_row", F.col("_row").bitwiseAND((1 << 33) - 1))
         .write.partitionBy("_part").parquet(f"{self._root}/rows"))
        # one row per part
        counts = self._rows().groupBy("_part").agg(F.count(F.lit(1)).alias("n")).orderBy("_part").collect()
        self.parts, self.size = [], 0
        for r in counts:
            self.parts.append((r["_part"], self.size, r["n"]))
            self.size += r["n"]
        texts = self._rows().select("_part", "_row", F.array(*[F.lower(_text(df, c)) for c in self._shown]).alias("t"))
        (texts.mapInArrow(_post, _POSTINGS)
         .withColumn("_bucket", (F.crc32(F.col("tri").cast("binary")) % _BUCKETS).cast("int"))
         .sortWithinPartitions("_bucket", "tri", "_part", "first")
         .write.partitionBy("_bucket").parquet(f"{self._root}/postings"))

    def _rows(self) -> DataFrame:
        schema = StructType([*self._source.schema.fields, StructField("_row", LongType()), StructField("_part", LongType())])
        return self._spark.read.schema(schema).parquet(f"{self._root}/rows")

    def page(self, page: int = 1, size: int = 15) -> DataFrame:
        """Rows (page - 1) * size and on, from the parts that hold them."""
        lo, hi = (page - 1) * size, page * size
        held = [(p, before) for p, before, n in self.parts if before < hi and before + n > lo]
        rows = self._rows().where(F.col("_part").isin([p for p, _ in held]))
        place = F.col("_row")
        for p, before in held:
            place = place + F.when(F.col("_part") == p, F.lit(before)).otherwise(0)
        return (rows.withColumn("_place", place).where((F.col("_place") >= lo) & (F.col("_place") < hi))
                .orderBy("_place").select(*[F.col(f"`{c}`") for c in self._shown]))

    def search(self, text: str, page: int = 1, size: int = 15) -> DataFrame:
        """The page of the rows in whose shown columns the text occurs, whatever its case."""
        needle = text.lower()
        rows = self._rows()
        if len(needle) >= 3:
            tris = sorted({needle[i:i + 3] for i in range(len(needle) - 2)})
            posted = self._spark.read.schema(f"{_POSTINGS}, _bucket int").parquet(f"{self._root}/postings")
            posted = posted.where(F.col("_bucket").isin(sorted({zlib.crc32(t.encode()) % _BUCKETS for t in tris}))
                                  & F.col("tri").isin(tris))
            have = posted.select("_part", "first", F.explode("places").alias("place")).select(
                "_part", (F.col("first") + F.col("place")).alias("_row"))
            if len(needle) == 3:        # a row with this trigram has the text: the page is known before rows are read
                have = F.broadcast(have.orderBy("_part", "_row").offset((page - 1) * size).limit(size))
                return (rows.join(have, ["_part", "_row"]).orderBy("_part", "_row")
                        .select(*[F.col(f"`{c}`") for c in self._shown]))
            have = have.groupBy("_part", "_row").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") == len(tris))
            rows = rows.join(have.drop("n"), ["_part", "_row"], "left_semi")
        hit = F.lit(False)
        for c in self._shown:
            hit = hit | F.coalesce(F.contains(F.lower(_text(self._source, c)), F.lit(needle)), F.lit(False))
        return (rows.where(hit).orderBy("_part", "_row").offset((page - 1) * size).limit(size)
                .select(*[F.col(f"`{c}`") for c in self._shown]))

    def close(self) -> None:
        path = self._spark._jvm.org.apache.hadoop.fs.Path(self._root)
        path.getFileSystem(self._spark._jsc.hadoopConfiguration()).delete(path, True)

    def __enter__(self) -> "PageDirectory":
        return self

    def __exit__(self, *_) -> None:
        self.close()
