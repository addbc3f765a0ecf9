"""Helpers shared by the corpus operators."""

from __future__ import annotations

import gc
import os
import tempfile
import zipfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, SparkSession, functions as F

from duoscope.session import ensure_checkpoint_dir

#: Rows of an Arrow batch between the JVM and a Python worker. With whole texts of some KB
#: a batch stays at a few MB; the kernels below cut batches further by bytes.
BATCH_ROWS = 256


def prepare(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Lower the session's Arrow batch size to ``rows`` (never raise it); ship this package.

    The package goes to the workers as a file of the Spark context, once for each context, so
    executors need no path of their own to it.
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(key, "10000"))
    if now <= 0 or now > rows:
        spark.conf.set(key, str(rows))
    sc = spark.sparkContext
    if getattr(sc, "_duoscope_shipped", False):
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    target = os.path.join(tempfile.mkdtemp(prefix="duoscope-"), "duoscope.zip")
    with zipfile.ZipFile(target, "w") as z:
        for folder, _, names in os.walk(top):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.relpath(path, os.path.dirname(top)))
    sc.addPyFile(target)
    sc._duoscope_shipped = True


def cut(df: DataFrame, eager: bool = True) -> DataFrame:
    """Reliable checkpoint in the folder that the cluster names in spark.checkpoint.dir.

    Only a local session gets a folder of its own; a cluster without one is an error,
    since executors can be lost and nothing else would survive that.
    """
    if not ensure_checkpoint_dir(df.sparkSession):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return df.checkpoint(eager=eager)


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of frames that nothing refers to any more.

    Its cleaner waits for the driver's garbage collector, which a long chain of small jobs may
    not wake for half an hour; until then every shuffle stays on the executors' disks.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def measured(df: DataFrame, rows: int = 200_000) -> DataFrame:
    """To be broadcast if it is counted to have at most ``rows``; otherwise the join shuffles."""
    df = cut(df)
    return F.broadcast(df) if df.count() <= rows else df


def with_last(items: Iterator) -> Iterator[tuple]:
    """(item, whether it is the last), one item ahead."""
    items = iter(items)
    for now in items:
        for following in items:
            yield now, False
            now = following
        yield now, True


def pick(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named input columns under internal names: others cannot clash with ours."""
    return df.select(*[df[f"`{name}`"].alias(alias) for alias, name in columns.items()])


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary column; a null counts as an empty value."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type)
                                  or pa.types.is_large_string(column.type) else b"")
    kind = np.int64 if column.type in (pa.large_string(), pa.large_binary()) else np.int32
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, off, data = column.buffers()
    offsets = np.frombuffer(off, kind)[column.offset:column.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def blocks(column: pa.Array, limit: int = 2 << 20) -> Iterator[tuple[int, int]]:
    """Row ranges of a column whose texts have at most ``limit`` bytes (one row at least)."""
    _, offsets = utf8(column)
    n, i = len(offsets) - 1, 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1)
        yield i, min(j, n)
        i = j


def runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Of batches whose rows are sorted by ``keys``: the rows of one key at a time.

    Holds one batch and one key's rows.
    """
    rest: list[pa.Table] = []

    def key_of(table: pa.Table, i: int) -> tuple:
        return tuple(table[k][i].as_py() for k in keys)

    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        if rest and key_of(rest[0], 0) != key_of(table, 0):
            yield pa.concat_tables(rest)
            rest = []
        edge = np.zeros(table.num_rows, bool)
        for k in keys:
            column = table[k].combine_chunks()
            edge[1:] |= np.asarray(pa.compute.not_equal(column[1:], column[:-1]))
        cuts = [0, *np.flatnonzero(edge).tolist(), table.num_rows]
        for a, b in zip(cuts[:-1], cuts[1:]):
            if b < table.num_rows:
                yield pa.concat_tables([*rest, table.slice(a, b - a)])
                rest = []
            else:
                rest.append(table.slice(a, b - a))
    if rest:
        yield pa.concat_tables(rest)


def whole(batches: Iterator[pa.RecordBatch], keys: list[str], rows: int = 1 << 16) -> Iterator[pa.Table]:
    """Of batches whose rows are sorted by ``keys`` (integers): tables of about ``rows`` rows that cut no key.

    Holds so many rows, or one key's if these are more.
    """
    held: list[pa.RecordBatch] = []
    n, enough = 0, rows
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        n += batch.num_rows
        if n < enough:
            continue
        table = pa.Table.from_batches(held).combine_chunks()
        last = np.ones(n, bool)
        for k in keys:
            column = table[k].to_numpy()
            last &= column == column[-1]
        begin = int(np.argmax(last))
        if begin:
            yield table.slice(0, begin)
        held, n = table.slice(begin).to_batches(), n - begin
        enough = max(rows, 2 * n)
    if n:
        yield pa.Table.from_batches(held).combine_chunks()
