"""Mixing sources to target weights, in fixed-length blocks of words.

Every source is a stream of its documents' words in a fixed pseudorandom order, packed into
blocks of ``block`` words. Targets share the size of all sources by weight and stop at
``max_repeat`` times a source's size; the excess is shared anew. For each output shard the
number of blocks per source is one multinomial draw with the sources' remaining quotas as
weights, so any shard is a fair mixture and the totals come out at the targets. The n-th block
that a source gives (its slot) is the n-th of a keyed pseudorandom permutation of its block
indices (one permutation per pass over the source), and slots are joined with the documents'
words by block index.

Nothing is grouped by source alone: running totals inside a source are taken over hash buckets
of its documents first, then inside each bucket, so a source may hold most of all rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from duoscope.llm.common import cut, pick, prepare

WEIGHTS = (1, 2, 3)
BLOCK, SHARD_BLOCKS, MAX_REPEAT, SEED = 128, 1 << 16, 3, 20240229
MAX_SOURCES = 100_000
_BUCKETS = 1 << 12
_WORD = r"[^\x20\x09-\x0D]+"


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(_WORD)), F.lit(0)).cast("long")


def targets(sizes: list[int], weights: list[float], max_repeat: float = MAX_REPEAT) -> list[float]:
    """Shares of sum(sizes) by weight, none above max_repeat times its size."""
    out: list[float | None] = [None] * len(sizes)
    left = float(sum(sizes))
    while True:
        free = [i for i, x in enumerate(out) if x is None]
        if not free:
            return out
        total = sum(weights[i] for i in free)
        full = [i for i in free if left * weights[i] / total > max_repeat * sizes[i]]
        if not full:
            for i in free:
                out[i] = left * weights[i] / total
            return out
        for i in full:
            out[i] = float(max_repeat * sizes[i])
        left -= sum(out[i] for i in full)


def draw(quota: np.ndarray, shard_blocks: int, seed: int) -> list[np.ndarray]:
    """Blocks of each source in each shard; the columns add up to the quotas."""
    left, out = quota.astype(np.int64).copy(), []
    while left.sum():
        size = min(shard_blocks, int(left.sum()))
        rng = np.random.default_rng([seed, len(out)])
        got = np.zeros_like(left)
        while got.sum() < size:         # what a source cannot give is drawn from the others
            rest = left - got
            got += np.minimum(rest, rng.multinomial(size - got.sum(), rest / rest.sum()))
        out.append(got)
        left -= got
    return out


def permute(x: np.ndarray, n: int, key: int) -> np.ndarray:
    """A keyed bijection of 0..n-1: a four-round Feistel network, walking until inside."""
    half = max(1, math.ceil(math.log2(max(n, 2)) / 2))
    mask = np.uint64((1 << half) - 1)

    def rounds(v: np.ndarray) -> np.ndarray:
        a, b = v >> np.uint64(half), v & mask
        for r in range(4):
            f = (b + np.uint64((key + r * 0x9E3779B9) & 0xFFFFFFFFFFFFFFFF)) * np.uint64(0xBF58476D1CE4E5B9)
            f = (f ^ (f >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
            a, b = b, a ^ ((f >> np.uint64(32)) & mask)
        return (a << np.uint64(half)) | b

    v = rounds(x.astype(np.uint64))
    out = v >= n
    while out.any():
        v[out] = rounds(v[out])
        out = v >= n
    return v.astype(np.int64)


class Mix:
    """A planned mixture: ``documents`` (one row per input row), ``sources``, ``slots``."""

    def __init__(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 source_col: str = "source", weights=WEIGHTS, block: int = BLOCK,
                 shard_blocks: int = SHARD_BLOCKS, max_repeat: int = MAX_REPEAT, seed: int = SEED,
                 max_sources: int = MAX_SOURCES):
        spark = docs.sparkSession
        prepare(spark)
        self.block, self.seed = block, seed
        sized = pick(docs, id=id_col, text=text_col, source=source_col)
        sized = cut(sized.select("id", F.col("source").cast("string").alias("source"),
                                 n_words(F.col("text")).alias("size")))
        # one row per source, at most max_sources of them
        rows = sized.groupBy("source").agg(F.sum("size").alias("size")).limit(max_sources + 1).collect()
        if len(rows) > max_sources:
            raise ValueError(f"more than {max_sources} sources")
        rows = sorted(rows, key=lambda r: (r.source is None, r.source or ""))
        size = [r["size"] for r in rows]
        target = targets(size, [weights[i % len(weights)] for i in range(len(rows))], max_repeat)
        blocks = [-(-s // block) for s in size]
        quota = np.array([min(max_repeat * b, round(t * b / s)) if s else 0
                          for s, t, b in zip(size, target, blocks)], np.int64)
        self.sources = spark.createDataFrame(
            [(i, r.source, s, t, b) for i, (r, s, t, b) in enumerate(zip(rows, size, target, blocks))],
            "src int, source string, source_size bigint, target double, n_blocks bigint")
        self._plan_slots(quota, shard_blocks)
        self._plan_documents(sized)

    def _plan_slots(self, quota: np.ndarray, shard_blocks: int) -> None:
        first, rows = np.zeros_like(quota), []
        for shard, got in enumerate(draw(quota, shard_blocks, self.seed)):
            rows += [(shard, s, int(first[s]), int(got[s])) for s in np.flatnonzero(got).tolist()]
            first += got
        spark, seed = self.sources.sparkSession, self.seed
        drawn = spark.createDataFrame(rows, "shard int, src int, first bigint, n bigint")
        drawn = drawn.join(self.sources.select("src", "n_blocks"), "src")

        def run(batches):
            for batch in batches:
                for r in batch.to_pylist():
                    for a in range(r["first"], r["first"] + r["n"], 1 << 16):
                        slot = np.arange(a, min(a + (1 << 16), r["first"] + r["n"]))
                        at, turn = slot % r["n_blocks"], slot // r["n_blocks"]
                        got = np.empty_like(slot)
                        for t in np.unique(turn).tolist():
                            key = (seed * 0x10001 + r["src"] * 0x632BE59BD9B4E019 + t * 0x9E3779B97F4A7C15) % (1 << 64)
                            got[turn == t] = permute(at[turn == t], r["n_blocks"], key)
                        yield pa.RecordBatch.from_pydict({
                            "shard": pa.array(np.full(len(slot), r["shard"]), pa.int32()),
                            "src": pa.array(np.full(len(slot), r["src"]), pa.int32()),
                            "slot": pa.array(slot), "block": pa.array(got)})

        #: which block of which source stands at which slot of which shard
        self.slots = drawn.mapInArrow(run, "shard int, src int, slot bigint, block bigint")

    def _plan_documents(self, sized: DataFrame) -> None:
        named = self.sources.select("src", F.col("source").alias("name"), "source_size", "target")
        d = sized.join(named, sized["source"].eqNullSafe(named["name"])).drop("name")
        d = d.withColumn("part", F.pmod(F.xxhash64("id", F.lit(self.seed)), F.lit(_BUCKETS)).cast("int"))
        sums = d.groupBy("src", "part").agg(F.sum("size").alias("n"))
        before = Window.partitionBy("src").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
        sums = sums.select("src", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
        inside = Window.partitionBy("src", "part").orderBy("id", "size")
        d = d.join(sums, ["src", "part"])
        d = d.withColumn("row", F.row_number().over(inside))
        d = d.withColumn("begin", F.col("base") - F.col("size") + F.sum("size").over(
            inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
        self.documents = d.select("id", "src", "part", "row", "size", "source_size", "target", "begin")

    def pieces(self) -> DataFrame:
        """Part of a document that lies in a block: id, src, block, first (word), n (words)."""
        b = F.lit(self.block)
        end = F.col("begin") + F.col("size")
        d = self.documents.withColumn("block", F.explode_outer(F.when(F.col("size") > 0, F.expr(
            f"sequence(begin div {self.block}, (begin + size - 1) div {self.block})"))))
        low = F.greatest(F.col("begin"), F.col("block") * b)
        return (d.withColumn("first", low - F.col("begin"))
                .withColumn("n", F.least(end, (F.col("block") + 1) * b) - low))

    def mixed(self) -> DataFrame:
        """The mixture: shard, src, slot, block and the document words that fill it, in order."""
        p = self.pieces().where("block IS NOT NULL").select("src", "block", "id", "begin", "first", "n")
        return self.slots.join(p, ["src", "block"])

    def taken(self) -> DataFrame:
        """One row per input row: id, size, source_size, target, taken (words, repeats counted)."""
        times = self.slots.groupBy("src", "block").agg(F.count("*").alias("times"))
        got = self.pieces().join(times, ["src", "block"], "left")
        return (got.groupBy("src", "part", "row", "id", "size", "source_size", "target")
                .agg(F.coalesce(F.sum(F.col("n") * F.col("times")), F.lit(0)).cast("long").alias("taken"))
                .select("id", "size", "source_size", "target", "taken"))


def mix_sources(docs: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """Mix and count: one row per input row.

    A null text has size 0 and is never taken; a null source is a source of its own, the last.
    Rows that repeat an id are documents of their own. An empty table gives an empty result. A very long text
    spans many blocks, each counted by itself; documents of one bucket stand by id, then by size.
    Columns other than id, text and source are not read. Reruns on the same rows agree.
    """
    return Mix(docs, id_col=id_col, **options).taken().withColumnRenamed("id", id_col)
