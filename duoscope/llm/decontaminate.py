"""Benchmark decontamination by winnowing.

A window is ``window`` consecutive words of a test item (an item with fewer words, but not
none, is one window). Of the hashes of all k-word runs, the minimum of each span of
``window - k + 1`` neighbouring runs is a fingerprint, on both sides. Two texts that share
``window`` words in a row share the minimum of those runs, so joining the fingerprints finds
every shared span of that length; each hit is then extended along its diagonal and its words
are compared byte by byte.

The test items are the small side. They are cut into blocks of at most ``block_bytes`` of
text; each block's fingerprints are broadcast and the documents are passed over once per
block, so the work stays exact and bounded in memory whatever the size of the benchmark
(one item alone is never cut). Documents are not shuffled at all.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from duoscope.llm import words as W
from duoscope.llm.common import blocks, cut, pick, prepare, utf8, with_last

WINDOW, K = 10, 5
BLOCK_BYTES = 16 << 20


class ItemIndex:
    """Fingerprints of the test items of one block."""

    def __init__(self, items: list[tuple[str | None, str | None]], window: int, k: int):
        self.window, self.k = window, min(k, window)
        raw, off = utf8(pa.array([t for _, t in items], pa.string()))
        w = W.split_words(raw, off, W.ALNUM, lower=True)
        self.ids = [i if i is not None else "" for i, _ in items]
        self.hash = [w.hash[a:b] for a, b in zip(w.of[:-1], w.of[1:])]
        self.words = [w.list_of(a, b) for a, b in zip(w.of[:-1], w.of[1:])]
        self.long = self._postings(
            (h, item, int(j)) for item, hs in enumerate(self.hash) if len(hs) >= window
            for g in [W.grams(hs, self.k)]
            for j in np.flatnonzero(W.winnow(g, window - self.k + 1)) for h in [int(g[j])])
        short: dict[int, list] = {}
        for item, hs in enumerate(self.hash):
            if 0 < len(hs) < window:
                short.setdefault(len(hs), []).append((int(W.grams(hs, len(hs))[0]), item, 0))
        self.short = {n: self._postings(x) for n, x in short.items()}

    @staticmethod
    def _postings(triples) -> tuple[np.ndarray, list[list[tuple[int, int]]]]:
        ordered = sorted(triples)
        keys, lists = [], []
        for h, rows in groupby(ordered, key=lambda x: x[0]):
            keys.append(h)
            lists.append([(item, j) for _, item, j in rows])
        return np.array(keys, np.uint64), lists


def _found(hashes: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(positions, index into keys) of the hashes that are among the sorted keys."""
    if not len(keys) or not len(hashes):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = np.minimum(np.searchsorted(keys, hashes), len(keys) - 1)
    hit = np.flatnonzero(keys[at] == hashes)
    return hit, at[hit]


def scan(w: W.Words, index: ItemIndex) -> tuple[np.ndarray, list[set[int]]]:
    """Mask of the words inside an occurrence of a window; per text the items found."""
    hit = np.zeros(len(w.hash), bool)
    items: list[set[int]] = [set() for _ in range(len(w.of) - 1)]
    g = W.grams(w.hash, index.k)
    chosen = np.flatnonzero(W.winnow(g, index.window - index.k + 1))
    keys, lists = index.long
    pos, which = _found(g[chosen], keys)
    pos = chosen[pos]
    text = np.searchsorted(w.of, pos, "right") - 1
    seen = set()
    for i, key, d in zip(pos.tolist(), which.tolist(), text.tolist()):
        if i + index.k > w.of[d + 1]:
            continue
        for item, j in lists[key]:
            if (d, item, i - j) not in seen:
                seen.add((d, item, i - j))
                _extend(w, index, d, item, i - j, hit, items)
    for n, (keys, lists) in index.short.items():
        pos, which = _found(W.grams(w.hash, n), keys)
        text = np.searchsorted(w.of, pos, "right") - 1
        for i, key, d in zip(pos.tolist(), which.tolist(), text.tolist()):
            if i + n <= w.of[d + 1]:
                mine = w.list_of(i, i + n)
                for item, _ in lists[key]:
                    if index.words[item] == mine:
                        hit[i:i + n] = True
                        items[d].add(item)
    return hit, items


def _extend(w: W.Words, index: ItemIndex, d: int, item: int, at: int,
            hit: np.ndarray, items: list[set[int]]) -> None:
    """Mark every run of ``window`` or more equal words of one diagonal (item word 0 is word at)."""
    theirs = index.hash[item]
    lo, hi = max(0, int(w.of[d]) - at), min(len(theirs), int(w.of[d + 1]) - at)
    same = theirs[lo:hi] == w.hash[at + lo:at + hi]
    for t in np.flatnonzero(same):
        if w.bytes_of(at + lo + t) != index.words[item][lo + t]:
            same[t] = False
    edges = np.flatnonzero(np.diff(np.concatenate(([0], same.astype(np.int8), [0]))))
    for a, b in zip(edges[::2], edges[1::2]):
        if b - a >= index.window:
            hit[at + lo + a:at + lo + b] = True
            items[d].add(item)


def _runs(mask: np.ndarray) -> list[dict]:
    edges = np.flatnonzero(np.diff(np.concatenate(([0], mask.astype(np.int8), [0]))))
    return [{"start": int(a), "end": int(b)} for a, b in zip(edges[::2], edges[1::2])]


def _batch_hits(column: pa.Array, index: ItemIndex, before=None):
    """Per text: (number of words, hit mask, item ids)."""
    for i, j in blocks(column):
        raw, off = utf8(column.slice(i, j - i))
        w = W.split_words(raw, off, W.ALNUM, lower=True)
        hit, items = scan(w, index)
        for d in range(j - i):
            mask = hit[w.of[d]:w.of[d + 1]]
            ids = {index.ids[x] for x in items[d]}
            if before:
                for s in before[0][i + d]:
                    mask[s["start"]:s["end"]] = True
                ids |= set(before[1][i + d])
            yield len(mask), mask, ids


_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
_RESULT = T.StructType([
    T.StructField("n_words", T.LongType()),
    T.StructField("spans", T.ArrayType(T.StructType([
        T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))),
    T.StructField("items", T.ArrayType(T.StringType()))])


def item_blocks(bench: DataFrame, item_col: str, text_col: str, block_bytes: int
                ) -> Iterator[list[tuple[str | None, str | None]]]:
    """The distinct test items in blocks of about ``block_bytes``, one block on the driver at a time."""
    b = pick(bench, item=item_col, text=text_col).select(
        F.col("item").cast("string").alias("item"), "text").distinct()
    size = b.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = int(size // block_bytes) + 1
    part = F.pmod(F.xxhash64("item", "text"), F.lit(n))
    for i in range(n):
        yield [(r.item, r.text) for r in b.where(part == i).orderBy("item", "text").collect()]


def contamination(docs: DataFrame, bench: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW,
                  k: int = K, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per document row: id, n_words, spans of hit words [start, end), items, n_hit.

    Null or empty texts have no words and no hits; very long ones are read whole (a text with its words and
    hashes must fit a worker); windows that several items share count for each; repeated rows are judged alike; an empty
    benchmark hits nothing; a null item id counts as the id ''. Other columns of either table
    are not read, so they may have any name.
    """
    spark = docs.sparkSession
    prepare(spark)
    df = pick(docs, id=id_col, text=text_col)
    id_type = df.schema["id"].dataType
    carried = T.StructType([T.StructField("id", id_type), T.StructField("text", T.StringType()),
                            *_RESULT.fields])
    for items, last in with_last(item_blocks(bench, item_col, item_text_col, block_bytes)):
        shared = spark.sparkContext.broadcast(ItemIndex(items, window, k))

        def run(batches, shared=shared, last=last):
            for batch in batches:
                before = None
                if "spans" in batch.schema.names:
                    before = (batch["spans"].to_pylist(), batch["items"].to_pylist())
                rows = list(_batch_hits(batch["text"], shared.value, before))
                out = {"id": batch["id"]} if last else {"id": batch["id"], "text": batch["text"]}
                out |= {"n_words": pa.array([r[0] for r in rows], pa.int64()),
                        "spans": pa.array([_runs(r[1]) for r in rows], _SPANS),
                        "items": pa.array([sorted(r[2]) for r in rows], pa.list_(pa.string()))}
                yield pa.RecordBatch.from_pydict(out)

        schema = T.StructType([f for f in carried if not (last and f.name == "text")])
        df = df.mapInArrow(run, schema)
        if not last:        # one block at a time in a worker's memory
            df = cut(df)
            shared.destroy()
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"])
    return df.select(F.col("id").alias(id_col), "n_words", "spans",
                     F.array_sort("items").alias("items"), n_hit.alias("n_hit"))


def drop_contaminated(docs: DataFrame, bench: DataFrame, text_col: str = "text",
                      window: int = WINDOW, k: int = K,
                      block_bytes: int = BLOCK_BYTES, **names: str) -> DataFrame:
    """The document rows, with all their columns, that hold no window of any test item."""
    spark = docs.sparkSession
    prepare(spark)
    for items, last in with_last(item_blocks(bench, names.get("item_col", "item_id"),
                                             names.get("item_text_col", "text"), block_bytes)):
        shared = spark.sparkContext.broadcast(ItemIndex(items, window, k))

        def run(batches, shared=shared):
            for batch in batches:
                clean = [not mask.any() for _, mask, _ in _batch_hits(batch[text_col], shared.value)]
                yield batch.filter(pa.array(clean, pa.bool_()))

        docs = docs.mapInArrow(run, docs.schema)
        if not last:
            docs = cut(docs)
            shared.destroy()
    return docs
