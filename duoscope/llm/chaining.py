"""Fuzzy repeated passages by collinear chaining of shared k-mers.

1. Seeds: hashes of k-word runs that are the minimum of ``w`` neighbours (any shared run of
   k + w - 1 words holds one), and hashes of runs of 5 neighbouring seeds. Every place of a seed is
   linked to the seed's first place (smallest document). Where at most ``FEW`` different texts hold a
   seed, all of them are linked with one another, so links grow with the rows, not with the square of
   a repeated seed's places. A seed with very many places in one task is linked there
   to the task's first, so a seed found everywhere sends one row per task; all others are linked
   over all rows alike, however these are dealt out.
2. Links are grouped by the pair of documents and chained: a chain goes forward in both texts;
   its score is the words its seeds cover less ``GAP`` for every word moved on in either text. The
   best predecessor of each link comes from a Fenwick tree over the places in the second text
   that holds prefix maxima, so a pair of documents with n links costs n log n.
3. Seeds in more than ``FEW`` texts are joined, within a text, with the next such seed 16 and 40 words on. Each
   joint is a seed again: few texts hold both ends of a passage although many hold either. Texts that share
   a joint that more than ``FEW`` hold have the class of that joint: each is linked to its first.
4. The words around each chain of some length, and around joints that no chain holds, are fetched and
   aligned (equal runs between anchors that occur once in either text); ends are trimmed or extended to
   where words agree. Passages of ``MIN_WORDS`` or more whose words agree to ``IDENTITY`` are the result.
5. A copy of another document's whole text gets a passage of all its words in the first such document;
   the links of that one hold for it.
"""

from __future__ import annotations

from bisect import bisect_left

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, functions as F, types as T

from duoscope.llm import words as W
from duoscope.llm.common import blocks, cut, measured, pick, prepare, utf8, whole

K, WINDOW, GAP = 4, 5, 0.15
#: Runs of so many neighbouring seeds are seeds too, thinned to the minima of RUN_WINDOW neighbours.
RUN_SEEDS, RUN_WINDOW = (5,), 6
MIN_WORDS, IDENTITY = 50, 0.7
MIN_SEEDS, MIN_SPAN = 2, 20     # of a chain, before it is aligned
MARGIN = 48                     # words fetched on either side of a chain
FEW = 32                        # texts that hold a seed, up to which all are linked with one another
JOINT, _STEP, _SPAN = (16, 40), 24, 128     # words between two seeds that are joined
_HELD = 1 << 21                 # seeds a task holds before it sorts them
_OFTEN = 64                     # places of a seed among those, beyond which they are linked there


def seeds(column: pa.Array, k: int, w: int):
    """(text, word, hash) arrays of the seeds of some texts."""
    for i, j in blocks(column):
        raw, off = utf8(column.slice(i, j - i))
        words = W.split_words(raw, off, W.SPACED, lower=True)
        g = W.grams(words.hash, k)
        at = np.flatnonzero(W.winnow(g, w))
        text = np.searchsorted(words.of, at, "right") - 1
        ok = at + k <= words.of[text + 1]
        at, text = at[ok], text[ok]
        h, pos = g[at], at - words.of[text]
        # the n-th place of a seed in one text (n > 0) is also a seed of its own: places of
        # texts that repeat themselves then meet in order, not all at the first place
        order = np.lexsort((h, text))       # stable, and places rise within a text
        new = np.ones(len(order), bool)
        new[1:] = (h[order][1:] != h[order][:-1]) | (text[order][1:] != text[order][:-1])
        rank = np.arange(len(order)) - np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))
        again, nth = order[rank > 0], rank[rank > 0].astype(np.uint64)
        found = [(text, pos, h), (text[again], pos[again], W.mix(h[again] + nth))]
        for n in RUN_SEEDS:
            run_of = W.grams(h, n)
            first = np.flatnonzero(W.winnow(run_of, RUN_WINDOW))
            first = first[text[first] == text[first + n - 1]]
            found.append((text[first], pos[first], W.mix(run_of[first] + np.uint64(n))))
        text, pos, h = (np.concatenate(x) for x in zip(*found))
        yield text + i, pos, h.view(np.int64)


def _link(h: np.ndarray, doc: np.ndarray, pos: np.ndarray):
    """Sorted by seed, document, place: (order, whether first of its seed, the first's row)."""
    order = np.argsort(h)
    first, head = _heads(h[order])
    many = ~first | ~np.append(first[1:], True)         # seeds with several rows
    rows = order[many]
    order[many] = rows[np.lexsort((pos[rows], doc[rows], h[rows]))]
    return order, first, head


def _heads(hs: np.ndarray):
    first = np.ones(len(hs), bool)
    first[1:] = hs[1:] != hs[:-1]
    return first, np.maximum.accumulate(np.where(first, np.arange(len(hs)), 0))


def _texts(h: np.ndarray, doc: np.ndarray, own: np.ndarray, first: np.ndarray):
    """(whether the first place of a document's own text, how many of the row's seed) of sorted rows."""
    new = own.copy()
    rows = np.flatnonzero(own)
    new[rows[1:]] = (h[rows[1:]] != h[rows[:-1]]) | (doc[rows[1:]] != doc[rows[:-1]])
    if not len(h):
        return new, np.zeros(0, np.int64)
    start = np.flatnonzero(first)
    return new, np.repeat(np.add.reduceat(new.astype(np.int64), start), np.diff(np.append(start, len(h))))


def linked(rows: DataFrame, places) -> DataFrame:
    """a, x, b, y: place x of document a and place y of document b < a hold one seed.

    ``places`` makes (seed, document, place, whether not a copy) arrays of a batch. Every place is
    linked to the seed's first; where at most ``FEW`` documents that are no copies hold the seed, their
    first places are linked with one another. Of seeds in more of them, each such place is also
    given out, with b = a and the seed as y.
    """
    schema = "h long, a long, x long, b long, y long, s long"
    names = ["h", "a", "x", "b", "y", "s"]
    COPY, COPY_OF_MANY = 0, 1       # s: these, the seed if it is in more than FEW here, null otherwise

    def inside(batches):
        held: list[tuple] = []
        n = 0

        def out():
            h, doc, pos, own = (np.concatenate(x) for x in zip(*held))
            order, first, head = _link(h, doc, pos)
            h, doc, pos, own = h[order], doc[order], pos[order], own[order]
            # of a seed with many places only the first goes to the seed's task, the others' links to any
            size = np.diff(np.append(np.flatnonzero(first), len(h)))
            new, texts = _texts(h, doc, own, first)
            many = texts > FEW
            alone = first | (np.repeat(size, size) <= _OFTEN) | (new & ~many)
            keep = alone | (doc[head] != doc)
            to = np.where(alone, h, W.mix(doc.astype(np.uint64) + pos.astype(np.uint64)).view(np.int64))
            s = np.where(many & new, h, np.where(many & first, COPY_OF_MANY, COPY))
            told = (alone & ~own) | (many & new)
            cols = [to, doc, pos, doc[head], pos[head], s]
            hide = {"b": alone, "y": alone, "s": ~told}
            return pa.RecordBatch.from_arrays(
                [pa.array(c[keep], mask=hide[k][keep] if k in hide else None) for k, c in zip(names, cols)], names)

        for batch in batches:
            for h, doc, pos, own in places(batch):
                held.append((h, doc, pos, own))
                n += len(h)
            if n > _HELD:
                yield out()
                held, n = [], 0
        if n:
            yield out()

    def batch_of(*cols):
        return pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names[1:5])

    def across(batches):
        for table in whole(batches, ["h"]):
            h, a, x = (table[c].to_numpy() for c in names[:3])
            told = np.asarray(table["s"].is_valid())
            s = table["s"].fill_null(0).to_numpy()
            old = np.asarray(table["b"].is_valid())
            if old.any():
                yield batch_of(a[old], x[old], *(table[c].fill_null(0).to_numpy()[old] for c in ("b", "y")))
                of_many = old & told
                yield batch_of(a[of_many], x[of_many], a[of_many], s[of_many])
                h, a, x, told, s = (c[~old] for c in (h, a, x, told, s))
            # Spark sorts by the seed alone; seeds with one place lead nowhere, the others' places are sorted here
            first = np.append(True, h[1:] != h[:-1])[:len(h)]
            keep = ~first | ~np.append(first[1:], True)[:len(h)] | (s != COPY)
            h, a, x, told, s = (c[keep] for c in (h, a, x, told, s))
            if not len(h):
                continue
            order = np.lexsort((x, a, h))
            h, a, x, told, s = (c[order] for c in (h, a, x, told, s))
            first, head = _heads(h)
            keep = a != a[head]
            yield batch_of(a[keep], x[keep], a[head][keep], x[head][keep])
            start = np.flatnonzero(first)
            new, texts = _texts(h, a, ~told | (s != COPY) & (s != COPY_OF_MANY), first)
            many = (texts > FEW) | np.repeat(np.logical_or.reduceat(told & (s != COPY), start), np.diff(np.append(start, len(h))))
            yield batch_of(a[many & new], x[many & new], a[many & new], h[many & new])
            few = np.flatnonzero(new & ~many & (texts > 1))
            for n in range(1, FEW):
                i, j = few[:-n], few[n:]
                same = h[i] == h[j]
                if not same.any():
                    break
                same &= ~first[i]           # linked to the first above
                yield batch_of(a[j][same], x[j][same], a[i][same], x[i][same])

    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (rows.mapInArrow(inside, schema).repartition(parts, "h").sortWithinPartitions("h")
            .mapInArrow(across, "a long, x long, b long, y long"))


def seed_links(docs: DataFrame, k: int, w: int) -> DataFrame:
    """``linked`` for the seeds of texts; a place is a word. ``copy`` (if any) tells copies of other texts."""
    if "copy" not in docs.columns:
        docs = docs.withColumn("copy", F.lit(False))

    def places(batch):
        ids = batch["id"].to_numpy(zero_copy_only=False)
        own = ~batch["copy"].to_numpy(zero_copy_only=False).astype(bool)
        for text, pos, h in seeds(batch["text"], k, w):
            yield h, ids[text], pos, own[text]

    return linked(docs.select("id", "text", "copy"), places)


def joint_links(often: DataFrame, k: int) -> DataFrame:
    """a, a0, a1, b, b0, b1: word ranges between two seeds, each in many texts, that both documents hold.

    A seed is joined with the next such seed at least ``JOINT`` words on. Few texts hold both even
    if many hold either; where many hold both, each is linked to the first.
    """

    def places(batch):
        for doc, rest in zip(batch["a"].to_pylist(), batch["often"].to_pylist()):
            x, h = np.frombuffer(rest, np.int64).reshape(2, -1)
            for far in JOINT:
                j = np.searchsorted(x, x + far)
                i = np.flatnonzero(j < len(x))
                i = i[x[j[i]] - x[i] < far + _STEP]
                j = j[i]
                both = W.mix(h[i].view(np.uint64) * np.uint64(3) + W.mix(h[j].view(np.uint64))).view(np.int64)
                yield both, np.full(len(i), doc, np.int64), x[i] * _SPAN + (x[j] - x[i]), np.ones(len(i), bool)

    found = linked(often.select("a", "often"), places).where("a <> b")
    return found.select(
        "a", F.expr(f"x div {_SPAN}").alias("a0"), F.expr(f"x div {_SPAN} + x % {_SPAN} + {k}").alias("a1"),
        "b", F.expr(f"y div {_SPAN}").alias("b0"), F.expr(f"y div {_SPAN} + y % {_SPAN} + {k}").alias("b1"))


class Fenwick:
    """Prefix maxima of (value, row)."""

    def __init__(self, n: int):
        self.best: list[tuple[float, int]] = [(float("-inf"), -1)] * (n + 1)

    def put(self, i: int, value: tuple[float, int]) -> None:
        i += 1
        while i < len(self.best):
            if value > self.best[i]:
                self.best[i] = value
            i += i & -i

    def top(self, i: int) -> tuple[float, int]:
        """The best of 0 .. i - 1."""
        out = (float("-inf"), -1)
        while i:
            if self.best[i] > out:
                out = self.best[i]
            i -= i & -i
        return out


def chains(x: list[int], y: list[int], k: int, gap: float) -> list[list[int]]:
    """Rows of each chain of the links (x[i], y[i]), best first, no link in two chains."""
    rows = sorted(range(len(x)), key=lambda i: (x[i], -y[i]))
    score, before = [0.0] * len(x), [-1] * len(x)
    if all(x[i] < x[j] and y[i] < y[j] for i, j in zip(rows, rows[1:])):
        # one rising line: the link before is the best predecessor, if any is
        for j, i in zip([-1, *rows], rows):
            joined = score[j] + gap * (x[j] + y[j]) - gap * (x[i] + y[i]) if j >= 0 else 0.0
            score[i] = float(k)
            if joined > 0:
                new = min(k, x[i] - x[j], y[i] - y[j])
                score[i], before[i] = joined + new + gap * 2 * new, j
        rows = []
    ys = sorted(set(y)) if rows else []
    tree = Fenwick(len(ys))
    for i in rows:
        at = bisect_left(ys, y[i])
        value, j = tree.top(at)
        # value holds score + gap * (x + y) of the predecessor
        joined = value - gap * (x[i] + y[i])
        if j >= 0 and joined > 0:
            new = min(k, x[i] - x[j], y[i] - y[j])
            score[i], before[i] = joined + new + gap * 2 * new, j
        else:
            score[i] = float(k)
        tree.put(at, (score[i] + gap * (x[i] + y[i]), i))
    used, out = [False] * len(x), []
    for i in sorted(range(len(x)), key=lambda i: -score[i]):
        chain = []
        while i >= 0 and not used[i]:
            used[i] = True
            chain.append(i)
            i = before[i]
        if chain:
            out.append(chain[::-1])
    return out


def pair_chains(links: DataFrame, k: int, gap: float) -> DataFrame:
    """a, a0, a1, b, b0, b1: word ranges of the chains worth aligning.

    For a document with seeds in many texts also a row with b = a and those, by place, in ``often``.
    """
    names = ["a", "a0", "a1", "b", "b0", "b1"]

    def run(batches):
        for table in whole(batches, ["a"]):
            a, x, b, y = (table[c].to_numpy() for c in ("a", "x", "b", "y"))
            # Spark sorts by the document alone; pairs with few links lead nowhere, the others' are sorted here
            order = np.lexsort((b, a))
            a, b = a[order], b[order]
            start = np.flatnonzero(np.append(True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])))
            size = np.diff(np.append(start, len(a)))
            keep = np.repeat(size >= MIN_SEEDS, size)
            if not keep.any():
                continue
            a, b, order = a[keep], b[keep], order[keep]
            x, y = x[order], y[order]
            order = np.lexsort((y, x, b, a))
            x, y = x[order], y[order]
            # a seed and a run of seeds may begin at one word
            once = np.append(True, (a[1:] != a[:-1]) | (b[1:] != b[:-1]) | (x[1:] != x[:-1]) | (y[1:] != y[:-1]))
            a, x, b, y = a[once], x[once], b[once], y[once]
            start = np.flatnonzero(np.append(True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])))
            end = np.append(start[1:], len(a))
            wide = (end - start >= MIN_SEEDS) & (x[end - 1] - x[start] + k >= MIN_SPAN)       # sorted by x
            rows, often = [], []
            for i, j in zip(start[wide].tolist(), end[wide].tolist()):
                if a[i] == b[i]:
                    h, at = np.unique(y[i:j], return_index=True)
                    at = np.sort(at)                # the first place of each seed
                    often.append((int(a[i]), np.concatenate([x[i:j][at], y[i:j][at]]).tobytes()))
                    continue
                xs, ys = x[i:j].tolist(), y[i:j].tolist()
                for c in chains(xs, ys, k, gap):
                    if len(c) >= MIN_SEEDS and xs[c[-1]] - xs[c[0]] + k >= MIN_SPAN:
                        rows.append((a[i], xs[c[0]], xs[c[-1]] + k, b[i], ys[c[0]], ys[c[-1]] + k))
            docs = pa.array([d for d, _ in often], pa.int64())
            none = pa.nulls(len(often), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.concat_arrays([pa.array([r[n] for r in rows], pa.int64()), docs if c in "ab" else none])
                 for n, c in enumerate(names)]
                + [pa.concat_arrays([pa.nulls(len(rows), pa.binary()), pa.array([o for _, o in often], pa.binary())])],
                [*names, "often"])

    parts = int(links.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (links.repartition(parts, "a", "b").sortWithinPartitions("a")
            .mapInArrow(run, "a long, a0 long, a1 long, b long, b0 long, b1 long, often binary"))


def joined(found: DataFrame, k: int) -> DataFrame:
    """The chains of ``pair_chains`` and, where no chain holds them, the ranges of ``joint_links``."""
    names = ["a", "a0", "a1", "b", "b0", "b1"]
    chained = found.where("often IS NULL").select(*names, F.lit(0).alias("way"))
    joint = joint_links(found.where("often IS NOT NULL"), k).withColumn("way", F.lit(1))

    def run(batches):
        for table in whole(batches, ["a", "b"]):
            out: list[list] = []
            pair, mine, chained_to = None, 0, 0
            cols = [table[c].to_numpy() for c in [*names, "way"]]
            a, a0, a1, b, b0, b1, way = cols
            # ranges of one line are one
            on = np.append(False, (a[1:] == a[:-1]) & (b[1:] == b[:-1]) & (way[:-1] == 1) & (a0[1:] <= a1[:-1]) & (b0[1:] <= b1[:-1])
                           & (np.abs(a0[1:] - b0[1:] - a0[:-1] + b0[:-1]) <= _STEP) & (b0[1:] >= b0[:-1]))
            start = np.flatnonzero(~on)
            cols = [c[start] for c in cols]
            cols[2], cols[5] = np.maximum.reduceat(a1, start), np.maximum.reduceat(b1, start)
            for a, a0, a1, b, b0, b1, way in zip(*(c.tolist() for c in cols)):
                if pair != (a, b):
                    pair, mine, chained_to = (a, b), len(out), len(out)
                if not way:
                    out.append([a, a0, a1, b, b0, b1])
                    chained_to = len(out)
                    continue
                if any(c0 - MARGIN <= a0 and a1 <= c1 + MARGIN and d0 - MARGIN <= b0 and b1 <= d1 + MARGIN
                       for _, c0, c1, _, d0, d1 in out[mine:]):
                    continue
                for r in out[chained_to:]:          # goes on where an earlier range ends
                    if a0 <= r[2] + MARGIN and b0 <= r[5] + MARGIN and abs(a1 - b1 - r[2] + r[5]) <= _STEP:
                        r[2], r[5] = max(r[2], a1), max(r[5], b1)
                        break
                else:
                    out.append([a, a0, a1, b, b0, b1])
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (zip(*out) if out else [[]] * 6)], names)

    parts = int(found.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (chained.union(joint).repartition(parts, "a", "b").sortWithinPartitions("a", "b", "way", "a0", "a1", "b0", "b1")
            .mapInArrow(run, "a long, a0 long, a1 long, b long, b0 long, b1 long"))


def _increasing(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest part of pairs (in order of their first numbers) whose second numbers rise."""
    ends, last, before = [], [], []
    for n, (_, j) in enumerate(pairs):
        k = bisect_left(ends, j)
        before.append(last[k - 1] if k else -1)
        if k == len(ends):
            ends.append(j)
            last.append(n)
        else:
            ends[k], last[k] = j, n
    out, n = [], last[-1] if last else -1
    while n >= 0:
        out.append(pairs[n])
        n = before[n]
    return out[::-1]


def _anchors(p: list, q: list, k: int) -> list[tuple[int, int, int]]:
    """Places of runs of k words that either text has once, in the same order in both, with 1."""
    if min(len(p), len(q)) < k:
        return []
    places = []
    for words in (p, q):
        at: dict = {}
        for i, run in enumerate(zip(*(words[n:] for n in range(k)))):
            at[run] = -1 if run in at else i
        places.append(at)
    mine, theirs = places
    # a dictionary keeps the order of its first entries, so runs that occur once come by place
    return _rising([(i, theirs[run]) for run, i in mine.items() if i >= 0 and theirs.get(run, -1) >= 0])


def _anchors_of_words(p: list, q: list, common: set) -> list[tuple[int, int, int]]:
    """``_anchors`` of single words; if none occurs once, words are told apart by their running number."""
    places = []
    for words in (p, q):
        at: dict = {}
        for i, w in enumerate(words):
            if w in common:
                at[w] = -1 if w in at else i
        places.append(at)
    mine, theirs = places
    pairs = [(i, theirs[w]) for w, i in mine.items() if i >= 0 and theirs[w] >= 0]
    if not pairs:
        places = []
        for words in (p, q):
            seen: dict = {}
            at = {}
            for i, w in enumerate(words):
                if w in common:
                    seen[w] = n = seen.get(w, 0) + 1
                    at[w, n] = i
            places.append(at)
        mine, theirs = places
        pairs = [(i, theirs[w]) for w, i in mine.items() if w in theirs]
    return _rising(pairs)


def _rising(pairs: list[tuple[int, int]]) -> list[tuple[int, int, int]]:
    if any(u[1] > v[1] for u, v in zip(pairs, pairs[1:])):
        pairs = _increasing(pairs)
    return [(i, j, 1) for i, j in pairs]


class Coded:
    """Texts as numbers: equal words, and equal runs of ``k`` words, have equal numbers.

    ``texts`` is a binary column of words with one space between two. Anchors are found by writing the
    places of one text's runs to a table with an entry for each run, and reading the other's there.
    """

    def __init__(self, texts: pa.Array, k: int = 3):
        split = pa.compute.split_pattern(texts, b" ")
        self.start = split.offsets.to_numpy()[:-1].astype(np.int64)
        self.size = np.where(pa.compute.binary_length(texts).to_numpy(zero_copy_only=False) > 0, np.diff(split.offsets.to_numpy()), 0)
        coded = split.values.dictionary_encode()
        word, self.k = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), k
        n = max(1, len(coded.dictionary))
        run, kinds = word, n
        for j in range(1, k):
            if kinds * n >= 1 << 62:
                run, kinds = self._dense(run)
            run, kinds = run[:-1] * n + word[j:j + max(0, len(run) - 1)], kinds * n
        self.words = word.tolist()
        self.run, kinds = self._dense(run)
        self.mine, self.theirs = np.zeros(kinds, np.int64), np.full(kinds, -1, np.int64)

    @staticmethod
    def _dense(x: np.ndarray) -> tuple[np.ndarray, int]:
        coded = pa.array(x).dictionary_encode()
        return coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), len(coded.dictionary)

    def _once(self, table: np.ndarray, run: np.ndarray) -> None:
        """The place of each run in ``table``, -1 if it occurs twice."""
        place = np.arange(len(run))
        table[run] = place
        other = table[run] != place
        if other.any():
            table[run[other]] = -1

    def anchors(self, a: int, b: int, c: int, d: int) -> list[tuple[int, int, int]]:
        """As ``_anchors`` of the words a .. b and c .. d, with the number of neighbours on one line."""
        if min(b - a, d - c) < self.k:
            return []
        mine, theirs = self.run[a:b - self.k + 1], self.run[c:d - self.k + 1]
        self._once(self.theirs, theirs)
        j = self.theirs[mine]
        self.theirs[theirs] = -1
        i = np.flatnonzero(j >= 0)
        j = j[i]
        if (j[1:] <= j[:-1]).any():         # out of order, or a run that the first text has twice
            self._once(self.mine, mine)
            once = self.mine[mine[i]] >= 0
            i, j = i[once], j[once]
            if (j[1:] < j[:-1]).any():
                i, j = np.array(_increasing(list(zip(i.tolist(), j.tolist())))).T
        if not len(i):
            return []
        first = [0, *(np.flatnonzero((i[1:] - i[:-1] != 1) | (j[1:] - j[:-1] != 1)) + 1).tolist()]
        return [(x, y, n - m) for x, y, m, n in zip(i[first].tolist(), j[first].tolist(), first, [*first[1:], len(i)])]

    def align(self, a: int, b: int, c: int, d: int) -> tuple[int, int, int, int, int]:
        """``align`` of the words a .. b and c .. d."""
        p, q = self.words[a:b], self.words[c:d]
        return (0, b - a, 0, d - c, b - a) if p == q else align(p, q, self.anchors(a, b, c, d))


def equal_blocks(p: list, q: list, k: int = 3, anchors: list[tuple[int, int, int]] | None = None) -> list[tuple[int, int, int]]:
    """(place in p, place in q, size) of equal runs of words, in order, apart in both.

    Runs of k words that occur once in either text are the anchors (found here unless given); each is
    extended while words agree, and the gaps between are treated alike with single words. Where nothing
    occurs once (texts that repeat themselves), words are told apart by their running number.
    """
    if k == 1:
        if len(p) == 1:                 # its first place, whether there are more or not
            return [(0, q.index(p[0]), 1)] if p[0] in q else []
        if len(q) == 1:
            return [(p.index(q[0]), 0, 1)] if q[0] in p else []
        common = set(p).intersection(q)
        if not common:
            return []
        anchors = _anchors_of_words(p, q, common)
    elif anchors is None:
        anchors = _anchors(p, q, k)
    if not anchors:
        return equal_blocks(p, q, 1)
    out, a, b = [], 0, 0           # what lies before a and b is done

    def gap(hi_a, hi_b):
        # the words after a block differ, so of one and one nothing is equal
        if k > 1 and hi_a > a and hi_b > b and hi_a - a + hi_b - b > 2:
            out.extend([(a + x, b + y, n) for x, y, n in equal_blocks(p[a:hi_a], q[b:hi_b], 1)])

    for i, j, on in anchors:
        done = max(0, a - i, b - j)
        if done >= on:
            continue
        i, j, end = i + done, j + done, i + on + k - 1      # words are equal as far as there
        while i > a and j > b and p[i - 1] == q[j - 1]:
            i, j = i - 1, j - 1
        gap(i, j)
        n = end - i
        while i + n < len(p) and j + n < len(q) and p[i + n] == q[j + n]:
            n += 1
        if n:
            out.append((i, j, n))
            a, b = i + n, j + n
    gap(len(p), len(q))
    return out


def align(p: list, q: list, anchors: list[tuple[int, int, int]] | None = None) -> tuple[int, int, int, int, int]:
    """(begin, end in p, begin, end in q, agreeing words) of the best run of equal blocks.

    Blocks are joined while the words between them cost less than the blocks bring.
    """
    if p == q:
        return 0, len(p), 0, len(q), len(p)
    best, now = (0.0, 0, 0, 0, 0, 0), None
    for a, b, n in equal_blocks(p, q, anchors=anchors):
        if now:
            value = now[0] - max(a - now[2], b - now[4])
            now = (value + n, now[1], a + n, now[3], b + n, now[5] + n) if value > 0 else None
        if not now:
            now = (float(n), a, a + n, b, b + n, n)
        best = max(best, now, key=lambda z: z[0])
    return best[1:]


def aligned(found: DataFrame, docs: DataFrame, min_words: int, identity: float) -> DataFrame:
    names = ["a", "a0", "a1", "b", "b0", "b1"]
    found = cut(found)
    # chains meet the words of their documents in groups: those whose earlier documents lead to one first
    # document, so that words of texts that are all alike travel once, not once for each pair
    low = found.groupBy("a").agg(F.min("b").alias("low")).withColumnRenamed("a", "of")
    found = found.join(low, found["b"] == low["of"], "left").withColumn("root", F.coalesce("low", "b"))
    size = found.groupBy("root").agg(F.ceil(F.count("*") / 256).alias("parts"))
    found = cut(found.join(size, "root").select(
        F.xxhash64("root", F.pmod(F.xxhash64("a"), "parts")).alias("g"), *names))
    sides = found.select("g", F.col("a").alias("id"), F.col("a0").alias("lo"), F.col("a1").alias("hi"))
    sides = sides.union(found.select("g", "b", "b0", "b1")).distinct()
    # at most about 64 ranges travel with one copy of a document's text
    many = sides.groupBy("id").agg(F.ceil(F.count("*") / 64).alias("parts"))
    wanted = (sides.join(many, "id").withColumn("part", F.pmod(F.xxhash64("g"), F.col("parts")))
              .groupBy("id", "part").agg(F.collect_list(F.struct("g", "lo", "hi")).alias("ranges")))
    wanted = measured(wanted.withColumnRenamed("id", "at"), 100_000)

    def fetch(batches):
        for batch in batches:
            out: list[tuple] = []
            words: list[bytes] = []
            for i, j in blocks(batch["text"]):
                raw, off = utf8(batch["text"].slice(i, j - i))
                w = W.split_words(raw, off, W.SPACED, lower=True, hashed=False)
                ids = batch["id"].slice(i, j - i).to_pylist()
                cuts: list[tuple[int, int]] = []
                for d, ranges in enumerate(batch["ranges"].slice(i, j - i).to_pylist()):
                    a, b = int(w.of[d]), int(w.of[d + 1])
                    spans: list[list] = []          # the ranges of one group that touch are one
                    for r in sorted(ranges, key=lambda r: (r["g"], r["lo"])):
                        lo, hi = max(0, r["lo"] - MARGIN), min(b - a, r["hi"] + MARGIN)
                        if spans and spans[-1][0] == r["g"] and lo <= spans[-1][2]:
                            spans[-1][2] = max(spans[-1][2], hi)
                        else:
                            spans.append([r["g"], lo, hi])
                    out.extend((g, ids[d], lo) for g, lo, _ in spans)
                    cuts.extend((a + lo, a + hi) for _, lo, hi in spans)
                words.extend(w.joined(cuts))
            cols = list(zip(*out)) or [[]] * 3
            yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in cols), pa.array(words, pa.binary())],
                                             ["g", "a", "a0", "words"])

    spans = (docs.join(wanted, docs["id"] == wanted["at"]).select("id", "text", "ranges")
             .mapInArrow(fetch, "g long, a long, a0 long, words binary"))
    zero = F.lit(0).cast("long")
    rows = found.select("g", *names, F.lit(None).cast("binary").alias("words")).union(
        spans.select("g", "a", "a0", zero, zero, zero, zero, "words"))

    def run(batches):
        for table in whole(batches, ["g"], 1 << 12):
            spoken = table.filter(table["words"].is_valid())
            words = spoken["words"].cast(pa.large_binary()).combine_chunks()
            coded = Coded(words)
            texts: dict = {}
            for n, (g, a, a0) in enumerate(zip(*(spoken[c].to_pylist() for c in ("g", "a", "a0")))):
                # a document id that repeats brings several texts; the first by content is taken
                of = texts.setdefault((g, a), {})
                if a0 not in of or words[n].as_py() < words[of[a0]].as_py():
                    of[a0] = n
            texts = {k: [(lo, int(coded.start[n]), int(coded.size[n])) for lo, n in of.items()] for k, of in texts.items()}

            def words_of(g, doc, lo, hi):
                for begin, start, n in texts.get((g, doc), ()):
                    if begin <= lo < begin + n:
                        return start + lo - begin, start + min(n, hi - begin)
                return 0, 0

            def passage(p0, p1, q0, q1, a0, b0):
                i0, i1, j0, j1, same = coded.align(p0, p1, q0, q1)
                if min(i1 - i0, j1 - j0) >= min_words and same >= identity * max(i1 - i0, j1 - j0):
                    return a0 + i0, a0 + i1, b0 + j0, b0 + j1, same
                return None

            out = []
            chains_of = table.filter(table["words"].is_null())
            for g, a, a0, a1, b, b0, b1 in zip(*(chains_of[c].to_pylist() for c in ["g", *names])):
                lo, lo_b = max(0, a0 - MARGIN), max(0, b0 - MARGIN)
                (p0, p1), (q0, q1) = words_of(g, a, lo, a1 + MARGIN), words_of(g, b, lo_b, b1 + MARGIN)
                if min(p1 - p0, q1 - q0) < min_words:
                    continue
                # in texts that repeat themselves the words around may lead astray
                got = passage(p0, p1, q0, q1, lo, lo_b) or (min(a1 - a0, b1 - b0) >= min_words and passage(
                    min(p1, p0 + a0 - lo), min(p1, p0 + a1 - lo), min(q1, q0 + b0 - lo_b), min(q1, q0 + b1 - lo_b), a0, b0))
                if got:
                    out.append((a, *got[:2], b, *got[2:]))
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (zip(*out) if out else [[]] * 7)], [*names, "same"])

    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(parts, "g").sortWithinPartitions("g").mapInArrow(
        run, "a long, a0 long, a1 long, b long, b0 long, b1 long, same long")


def told_copies(docs: DataFrame) -> DataFrame:
    """With ``first``, the smallest document of the same text, and ``copy``, whether that is another one."""
    docs = docs.withColumn("key", F.md5(F.col("text").cast("binary")))
    same = (docs.groupBy("key").agg(F.min("id").alias("first"), F.max("id").alias("last"))
            .where("first < last").select(F.col("key").alias("of"), "first"))
    docs = docs.join(measured(same, 1_000_000), docs["key"] == F.col("of"), "left")
    return docs.select("id", "text", "first", F.coalesce(F.col("first") < F.col("id"), F.lit(False)).alias("copy"))


def members(docs: DataFrame, min_words: int) -> DataFrame:
    """A passage of all words for each copy of another document's text."""

    def run(batches):
        for batch in batches:
            for i, j in blocks(batch["text"]):
                raw, off = utf8(batch["text"].slice(i, j - i))
                n = np.diff(W.split_words(raw, off, W.SPACED, lower=True, hashed=False).of)
                long = n >= min_words
                n, zero = n[long], np.zeros(int(long.sum()), np.int64)
                a, b = (batch[c].slice(i, j - i).to_numpy()[long] for c in ("id", "first"))
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (a, zero, n, b, zero, n, n)],
                                                 ["a", "a0", "a1", "b", "b0", "b1", "same"])

    return docs.where("copy").select("id", "text", "first").mapInArrow(
        run, "a long, a0 long, a1 long, b long, b0 long, b1 long, same long")


def repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = K,
                      window: int = WINDOW, gap: float = GAP, min_words: int = MIN_WORDS,
                      identity: float = IDENTITY) -> DataFrame:
    """One row per passage of a document that (nearly) recurs in an earlier document.

    Columns: id, first_word, end_word (range of words, from 0), other_<id>, other_first_word,
    other_end_word, n_equal (words that agree in order), identity. Ids are integers; rows with a null id
    or null text, and texts without words, have no passages. Rows that share an id are one
    document with several texts, never compared with one another. Passages inside one document are not
    reported. Very long texts have their seeds cut whole; of their words only those around a chain are aligned.
    Of several places of a seed the smallest (document, word) is linked to, and of each text that is no copy its
    first. Copies are told by the MD5 of the text. Other columns are not read. An empty table gives no rows.
    """
    prepare(docs.sparkSession)
    docs = pick(docs, id=id_col, text=text_col).where("id IS NOT NULL AND text IS NOT NULL").withColumn(
        "id", F.col("id").cast("long"))
    told = told_copies(docs)
    found = cut(pair_chains(seed_links(told, k, window), k, gap))
    out = aligned(joined(found, k), docs, min_words, identity)
    out = out.union(members(told, min_words)).distinct()
    return out.select(F.col("a").alias(id_col), F.col("a0").alias("first_word"), F.col("a1").alias("end_word"),
                      F.col("b").alias(f"other_{id_col}"), F.col("b0").alias("other_first_word"), F.col("b1").alias("other_end_word"),
                      F.col("same").alias("n_equal"),
                      (F.col("same") / F.greatest(F.col("a1") - F.col("a0"), F.col("b1") - F.col("b0"))).alias("identity"))
