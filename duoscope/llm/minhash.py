"""Near-duplicates by MinHash: minima of universal hashes, banding, verification, components.

1. Per text: the set of distinct word shingles, its 128-bit hash, and ``HASHES`` minima of
   multiply-shift hashes. Texts with one and the same set form a class (copies are never
   paired); everything below works on classes.
2. The minima are cut into ``HASHES / ROWS`` bands. Two sets of similarity 0.85 agree in no
   band with probability (1 - 0.85^4)^32 < 1e-10. Each task links the classes of a bucket to
   one of them and sends one row per bucket onwards, so a bucket's shuffled rows are bounded
   by the number of tasks; the same is done across tasks. These pairs grow in proportion to rows.
3. Each class keeps the link with most common bands; signature agreement (a loose bound), then
   the full shingle sets decide. Components of the confirmed links come from alternating
   large-star and small-star steps.
4. Classes that share any bucket lie in one component of the unconfirmed links. Where such a
   group holds one component of confirmed links only, it is done. In the others a class of which
   more than the rest of its set occurs in its own component only can have no link outside and goes
   (``linkable``: one aggregation over the sets' items), so texts that share a template, but not
   enough of it, are never paired. Every pair of the classes left, of different components, is
   compared: members are dealt out in cells of about ``CELL`` x ``CELL`` with their full sets, one
   pass over a cell's shingles gives a class's intersections with all the others, and a cell emits
   the links that join components, at most one per class. So no link is lost but by banding's
   1e-10. Those last pairs grow with the square of a group whose members are nearly all alike enough.

Null texts and texts without words have empty sets; very long texts are read whole, in batches bounded by
bytes; ties of similarity and of id cannot change a component; repeated rows are one class.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from duoscope.llm import words as W
from duoscope.llm.common import blocks, cut, measured, pick, prepare, release, runs, utf8

SHINGLE, HASHES, ROWS = 3, 128, 4
PERCENT = 85            # links: 100 * |A and B| >= PERCENT * |A or B|
CELL = 256
BROADCAST_ROWS = 100_000       # of about 50 bytes
SEED = 20240301


def shingle_sets(column: pa.Array, k: int = SHINGLE):
    """Per text: sorted distinct 64-bit hashes of its k-word runs (of all words if fewer)."""
    for i, j in blocks(column):
        raw, off = utf8(column.slice(i, j - i))
        w = W.split_words(raw, off, W.SPACED, lower=True)
        g = W.mix(W.grams(w.hash, k))
        for a, b in zip(w.of[:-1], w.of[1:]):
            if b - a >= k:
                yield np.unique(g[a:b - k + 1])
            elif b > a:
                yield W.mix(W.grams(w.hash[a:b], b - a))
            else:
                yield np.zeros(0, np.uint64)


def _coefficients(n: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(seed)
    return (rng.integers(0, 1 << 32, n, np.uint32) | np.uint32(1)), rng.integers(0, 1 << 32, n, np.uint32)


def signature(shingles: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Minimum of a_i * x + b_i (mod 2^32) over the set, for each i."""
    x = (shingles >> np.uint64(32)).astype(np.uint32)
    low = np.full(len(a), np.uint32(0xFFFFFFFF))
    for s in range(0, len(x), 2048):
        np.minimum(low, (x[s:s + 2048, None] * a[None, :] + b[None, :]).min(0), out=low)
    return low


def band_hashes(sig: np.ndarray, rows: int = ROWS) -> np.ndarray:
    """[n, hashes] -> [n, bands]: one 64-bit key for each band's minima and the band's number."""
    n, h = sig.shape
    parts = sig.reshape(n, h // rows, rows).astype(np.uint64)
    out = np.arange(h // rows, dtype=np.uint64)[None, :] * np.uint64(0x632BE59BD9B4E019)
    out = np.repeat(out, n, 0)
    for r in range(rows):
        out = W.mix(out + parts[:, :, r])
    return out.view(np.int64)


def _signatures(column: pa.Array, hashes: int) -> np.ndarray:
    return utf8(column)[0].view(np.uint32).reshape(len(column), hashes)


def set_key(shingles: np.ndarray) -> bytes:
    import hashlib

    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def signed(docs: DataFrame, k: int, hashes: int, seed: int) -> DataFrame:
    """id, n (set size), key (128 bits of the set), sig (minima) of every row."""
    a, b = _coefficients(hashes, seed)

    def run(batches):
        for batch in batches:
            n, key, sig = [], [], []
            for s in shingle_sets(batch["text"], k):
                n.append(len(s))
                key.append(set_key(s))
                sig.append(signature(s, a, b).tobytes())
            yield pa.RecordBatch.from_pydict({
                "id": batch["id"], "n": pa.array(n, pa.int64()), "key": pa.array(key, pa.binary()),
                "sig": pa.array(sig, pa.binary())})

    return docs.mapInArrow(run, T.StructType([
        docs.schema["id"], T.StructField("n", T.LongType()), T.StructField("key", T.BinaryType()),
        T.StructField("sig", T.BinaryType())]))


def _star(bucket: np.ndarray, node: np.ndarray):
    """Rows of one bucket each against the bucket's first: (sorted order, hub of each, is hub)."""
    order = np.lexsort((node, bucket))
    b = bucket[order]
    first = np.concatenate(([True], b[1:] != b[:-1])) if len(b) else np.zeros(0, bool)
    hub = node[order][np.maximum.accumulate(np.where(first, np.arange(len(b)), 0))] if len(b) else node
    return order, hub, first


def star_links(classes: DataFrame, hashes: int, rows: int) -> DataFrame:
    """a (hub), b, bands: pairs of a class and its bucket's hub, with the bands they share."""

    def inside(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = band_hashes(_signatures(batch["sig"], hashes), rows)
            node = np.repeat(batch["node"].to_numpy(), keys.shape[1])
            keys = keys.reshape(-1)
            order, hub, first = _star(keys, node)
            # a hub goes on to its bucket; a link goes to any task (by a mix of its ends)
            bucket = np.where(first, keys[order], W.mix(node[order].astype(np.uint64)).view(np.int64))
            yield pa.RecordBatch.from_pydict({
                "bucket": pa.array(bucket), "node": pa.array(node[order]),
                "hub": pa.array(hub, mask=first)})

    def across(batches):
        last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            hub = batch["hub"]
            linked = np.asarray(hub.is_valid())
            node, bucket = batch["node"].to_numpy(), batch["bucket"].to_numpy()
            a, b = [np.asarray(hub.drop_null())], [node[linked]]
            node, bucket = node[~linked], bucket[~linked]
            if len(node):
                new = np.concatenate(([last is None or bucket[0] != last[0]], bucket[1:] != bucket[:-1]))
                at = np.maximum.accumulate(np.where(new, np.arange(len(node)), -1))
                head = np.where(at >= 0, node[np.maximum(at, 0)], last[1] if last else 0)
                a.append(head[~new])
                b.append(node[~new])
                last = (bucket[-1], head[-1])
            yield pa.RecordBatch.from_pydict({"a": pa.array(np.concatenate(a), pa.int64()),
                                              "b": pa.array(np.concatenate(b), pa.int64())})

    parts = int(classes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = (classes.select("node", "sig").mapInArrow(inside, "bucket long, node long, hub long")
             .repartition(parts, "bucket").sortWithinPartitions("bucket", "node")
             .mapInArrow(across, "a long, b long"))
    return found.where("a <> b").groupBy(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).agg(
        F.count("*").alias("bands"))


def _agree(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return (x == y).mean(1)


def loose(percent: float, hashes: int) -> float:
    """Signature agreement that a linked pair misses with probability under 1e-8."""
    p = percent / 100
    return p - 6.2 * math.sqrt(p * (1 - p) / hashes)


def verified(pairs: DataFrame, classes: DataFrame, docs: DataFrame, k: int, hashes: int, percent: float) -> DataFrame:
    """The pairs a, b of classes whose signatures may pass and whose full sets do."""
    least = loose(percent, hashes)

    def may(batches):
        for batch in batches:
            x, y = _signatures(batch["sig_a"], hashes), _signatures(batch["sig_b"], hashes)
            n, m = batch["n_a"].to_numpy(), batch["n_b"].to_numpy()
            ok = (_agree(x, y) >= least) & (100 * np.minimum(n, m) >= percent * np.maximum(n, m))
            yield pa.RecordBatch.from_pydict({"a": batch["a"], "b": batch["b"]}).filter(pa.array(ok))

    side = {x: classes.select(F.col("node").alias(x), F.col("n").alias(f"n_{x}"), F.col("sig").alias(f"sig_{x}"))
            for x in "ab"}
    likely = cut(pairs.select("a", "b").join(side["a"], "a").join(side["b"], "b").mapInArrow(may, "a long, b long"))
    if likely.isEmpty():
        return likely
    sets = _sets(likely.select(F.explode(F.array("a", "b")).alias("node")).distinct(), classes, docs, k)
    both = (likely.join(sets.withColumnsRenamed({"node": "b", "items": "items_b"}), "b")
            .join(sets.withColumnsRenamed({"node": "a", "items": "items_a"}), "a"))

    def sure(batches):
        for batch in batches:
            ok = []
            for x, y in zip(batch["items_a"], batch["items_b"]):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                common = len(np.intersect1d(x, y, assume_unique=True))
                ok.append(100 * common >= percent * (len(x) + len(y) - common))
            yield pa.RecordBatch.from_pydict({"a": batch["a"], "b": batch["b"]}).filter(pa.array(ok, pa.bool_()))

    return both.mapInArrow(sure, "a long, b long")


def _sets(nodes: DataFrame, classes: DataFrame, docs: DataFrame, k: int) -> DataFrame:
    """node, items (sorted hashes) of the classes ``node``, from one text of each."""
    chosen = classes.join(nodes, "node", "left_semi").select("node", "key", "rep")

    def run(batches):
        for batch in batches:
            sets = list(shingle_sets(batch["text"], k))
            mine = [set_key(s) == key for s, key in zip(sets, batch["key"].to_pylist())]
            yield pa.RecordBatch.from_pydict({
                "node": batch["node"], "items": pa.array([s.tobytes() for s in sets], pa.binary()),
            }).filter(pa.array(mine, pa.bool_()))

    # a repeated id can bring texts of other classes (dropped by key) or the same one twice
    chosen = measured(chosen, BROADCAST_ROWS)
    return (docs.join(chosen, docs["id"].eqNullSafe(chosen["rep"]))
            .select("node", "key", "text")
            .mapInArrow(run, "node long, items binary").dropDuplicates(["node"]))


def _open(member: DataFrame, cell: int) -> DataFrame:
    """The groups with more than one component: grp, its largest (big), cells of it (nb), of the others (no)."""
    per_label = member.groupBy("grp", "label").agg(F.count("*").alias("m"))
    return (per_label.groupBy("grp").agg(F.sum("m").alias("total"), F.max(F.struct("m", "label")).alias("big"),
                                         F.count("*").alias("labels"))
            .where("labels > 1")
            .select("grp", F.col("big.label").alias("big"), F.ceil(F.col("big.m") / cell).cast("int").alias("nb"),
                    F.ceil((F.col("total") - F.col("big.m")) / cell).cast("int").alias("no")))


def linkable(member: DataFrame, sets: DataFrame, percent: float) -> DataFrame:
    """The rows of ``member`` whose set can link to another component of their group.

    A link needs a common part of at least ``percent`` of the set. A member is left out if more of its
    set than the rest occurs in its own component only (the prefix filter for tokens of frequency
    one): texts that share a template, but not enough of it, go here, before any pair is made.
    """
    def items(batches):
        for batch in batches:
            raw, off = utf8(batch["items"])
            n = np.diff(off) // 8
            yield pa.RecordBatch.from_pydict({
                "grp": pa.array(np.repeat(batch["grp"].to_numpy(), n)), "label": pa.array(np.repeat(batch["label"].to_numpy(), n)),
                "node": pa.array(np.repeat(batch["node"].to_numpy(), n)), "n": pa.array(np.repeat(n, n)),
                "item": pa.array(raw.view(np.int64))})

    schema = "grp long, label long, node long, n long, item long"
    every = member.select("grp", "label", "node").join(sets, "node").select("grp", "label", "node", "items").mapInArrow(items, schema)
    alone = every.groupBy("grp", "item").agg(F.min("label").alias("least"), F.max("label").alias("most")).where(
        "least = most").select("grp", "item")
    own = (every.join(alone, ["grp", "item"]).groupBy("grp", "node")
           .agg(F.count("*").alias("own"), F.max("n").alias("n")))
    apart = own.where(F.col("n") - F.col("own") < F.ceil(F.col("n") * percent / 100.0 - 1e-9)).select("grp", "node")
    return member.join(apart, ["grp", "node"], "left_anti")


def rest_links(classes: DataFrame, docs: DataFrame, star: DataFrame, labels: DataFrame, k: int,
               percent: float, cell: int = CELL) -> DataFrame:
    """Links a, b between components of confirmed links (``labels``) that share a group of ``star``."""
    groups = components(star)
    roots = groups.select(F.col("root").alias("node"), "root").distinct()
    member = (groups.union(roots).withColumnRenamed("root", "grp").join(labels, "node", "left")
              .select("grp", "node", F.coalesce("root", "node").alias("label")))
    member = cut(member.join(_open(member, cell).select("grp"), "grp"))
    if member.isEmpty():
        return member.select(F.col("node").alias("a"), F.col("node").alias("b"))
    sets = cut(_sets(member.select("node"), classes, docs, k))
    member = cut(linkable(member, sets, percent))
    member = member.join(_open(member, cell), "grp")
    # the largest component of a group meets the others' cells, the others also one another
    part = lambda n: F.pmod(F.xxhash64("node"), n).cast("int")
    dealt = (member
             .withColumn("mine", F.when(F.col("label") == F.col("big"), part(F.col("nb"))).otherwise(part(F.col("no"))))
             .withColumn("cells", F.expr("""
                 IF(label = big,
                    transform(sequence(0, no - 1), j -> struct(0 AS kind, mine AS x, j AS y)),
                    concat(transform(sequence(0, nb - 1), i -> struct(0 AS kind, i AS x, mine AS y)),
                           transform(sequence(0, no - 1), j -> struct(1 AS kind, least(j, mine) AS x, greatest(j, mine) AS y))))"""))
             .select("grp", "node", "label", (F.col("label") == F.col("big")).alias("in_big"), F.explode("cells").alias("c"))
             .select("grp", "c.kind", "c.x", "c.y", "node", "label", "in_big"))
    dealt = dealt.join(sets, "node")

    def compare(batches):
        for group in runs(batches, ["grp", "kind", "x", "y"]):
            a, b = joining_links(group["node"].to_numpy(), group["label"].to_numpy(),
                                 np.asarray(group["in_big"]), group["items"].combine_chunks(), percent)
            if len(a):
                yield pa.RecordBatch.from_pydict({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    parts = int(classes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    key = ["grp", "kind", "x", "y"]
    return (dealt.repartition(parts, *key).sortWithinPartitions(*key, "node")
            .mapInArrow(compare, "a long, b long").distinct())


def joining_links(node: np.ndarray, label: np.ndarray, in_big: np.ndarray, items: pa.Array, percent: float):
    """Links that join different labels in one cell: every pair is judged until its labels are one.

    Members of the cell's largest component are not compared with one another.
    """
    raw, off = utf8(items)
    _, ids = np.unique(raw.view(np.uint64), return_inverse=True)
    off = off // 8
    size = np.diff(off)
    now = np.unique(label, return_inverse=True)[1]
    mark = np.zeros(int(ids.max()) + 1, bool)
    a, b = [], []
    for i in np.flatnonzero(~in_big).tolist():
        apart = now != now[i]
        if not apart.any():
            break
        mine = ids[off[i]:off[i + 1]]
        mark[mine] = True
        common = np.add.reduceat(mark[ids], off[:-1], dtype=np.int64)
        mark[mine] = False
        for j in np.flatnonzero(apart & (100 * common >= percent * (size + size[i] - common))).tolist():
            if now[j] != now[i]:
                a.append(int(min(node[i], node[j])))
                b.append(int(max(node[i], node[j])))
                now[now == now[j]] = now[i]
    return a, b


def components(links: DataFrame) -> DataFrame:
    """node, root of every node with a link; root is the smallest node of its component.

    Large-star links each node's larger neighbours to its smallest one, small-star the smaller
    ones; alternating them ends with every node linked to its root alone.
    """
    e = cut(links.select(F.least("a", "b").alias("v"), F.greatest("a", "b").alias("u"))
            .where("u <> v").distinct())
    mark = None
    while True:
        state = e.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if state == mark or not state["n"]:
            return e.select(F.col("u").alias("node"), F.col("v").alias("root"))
        mark = state
        both = e.select("u", "v").union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u")
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).union(
            low.select("u", F.col("m").alias("v")))
        e = cut(small.where("u <> v").distinct())
        del both, low, large, small
        release(e.sparkSession)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                    percent: float = PERCENT, hashes: int = HASHES, rows: int = ROWS,
                    seed: int = SEED) -> DataFrame:
    """One row per row: id, n_shingles, component_id (smallest id of its component).

    Null texts and texts without words have an empty set and are components of their own. Rows
    with equal ids count as documents of their own with the same name; null ids are never the
    smallest (component_id is null where a component has no other). Columns other than id and
    text are not read. Spark checkpoints are written under spark.checkpoint.dir.
    """
    prepare(docs.sparkSession)
    docs = pick(docs, id=id_col, text=text_col)
    all_rows = cut(signed(docs, shingle, hashes, seed))
    classes = cut(all_rows.where("n > 0").groupBy("key")
                  .agg(F.min("id").alias("rep"), F.first("n").alias("n"), F.first("sig").alias("sig"))
                  .withColumn("node", F.monotonically_increasing_id()))
    star = cut(star_links(classes, hashes, rows))
    best = star.groupBy("b").agg(F.max(F.struct(F.col("bands"), (-F.col("a")).alias("a"))).alias("x")).select(
        (-F.col("x.a")).alias("a"), "b")
    first = cut(verified(best, classes, docs, shingle, hashes, percent))
    release(docs.sparkSession)
    labels = components(first)
    second = rest_links(classes, docs, star, labels, shingle, percent)
    labels = components(labels.select(F.col("node").alias("a"), F.col("root").alias("b")).union(second))
    named = classes.select("node", "key", "rep").join(labels, "node", "left").withColumn(
        "root", F.coalesce("root", "node"))
    smallest = named.groupBy("root").agg(F.min("rep").alias("component_id"))
    by_key = named.join(smallest, "root").select("key", "component_id")
    out = all_rows.select("id", "n", "key").join(by_key, "key", "left")
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"),
                      F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id")).alias("component_id"))
