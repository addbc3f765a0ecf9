"""Two-stage record linkage: exact equi-join, then blocked best-match fuzzy join.

Semantics (kept from the reference analysis):
* exact: inner join on (title_clean, block), many-to-many, tagged ``exact``;
* the fuzzy stage sees left rows whose *title* never occurs among exact matches
  (a title matched in another block is never fuzzy-matched);
* fuzzy candidates are all right rows of the same block (also those used by an exact
  match; no one-to-one constraint); best = smallest Jaro distance, ties broken by the
  smallest ``order_col``; kept only if distance < ``max_dist`` (strict);
* fuzzy rows carry no ``title_clean`` (NULL after the union).

Scale plan:
* keys with very many rows are found by a frequent-items sketch and salted in the exact join;
* the matched titles for the anti-join come from a semi-join against the distinct
  right keys (linear), not from the many-to-many exact output;
* the best match depends only on (title, block), so both sides are reduced to distinct
  titles per block first (right side keeps ``min(order_col)``: equal titles have equal
  distances, so the smallest order wins among them);
* pairs come from a grid over (block, length band): the band is lossless for Jaro thresholds below
  1/3 (a pair within length ratio 1-3*theta is at most one band apart; the left side is
  replicated to the neighbouring bands), and every band is cut into ``sa`` x ``sb`` cells of at
  most ``cell_rows`` titles per side, so a hot block is many cells. The cell counts (one row per
  block and band) are broadcast if counted to be few: rows are salted before they are shuffled;
* in a cell (one call of an Arrow cogroup, bounded in size) the common characters of all pairs are
  counted on bit sets of (character, occurrence) tokens, which bounds the similarity; what can be
  close goes through the batch kernel, and only pairs under the threshold leave the task.
  ``block_candidates`` is the same bound as a join of the JVM, for inspection and tests;
* the parts of a ``LinkResult`` are built when first asked for: the exact stage never runs
  the size check of the fuzzy stage. Frames that several parts read are checkpointed in
  the cluster's shared folder, not cached;
* the best match per left title is a partial (map-side) ``min_by`` aggregation.
"""

from __future__ import annotations

import math
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from ..functions.jaro import close_in_cell, pairs_under
from ..functions.scalars import normalize_title
from ..session import cut_lineage

# The reference's fuzzy threshold (strict "<") and tags.
MAX_DIST = 0.12
EXACT, FUZZY = "exact", "fuzzy"

# Character groups of the bag bound: the 20 most frequent English letters and the space
# alone, rare letters and digits pooled; everything else is one "other" count. Pooling can
# only raise the bound, so it stays lossless. (23 counts keep the generated join condition
# small enough for the JIT; one count per character does not.)
BAG_GROUPS = tuple("etaoinshrdlucmwfgypb") + (" ", "vkjxqz", "0123456789")
SLACK = 1e-9


class LinkResult:
    """The parts of a two-stage link, each built when first asked for."""

    def __init__(self, a: DataFrame, b: DataFrame, a_block: str, b_block: str, order_col: str,
                 hide: tuple[str, ...], **fuzzy):
        self._a, self._b, self._blocks, self._order, self._hide = a, b, (a_block, b_block), order_col, hide
        self._options = fuzzy

    @cached_property
    def exact(self) -> DataFrame:
        return exact_link(self._a, self._b, *self._blocks).drop(*self._hide)

    @cached_property
    def unmatched(self) -> DataFrame:
        return unmatched(self._a, self._b, *self._blocks)

    @cached_property
    def _fuzzy_parts(self) -> tuple[DataFrame, DataFrame, DataFrame]:
        # candidates, best and unlinked rows all start from the unmatched ones
        un = cut_lineage(self.unmatched)
        return (un, *fuzzy_link(un, self._b, *self._blocks, self._order, **self._options))

    @property
    def close(self) -> DataFrame:
        """(a_t, blk, b_t, b_ord, dist): all pairs of unmatched titles under the threshold."""
        return self._fuzzy_parts[1]

    @cached_property
    def candidates(self) -> DataFrame:
        """The pairs that pass the bounds, for inspection; ``close`` does not go through them."""
        o = self._options
        keys = title_keys(self._fuzzy_parts[0], self._b, *self._blocks, self._order)
        return block_candidates(*keys, o["max_dist"], o["cell_rows"], o["prune"], o["broadcast_rows"])

    @cached_property
    def best(self) -> DataFrame:
        best = self._fuzzy_parts[2]
        return best.withColumn("b_ord", F.to_json("b_ord")) if self._hide else best

    @cached_property
    def fuzzy(self) -> DataFrame:
        return self._fuzzy_parts[3].drop(*self._hide)

    @cached_property
    def linked(self) -> DataFrame:
        return self.exact.unionByName(self.fuzzy, allowMissingColumns=True)

    @cached_property
    def unlinked(self) -> DataFrame:
        """J9: unmatched rows without a fuzzy partner (NULL titles stay unlinked)."""
        hit = self._fuzzy_parts[2].select(F.col("a_t").alias("title_clean"), F.col("blk").alias(self._blocks[0]))
        return self._fuzzy_parts[0].join(hit, on=["title_clean", self._blocks[0]], how="left_anti")


# ------------------------------------------------------------------ J1
#: Keys a sketch may return, items it tracks, and rows of a hot key per cell side.
HOT_KEYS, TRACKED, HOT_ROWS = 1_000, 50_000, 4_096


def hot_keys(a: DataFrame, b: DataFrame, rows: int = HOT_ROWS) -> DataFrame:
    """(h, sa, sb): into how many parts the rows of hot keys of either side are dealt.

    ``a`` and ``b`` hold the key's hash ``h``. A mergeable frequent-items sketch of bounded size per
    side (built before the shuffle, merged after) finds the keys; at most ``2 * HOT_KEYS`` rows.
    A key it misses has few rows; the join's result never depends on it.
    """
    def counted(df: DataFrame, mine: str, other: str) -> DataFrame:
        top = df.where("h IS NOT NULL").agg(F.expr(f"approx_top_k(h, {HOT_KEYS}, {TRACKED})").alias("t"))
        return top.select(F.inline("t")).select(F.col("item").alias("h"), F.col("count").alias(mine),
                                                F.lit(0).cast("long").alias(other))

    both = counted(a, "na", "nb").unionByName(counted(b, "nb", "na"))
    both = both.groupBy("h").agg(F.max("na").alias("na"), F.max("nb").alias("nb"))

    def parts(n: str) -> Column:
        return F.greatest(F.lit(1), F.ceil(F.col(n) / rows)).cast("int")

    return both.where((F.col("na") > rows) | (F.col("nb") > rows)).select("h", parts("na").alias("sa"), parts("nb").alias("sb"))


def exact_link(a: DataFrame, b: DataFrame, a_block: str, b_block: str,
               title: str = "title_clean", hot_rows: int = HOT_ROWS) -> DataFrame:
    """Inner equi-join on (title, block), many-to-many, tagged ``exact``.

    Rows of a hot key go to a grid of cells: each side's rows are dealt out over its own parts (by a
    hash of the whole row) and repeated for the other side's parts, so a cell joins about
    ``hot_rows`` rows of either side. All other rows have one cell and are not repeated.
    """
    rb = b.withColumnRenamed(b_block, a_block)
    key = F.when(F.col(title).isNotNull() & F.col(a_block).isNotNull(), F.xxhash64(title, a_block))
    left, right = a.withColumn("_h", key), rb.withColumn("_h", key)
    hot = hot_keys(left.select(F.col("_h").alias("h")), right.select(F.col("_h").alias("h")), hot_rows)

    def dealt(df: DataFrame, columns: list[str], own: str, mine: str, other_at: str, other: str) -> DataFrame:
        # nothing but the salt depends on the sketch; its few rows are broadcast
        known = df.join(F.broadcast(hot), F.col("_h") == F.col("h"), "left")
        place = F.pmod(F.xxhash64(*columns), F.coalesce(mine, F.lit(1))).cast("int")
        return (known.withColumn(own, place)
                .withColumn(other_at, F.explode(F.sequence(F.lit(0), F.coalesce(other, F.lit(1)) - 1)))
                .drop("_h", "h", "sa", "sb"))

    ls = dealt(left, a.columns, "_i", F.col("sa"), "_j", F.col("sb"))
    rs = dealt(right, rb.columns, "_j", F.col("sb"), "_i", F.col("sa"))
    return ls.join(rs, on=[title, a_block, "_i", "_j"], how="inner").drop("_i", "_j").withColumn("match_type", F.lit(EXACT))


# ------------------------------------------------------------------ J2
def unmatched(a: DataFrame, b: DataFrame, a_block: str, b_block: str,
              title: str = "title_clean") -> DataFrame:
    """Left rows whose title never occurs among exact matches (NULL titles survive).

    The matched titles come from a semi-join of the left keys with the distinct right
    keys - linear work - rather than from the many-to-many exact join output, which a
    hot (title, block) key makes quadratic.
    """
    keys_b = b.select(title, F.col(b_block).alias(a_block)).distinct()
    hit = (a.select(title, a_block).distinct().join(keys_b, on=[title, a_block], how="left_semi")
            .select(title).distinct())
    return a.join(hit, on=title, how="left_anti")


# ------------------------------------------------------------------ features
def _with_bag(df: DataFrame, t: str, prefix: str) -> DataFrame:
    """Per-title counts per character group as plain int columns, so the pair bound is
    small arithmetic inside whole-stage codegen."""
    col = F.col(t)
    # coalesce(.., 0) makes the counts non-nullable, which keeps the generated pair
    # condition small (no null branches), so the JIT compiles it sooner.
    cols = {f"{prefix}{k}": F.coalesce(F.length(col) - F.length(F.translate(col, g, "")), F.lit(0))
            for k, g in enumerate(BAG_GROUPS)}
    df = df.withColumns(cols)
    known = sum((F.col(n) for n in cols), F.lit(0))
    return df.withColumn(f"{prefix}x", F.coalesce(F.length(col) - known, F.lit(0)))


def _bag_overlap(pa: str, pb: str) -> Column:
    keys = [str(k) for k in range(len(BAG_GROUPS))] + ["x"]
    return sum((F.least(F.col(pa + k), F.col(pb + k)) for k in keys), F.lit(0))


def _jaro_bound(common: Column, la: Column, lb: Column, max_dist: float) -> Column:
    """True when m <= common matches could still reach similarity 1 - max_dist:
    (c/la + c/lb + 1)/3 >= 1 - d  <=>  c (la + lb) >= (2 - 3d) la lb  (c used once)."""
    k = 2.0 - 3.0 * max_dist - 3.0 * SLACK
    return common.cast("double") * (la + lb) >= F.lit(k) * la * lb


def _band(length: Column, max_dist: float) -> Column:
    ratio = 1.0 - 3.0 * max_dist
    if ratio <= 0.0:
        return F.lit(0)
    return F.floor(F.log(length.cast("double")) / F.lit(math.log(1.0 / ratio))).cast("int")


def _parallelism(spark) -> int:
    n = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    return max(n, spark.sparkContext.defaultParallelism)


# ------------------------------------------------------------------ J3
def block_candidates(u_keys: DataFrame, b_keys: DataFrame, max_dist: float = MAX_DIST,
                     cell_rows: int = 1024, prune: bool = True,
                     broadcast_rows: int = 200_000, broadcast_bytes: int = 64 << 20,
                     grid_rows: int = 100_000) -> DataFrame:
    """Candidate (a_t, b_t) pairs of one block that may be closer than ``max_dist``.

    ``u_keys``: (a_t, blk) distinct left titles; ``b_keys``: (b_t, blk, b_ord).
    With ``prune=False`` every pair of the block is returned (test reference).

    Strategy, chosen by a checked size: when the distinct right titles number at most
    ``broadcast_rows`` and take at most ``broadcast_bytes`` they are broadcast and the
    left titles are hash-partitioned by (a_t, blk, band), which spreads a hot block
    evenly over the tasks. Beyond that, a sort-merge join on (block, band, grid cell):
    each (block, band) key is cut into ``sa`` x ``sb`` cells of at most ``cell_rows``
    titles per side, so no key's pairs land on one task.
    """
    spark = u_keys.sparkSession
    c = F.col
    la = u_keys.select("a_t", "blk", F.coalesce(F.length("a_t"), F.lit(0)).alias("a_len"))
    lb = b_keys.select(c("b_t"), c("blk").alias("r_blk"), "b_ord",
                       F.coalesce(F.length("b_t"), F.lit(0)).alias("b_len"))
    if prune:
        la = _with_bag(la, "a_t", "a_c").withColumn("band", _band(c("a_len"), max_dist))
        lb = _with_bag(lb, "b_t", "b_c").withColumn("r_band", _band(c("b_len"), max_dist))
        if max_dist < 1 / 3:
            la = la.withColumn("band", F.explode(F.array(c("band") - 1, c("band"), c("band") + 1)))
    else:
        la = la.withColumn("band", F.lit(0))
        lb = lb.withColumn("r_band", F.lit(0))

    bound = F.lit(True)
    if prune and max_dist < 1.0:
        lo, hi = F.least(c("a_len"), c("b_len")), F.greatest(c("a_len"), c("b_len"))
        if max_dist < 1 / 3:
            bound = (lo.cast("double") / hi) >= F.lit(1.0 - 3.0 * max_dist - SLACK)
        bound = bound & _jaro_bound(_bag_overlap("a_c", "b_c"), c("a_len"), c("b_len"), max_dist)
    n = _parallelism(spark)
    keys_eq = (c("blk") == c("r_blk")) & (c("band") == c("r_band"))

    # The size check materialises the right-side features once; the join reuses them.
    # Broadcast only when both the row count and the approximate bytes (title text plus
    # the fixed-width features) are measured under their bounds.
    lb = cut_lineage(lb)
    size = lb.agg(F.count(F.lit(1)).alias("n"),
                  F.sum(F.octet_length("b_t")).alias("text_bytes")).first()
    n_rows, text_bytes = size["n"], size["text_bytes"] or 0
    approx_bytes = text_bytes + n_rows * 8 * (len(BAG_GROUPS) + 6)
    if n_rows <= broadcast_rows and approx_bytes <= broadcast_bytes:
        # Explicit count on keys that only exist after the band explode: the optimizer
        # cannot fold it into the upstream distinct's exchange, and AQE cannot coalesce
        # the fan-out (join + Jaro) stage into a few tasks because its input is small.
        ls = la.repartition(n, "a_t", "blk", "band")
        pairs = ls.join(F.broadcast(lb), keys_eq & bound, "inner")
        return pairs.select("a_t", "blk", "b_t", "b_ord")

    # Grid salting of hot keys: sizes per (blk, band) are small aggregates.
    la = cut_lineage(la)
    na = la.groupBy("blk", "band").agg(F.count(F.lit(1)).alias("na"))
    nb = lb.groupBy(c("r_blk").alias("blk"), c("r_band").alias("band")).agg(F.count(F.lit(1)).alias("nb"))
    grid = na.join(nb, ["blk", "band"]).select(
        "blk", "band",
        F.ceil(c("na") / F.lit(cell_rows)).cast("int").alias("sa"),
        F.ceil(c("nb") / F.lit(cell_rows)).cast("int").alias("sb"))
    # One row per block and band: counted, then broadcast, so no row is shuffled on the bare
    # key; with very many blocks (no hot ones among so many) the join shuffles.
    grid = cut_lineage(grid)
    few = grid.count() <= grid_rows
    rgrid = grid.select(c("blk").alias("r_blk"), c("band").alias("r_band"), "sa", "sb")
    if few:
        grid, rgrid = F.broadcast(grid), F.broadcast(rgrid)
    ls = (la.join(grid, ["blk", "band"])
            .withColumn("i", F.pmod(F.xxhash64("a_t"), c("sa")).cast("int"))
            .withColumn("j", F.explode(F.sequence(F.lit(0), c("sb") - 1)))
            .drop("sa", "sb")
            .repartition(n, "blk", "band", "i", "j"))
    rs = (lb.join(rgrid, ["r_blk", "r_band"])
            .withColumn("r_j", F.pmod(F.xxhash64("b_t"), c("sb")).cast("int"))
            .withColumn("r_i", F.explode(F.sequence(F.lit(0), c("sa") - 1)))
            .drop("sa", "sb")
            .repartition(n, "r_blk", "r_band", "r_i", "r_j"))
    cond = keys_eq & (c("i") == c("r_i")) & (c("j") == c("r_j")) & bound
    return ls.join(rs, cond, "inner").select("a_t", "blk", "b_t", "b_ord")


# ------------------------------------------------------------------ J3 + J4 by cells
def close_pairs(u_keys: DataFrame, b_keys: DataFrame, max_dist: float = MAX_DIST, floor: bool = False,
                cell_rows: int = 4096, grid_rows: int = 100_000) -> DataFrame:
    """(a_t, blk, b_t, b_ord, dist): all pairs of one block closer than ``max_dist``.

    Titles of a (block, length band) are dealt out by hash in a grid of cells of about ``cell_rows``
    titles a side, so a hot block is many cells and a task holds a few of them. In a cell the
    common characters of all pairs are counted on bit sets (``close_in_cell``), and only pairs that
    can be close enough are compared; nothing but close pairs leaves the task. Small cells
    share a task's group, so many small blocks cost no call each.
    """
    c = F.col
    n = _parallelism(u_keys.sparkSession)
    la = u_keys.select("a_t", "blk", _band(F.length("a_t"), max_dist).alias("band"))
    if max_dist < 1 / 3:
        la = la.withColumn("band", F.explode(F.array(c("band") - 1, c("band"), c("band") + 1)))
    lb = b_keys.select("b_t", "blk", "b_ord", _band(F.length("b_t"), max_dist).alias("band"))
    la, lb = cut_lineage(la), cut_lineage(lb)
    na = la.groupBy("blk", "band").agg(F.count(F.lit(1)).alias("na"))
    nb = lb.groupBy("blk", "band").agg(F.count(F.lit(1)).alias("nb"))
    grid = cut_lineage(na.join(nb, ["blk", "band"]).select(
        "blk", "band", F.ceil(c("na") / cell_rows).cast("int").alias("sa"),
        F.ceil(c("nb") / cell_rows).cast("int").alias("sb"),
        (c("na") * F.ceil(c("nb") / cell_rows) + c("nb") * F.ceil(c("na") / cell_rows)).alias("rows")))
    known = grid.agg(F.count(F.lit(1)).alias("n"), F.sum("rows").alias("rows"),
                     F.sum(c("sa").cast("long") * c("sb")).alias("cells")).first()
    groups = max(4 * n, -(-(known["rows"] or 0) // (2 * cell_rows)))
    # a cell is few bytes and much work: as many tasks as asked for, which Spark would merge by their bytes
    tasks = max(1, min(n, known["cells"] or 0))

    def celled(side: DataFrame, own: str, mine: str, other: str, t: str) -> DataFrame:
        cells = grid.select(c("blk").alias("g_blk"), c("band").alias("g_band"), "sa", "sb")
        if known["n"] <= grid_rows:
            cells = F.broadcast(cells)
        dealt = (side.join(cells, (c("blk") == c("g_blk")) & (c("band") == c("g_band")))
                 .withColumn(own, F.pmod(F.xxhash64(t), c(mine)).cast("int"))
                 .withColumn("j" if own == "i" else "i", F.explode(F.sequence(F.lit(0), c(other) - 1))))
        cell = F.pmod(F.xxhash64("blk", "band", "i", "j"), F.lit(groups))
        return dealt.select(*[c(x).alias(x) for x in (*side.columns, "i", "j")], cell.alias("cell")).repartition(tasks, "cell")

    left = celled(la, "i", "sa", "sb", "a_t")
    right = celled(lb, "j", "sb", "sa", "b_t")
    schema = StructType([u_keys.schema["a_t"], u_keys.schema["blk"], b_keys.schema["b_t"], b_keys.schema["b_ord"],
                         StructField("dist", DoubleType())])
    keys = ["blk", "band", "i", "j"]

    def match(ls: pa.Table, rs: pa.Table) -> pa.Table:
        def places(table):
            found: dict[tuple, list[int]] = {}
            for at, key in enumerate(zip(*[table[k].to_pylist() for k in keys])):
                found.setdefault(key, []).append(at)
            return found

        mine, theirs = places(ls), places(rs)
        xs, ys = ls["a_t"].to_pylist(), rs["b_t"].to_pylist()
        ia, ib, dist = [], [], []
        for key, rows in mine.items():
            if key in theirs:
                a, b, d = close_in_cell([xs[i] for i in rows], [ys[i] for i in theirs[key]], max_dist, floor)
                ia.append(np.array(rows)[a])
                ib.append(np.array(theirs[key])[b])
                dist.append(d)
        none = np.zeros(0, np.int64)
        ia, ib = pa.array(np.concatenate([none, *ia])), pa.array(np.concatenate([none, *ib]))
        return pa.table({"a_t": ls["a_t"].take(ia), "blk": ls["blk"].take(ia), "b_t": rs["b_t"].take(ib),
                         "b_ord": rs["b_ord"].take(ib), "dist": np.concatenate([np.zeros(0), *dist])})

    return left.groupBy("cell").cogroup(right.groupBy("cell")).applyInArrow(match, schema)


# ------------------------------------------------------------------ J5
def best_match(pairs: DataFrame, max_dist: float = MAX_DIST, floor: bool = False) -> DataFrame:
    """Pairs under ``max_dist`` (J4, one Python pass, unless ``dist`` is there already), then the
    best right title per left (title, block) by (distance, order): a partial (map-side) ``min_by``."""
    close = pairs if "dist" in pairs.columns else pairs_under(pairs, "a_t", "b_t", max_dist, floor)
    return (close.groupBy("a_t", "blk")
            .agg(F.min_by(F.struct("b_t", "b_ord", "dist"), F.struct("dist", "b_ord")).alias("m"))
            .select("a_t", "blk", F.col("m.b_t").alias("b_t"), F.col("m.b_ord").alias("b_ord"),
                    F.col("m.dist").alias("dist")))


# ------------------------------------------------------------------ J6
def title_keys(u: DataFrame, b: DataFrame, a_block: str, b_block: str, order_col: str,
               title: str = "title_clean") -> tuple[DataFrame, DataFrame]:
    """Distinct (a_t, blk) of the left rows; (b_t, blk, b_ord) of the right ones."""
    valid_a = F.col(title).isNotNull() & (F.col(title) != "") & F.col(a_block).isNotNull()
    valid_b = F.col(title).isNotNull() & (F.col(title) != "") & F.col(b_block).isNotNull()
    u_keys = u.where(valid_a).select(F.col(title).alias("a_t"), F.col(a_block).alias("blk")).distinct()
    b_keys = (b.where(valid_b).groupBy(F.col(title).alias("b_t"), F.col(b_block).alias("blk"))
               .agg(F.min(order_col).alias("b_ord")))
    return u_keys, b_keys


def fuzzy_link(u: DataFrame, b: DataFrame, a_block: str, b_block: str, order_col: str,
               max_dist: float = MAX_DIST, floor: bool = False, cell_rows: int = 4096,
               prune: bool = True, title: str = "title_clean", broadcast_rows: int = 200_000) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Fuzzy rows for the unmatched left rows. Returns (close pairs, best, fuzzy).

    ``prune=False`` compares every pair of a block (test reference).
    """
    u_keys, b_keys = title_keys(u, b, a_block, b_block, order_col, title)
    if prune:
        close = close_pairs(u_keys, b_keys, max_dist, floor, cell_rows)
    else:
        close = pairs_under(block_candidates(u_keys, b_keys, max_dist, cell_rows, False, broadcast_rows),
                            "a_t", "b_t", max_dist, floor)
    best = best_match(close, max_dist, floor)

    c = F.col
    right_payload = [x for x in b.columns if x not in (title, b_block)]
    rb = b.select(c(title).alias("_b_t"), c(b_block).alias("_b_blk"), *right_payload)
    picked = best.select(c("a_t").alias("_a_t"), c("blk").alias("_a_blk"),
                         c("b_t").alias("_p_t"), c("b_ord").alias("_p_ord"))
    picked = picked.join(rb, (c("_p_t") == c("_b_t")) & (c("_a_blk") == c("_b_blk"))
                         & c("_p_ord").eqNullSafe(c(order_col)))
    # One right row per left title even if the order value repeats: the smallest by all columns.
    picked = (picked.groupBy("_a_t", "_a_blk").agg(F.min(F.struct(order_col, *[x for x in right_payload if x != order_col])).alias("_r"))
              .select("_a_t", "_a_blk", *[F.col("_r")[x].alias(x) for x in right_payload]))
    left_payload = [x for x in u.columns if x != title]
    fz = (u.join(picked, (c(title) == c("_a_t")) & (c(a_block) == c("_a_blk")))
           .select(*left_payload, *right_payload)
           .withColumn("match_type", F.lit(FUZZY)))
    return close, best, fz


# ------------------------------------------------------------------ J7
def prepare_sides(a: DataFrame, b: DataFrame, a_title: str = "title", b_title: str = "title") -> tuple[DataFrame, DataFrame]:
    """Add ``title_clean`` (C2) to both sides."""
    return (a.withColumn("title_clean", normalize_title(F.col(a_title))),
            b.withColumn("title_clean", normalize_title(F.col(b_title))))


AUTO_ORDER = "_b_order"


def link(a: DataFrame, b: DataFrame, a_block: str, b_block: str, order_col: str | None,
         b_cols: list[str] | None = None, max_dist: float = MAX_DIST, floor: bool = False,
         cell_rows: int = 4096, prune: bool = True, broadcast_rows: int = 200_000,
         cut_inputs: bool = False, dedupe_right: bool = False) -> LinkResult:
    """Two-stage link of left ``a`` and right ``b``; both need ``title_clean``.

    ``b_cols``: right payload columns to carry (C8 projection; default all right
    columns). ``order_col`` is the right tie-break (file order in the reference); it
    should be unique per right row. ``None`` orders by all right columns instead
    (deterministic; identical right rows are interchangeable, one is kept).
    ``cut_inputs`` checkpoints both narrow inputs, which are read three to four times;
    ``dedupe_right`` keeps the first right row of each (title, block) only.
    """
    keep = b_cols if b_cols is not None else [c for c in b.columns if c not in ("title_clean", b_block)]
    hide: tuple[str, ...] = ()
    if order_col is None:
        order_col, hide = AUTO_ORDER, (AUTO_ORDER,)
        cols = set(keep) | {"title_clean", b_block}
        b = b.withColumn(AUTO_ORDER, F.struct(*[F.col(x) for x in b.columns if x in cols]))
    if order_col not in keep:
        keep = [order_col] + list(keep)
    clash = (set(keep) & set(a.columns)) - {"title_clean"}
    if clash:
        raise ValueError(f"right columns also on the left side, rename them first: {sorted(clash)}")
    rb = b.select("title_clean", b_block, *keep)
    if dedupe_right:
        rest = [x for x in keep if x != order_col]
        rb = (rb.groupBy("title_clean", b_block).agg(F.min(F.struct(order_col, *rest)).alias("_r"))
              .select("title_clean", b_block, *[F.col("_r")[x].alias(x) for x in keep]))
    if cut_inputs:
        a, rb = cut_lineage(a), cut_lineage(rb)
    return LinkResult(a, rb, a_block, b_block, order_col, hide, max_dist=max_dist, floor=floor,
                      cell_rows=cell_rows, prune=prune, broadcast_rows=broadcast_rows)


# ------------------------------------------------------------------ J8
def link_report(linked: DataFrame, rating_a: str = "rating_a", b_norm: str = "b_norm") -> DataFrame:
    """One row: n exact, n fuzzy, n total, mean of both ratings."""
    return linked.agg(
        F.count_if(F.col("match_type") == EXACT).alias("n_exact"),
        F.count_if(F.col("match_type") == FUZZY).alias("n_fuzzy"),
        F.count(F.lit(1)).alias("n_total"),
        F.avg(rating_a).alias("avg_rating_a"),
        F.avg(b_norm).alias("avg_b_norm"))
