"""Merkle manifest of a dataset: leaf digests, a tree per group, one root, and a proof per row.

Rows become leaves in the order of their id within their group; every run of ``fanout`` nodes
becomes their parent until a group has one node, and the groups' nodes, in the order of the
groups, become the root the same way.

* *Order.* Rows are dealt out by range of (group, id), numbered inside their partition and
  written once; counts by (group, partition), a row per partition and group, turn that into
  places in the group. No task sorts or numbers a whole group.
* *Slot pivot.* One aggregation per level: the place divided by the fanout names the parent, the
  rest the slot, and a conditional aggregate for each slot spreads the children into columns.
  Their concatenation is hashed. Children stand next to each other, so the map side does
  nearly all of it, and a level has a ``fanout``-th of the rows of the one below.
* *Siblings.* From the top down, a parent's row makes its children's proofs: the columns left and
  right of the own slot, before the steps that the parent has itself. No proof is shuffled at the
  widest level; the rows that move are the parents'.

Levels are written in the shared checkpoint folder, since each is read on the way up and down.

Defined results: null values hash as ``-`` and so differ from empty ones, and a null group is a group; very
long texts are hashed whole; null ids come first; ties of the id stand by leaf digest, so repeated
rows are leaves next to each other (equal, hence in any order); the order of the input rows never
matters; a group of one row has its leaf as node; an only group's node is the root; an empty table
gives an empty table; other columns are read only if they are named.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from duoscope.llm.common import cut, measured

FANOUT = 16


def digest(*columns: Column | str) -> Column:
    """Lowercase hex SHA-256 of values one after the other; digests go in as hex text."""
    return F.sha2(F.concat(*[F.col(c) if isinstance(c, str) else c for c in columns]), 256)


def field(value: Column) -> Column:
    """``-`` for null, else the length in UTF-8 bytes, a colon and the value."""
    text = value.cast("string")
    return F.when(text.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf(*columns: Column | str) -> Column:
    return digest(*[field(F.col(c) if isinstance(c, str) else c) for c in columns])


def proof_text(path: Column) -> Column:
    """The siblings of every level, left to right, from the leaf to the root."""
    return F.array_join(F.transform(path, lambda x: F.concat(x["left"], x["right"])), "")


def fold(node: Column, path: Column) -> Column:
    """The root that follows from a leaf and its path."""
    return F.aggregate(path, node, lambda below, x: F.sha2(F.concat(x["left"], below, x["right"]), 256))


def _join(a: DataFrame, b: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Equi-join on ``keys`` in which nulls are equal; the columns of ``b`` besides them are added."""
    other = b.withColumnsRenamed({k: f"{k}_b" for k in keys})
    test = F.lit(True)
    for k in keys:
        test = test & F.col(k).eqNullSafe(F.col(f"{k}_b"))
    return a.join(other, test, how).drop(*[f"{k}_b" for k in keys])


def _numbered(rows: DataFrame, group: list[str], order: list[str]) -> DataFrame:
    """Adds ``place`` (from 0) in the group and ``n``, the group's rows. ``row`` splits equal rows."""
    keys = [F.col(c).asc_nulls_first() for c in [*group, *order, "row"]]
    dealt = (rows.withColumn("row", F.monotonically_increasing_id())
             .repartitionByRange(*keys).sortWithinPartitions(*keys)
             .withColumn("row", F.monotonically_increasing_id()))
    dealt = cut(dealt).withColumn("part", F.shiftright("row", 33))
    counts = dealt.groupBy(*group, "part").agg(F.min("row").alias("first"), F.count("*").alias("rows"))
    by_part = Window.partitionBy(*group).orderBy("part")
    starts = measured(counts.select(
        *group, "part", "first", (F.sum("rows").over(by_part) - F.col("rows")).alias("before"),
        F.sum("rows").over(Window.partitionBy(*group)).alias("n")))
    return _join(dealt, starts, [*group, "part"]).select(
        *rows.columns, (F.col("row") - F.col("first") + F.col("before")).alias("place"), "n")


def _tree(nodes: DataFrame, group: list[str], fanout: int) -> tuple[DataFrame, DataFrame]:
    """Of (group, n, place, node struct with hash): (group, top hash) and (group, node, path)."""
    pivots, tops = [], []
    level = nodes.select(*group, "n", "place", "node")
    slots = [f"slot{k}" for k in range(fanout)]
    while True:
        tops.append(level.where("n = 1").select(*group, F.col("node.hash").alias("top")))
        slot = F.col("place") % fanout
        pivot = (level.where("n > 1")
                 .groupBy(*group, "n", F.floor(F.col("place") / fanout).cast("long").alias("place"))
                 .agg(*[F.first(F.when(slot == k, F.col("node")), ignorenulls=True).alias(s)
                        for k, s in enumerate(slots)])
                 .withColumn("hash", F.sha2(F.concat_ws("", *[f"{s}.hash" for s in slots]), 256))
                 .withColumn("n", F.floor((F.col("n") + (fanout - 1)) / fanout).cast("long")))
        pivot = cut(pivot)
        if pivot.isEmpty():
            break
        pivots.append(pivot)
        level = pivot.select(*group, "n", "place", F.struct("hash").alias("node"))

    none = F.array().cast("array<struct<left:string,right:string>>")
    below = None
    for pivot in reversed(pivots):
        if below is None:
            parents = pivot.withColumn("path", none)
        else:   # a pivot at the top of its group is nobody's child and has no path yet
            parents = _join(pivot, below.select(*group, "place", "path"), [*group, "place"], "left")
            parents = parents.withColumn("path", F.coalesce("path", none))
        child = F.filter(F.array(*[F.struct(
            F.lit(k).alias("slot"), F.col(s).alias("node"),
            F.concat_ws("", F.lit(""), *[f"{x}.hash" for x in slots[:k]]).alias("left"),
            F.concat_ws("", F.lit(""), *[f"{x}.hash" for x in slots[k + 1:]]).alias("right"))
            for k, s in enumerate(slots)]), lambda x: x["node"].isNotNull())
        below = parents.select(*group, "place", "path", F.explode(child).alias("c")).select(
            *group, (F.col("place") * fanout + F.col("c.slot")).alias("place"), F.col("c.node").alias("node"),
            F.concat(F.array(F.struct(F.col("c.left").alias("left"), F.col("c.right").alias("right"))),
                     "path").alias("path"))
    single = nodes.where("n = 1").select(*group, "place", "node", none.alias("path"))
    paths = single if below is None else single.unionByName(below)
    top = tops[0]
    for more in tops[1:]:
        top = top.unionByName(more)
    return top, paths.drop("place")


def manifest(rows: DataFrame, hash_: Column, group: Column, order: Column, fanout: int = FANOUT,
             **keep: Column) -> DataFrame:
    """One row per row: the ``keep`` columns, ``leaf``, ``subroot``, ``root`` and ``path``.

    ``hash_`` is a row's digest (see ``leaf``); ``group`` and ``order`` put rows into trees. Groups
    are ordered as text by UTF-8 bytes, null first. ``path`` holds, from the leaf to the root, what
    stands left and right of the own node: ``fold`` takes a leaf along it, ``proof_text`` writes it.
    """
    if fanout < 2:
        raise ValueError("a fanout of at least 2 is needed")
    node = F.struct(hash_.alias("hash"), *[c.alias(f"keep_{name}") for name, c in keep.items()])
    leaves = cut(rows.select(group.cast("string").alias("group"), order.alias("order"), node.alias("node"))
                 .withColumn("hash", F.col("node.hash")))
    placed = _numbered(leaves, ["group"], ["order", "hash"])
    top, paths = _tree(placed, ["group"], fanout)

    groups = top.select(F.lit(0).alias("all"), "group", F.struct(
        F.col("top").alias("hash"), F.col("group").alias("keep_group")).alias("node"))
    root, above = _tree(_numbered(groups, ["all"], ["group"]), ["all"], fanout)
    above = measured(above.join(F.broadcast(root), "all").select(
        F.col("node.keep_group").alias("group"), F.col("node.hash").alias("subroot"),
        F.col("top").alias("root"), F.col("path").alias("rest")))
    return (_join(paths, above, ["group"])
            .select(*[F.col(f"node.keep_{name}").alias(name) for name in keep],
                    F.col("node.hash").alias("leaf"), "subroot", "root",
                    F.concat("path", "rest").alias("path")))
