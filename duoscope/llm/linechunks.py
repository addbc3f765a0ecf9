"""Line dedup by content-defined chunks, with DataFrame functions only.

Every line has a 31-bit hash (from md5, so other engines can follow it); a rolling hash over
``span`` consecutive lines ends a chunk after each line where it is 0 modulo ``mean``. Boundaries
thus depend on nearby lines only and survive insertions elsewhere. The text is cut ``sets`` times, by
other digits of the rolling hash, since a short passage often holds no whole chunk of one set.

Chunks are first counted by a 64-bit hash, with map-side aggregation; only those of repeated
hashes are then grouped by their very bytes, so equality is a byte comparison. The first occurrence
(smallest document, then place) stays. Every other is extended to both sides line by line, over the
chunk before and the one after, as long as the lines equal (by their 128-bit MD5, so that no
neighbour's text is moved about) those beside the first occurrence; what has ``min_lines`` lines or
more is removed. A removed line equals one that stands earlier (in a
smaller document or further up), which stays or is removed for one earlier still, so nothing
vanishes altogether.

Documents are identified by id and a hash of their text, so no row numbers are needed that a
recomputed task could give out differently.

Very long texts are cut whole, in the one row that holds them; ties of place cannot arise, ties of
document (equal id and text) are treated alike.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from duoscope.llm.common import cut, measured, pick

MEAN, SPAN, MIN_LINES, SETS = 2, 2, 2, 2
_LIMIT = 1 << 31
#: Repeated hashes (eight bytes each) that are broadcast; with more, the join shuffles the chunks.
OFTEN_ROWS = 2_000_000


def _line_hash(line: Column) -> Column:
    return F.conv(F.substring(F.md5(line), 1, 8), 16, 10).cast("long") % _LIMIT


def chunked(docs: DataFrame, mean: int = MEAN, span: int = SPAN, sets: int = SETS) -> DataFrame:
    """``lines`` of ``text`` and ``cuts``: per set the number of lines up to the end of each chunk."""
    d = docs.withColumn("lines", F.split("text", "\n"))
    d = d.withColumn("h", F.transform("lines", _line_hash))

    def rolling(i: Column) -> Column:
        """After line i (from 1): h[i] + 31 h[i-1] + 31^2 h[i-2] + ... over span lines."""
        terms = [F.when(i > j, F.get("h", (i - 1 - j).cast("int"))).otherwise(F.lit(0)) * (31 ** j % _LIMIT) % _LIMIT
                 for j in range(span)]
        return sum(terms[1:], terms[0])

    n = F.size("lines")
    d = d.withColumn("r", F.transform(F.sequence(F.lit(1), n), rolling)).drop("h")

    def ends(s: int) -> Column:
        return F.filter(F.sequence(F.lit(1), n), lambda i: (i == n) | (
            F.floor(F.get("r", (i - 1).cast("int")) / mean ** s) % mean == 0))

    return d.withColumn("cuts", F.array(*[ends(s) for s in range(sets)])).drop("r")


def chunks(ends: Column) -> Column:
    """Array of (place, n, lines, before, after) of one set: first line (from 0), how many, the lines,
    the MD5 of those of the chunk before and of the chunk after."""
    at = lambda k: F.when(k > 0, F.get(ends, k - 1)).otherwise(F.lit(0))
    part = lambda lo, hi, of="digests": F.slice(of, lo + 1, hi - lo)
    return F.transform(ends, lambda e, k: F.struct(
        at(k).alias("place"), (e - at(k)).alias("n"), part(at(k), e, "lines").alias("own"),
        part(at(k - 1), at(k)).alias("before"), part(e, F.coalesce(F.get(ends, k + 1), e)).alias("after")))


def _agreeing(a: Column, b: Column) -> Column:
    """How many lines two lists have in common at their beginning."""
    differ = F.array_position(F.zip_with(a, b, lambda x, y: x.eqNullSafe(y)), F.lit(False))
    return F.when(differ > 0, differ - 1).otherwise(F.least(F.size(a), F.size(b))).cast("int")


def repeats(docs: DataFrame, mean: int = MEAN, span: int = SPAN, min_lines: int = MIN_LINES,
            sets: int = SETS) -> DataFrame:
    """id, th (hash of text), gone: sorted (place, n) of the lines to remove, apart, where there are any."""
    d = chunked(docs.where("text IS NOT NULL").withColumn("th", F.xxhash64("text")), mean, span, sets)
    d = d.withColumn("digests", F.transform("lines", lambda x: F.unhex(F.md5(x))))
    every = F.flatten(F.transform("cuts", chunks))
    c = d.select("id", "th", F.explode(every).alias("c")).select(
        "id", "th", "c.place", "c.n", F.array_join("c.own", "\n").alias("chunk"), "c.before", "c.after")
    # a blank line alone says nothing about its neighbours
    c = c.where((F.col("n") > 1) | (F.trim("chunk") != "")).withColumn("ch", F.xxhash64("chunk", "n"))
    often = measured(c.groupBy("ch").agg(F.count("*").alias("times")).where("times > 1").select("ch"), OFTEN_ROWS)
    # read twice; cutting texts again costs less than writing all that repeats
    c = c.join(often, "ch", "left_semi")
    # sets may cut the same chunk with other neighbours: the longest of these count
    at = F.struct(F.col("id").isNull().alias("no_id"), "id", "th", "place")
    beside = F.struct(at.alias("at"), (-F.size("before") - F.size("after")).alias("less"),
                      F.col("before").alias("f_before"), F.col("after").alias("f_after"))
    first = cut(c.groupBy("ch", "chunk").agg(F.min(beside).alias("first")))
    # every occurrence but the first; rows of equal id and text are one occurrence
    again = c.join(first, ["ch", "chunk"]).where(~at.eqNullSafe(F.col("first.at")))
    up = _agreeing(F.reverse("before"), F.reverse(F.col("first.f_before")))
    down = _agreeing(F.col("after"), F.col("first.f_after"))
    again = again.select("id", "th", (F.col("place") - up).alias("place"), (F.col("place") + F.col("n") + down).alias("stop"))
    again = again.where(F.col("stop") - F.col("place") >= min_lines).distinct()
    # ranges of one document that touch become one
    w = Window.partitionBy("id", "th").orderBy("place", "stop")
    far = F.max("stop").over(w.rowsBetween(Window.unboundedPreceding, -1))
    again = again.withColumn("new", F.when(F.col("place") <= far, 0).otherwise(1))
    again = again.withColumn("run", F.sum("new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    runs = again.groupBy("id", "th", "run").agg(F.min("place").alias("place"), F.max("stop").alias("stop"))
    return runs.groupBy("id", "th").agg(F.array_sort(F.collect_list(
        F.struct("place", (F.col("stop") - F.col("place")).alias("n")))).alias("gone"))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", mean: int = MEAN,
                span: int = SPAN, min_lines: int = MIN_LINES, counts: bool = False, sets: int = SETS) -> DataFrame:
    """The rows with all their columns, the text without lines that repeat.

    With ``counts`` also n_lines (of the text before) and n_removed. A null text stays null and
    has no lines; an empty text is one empty line. Rows that agree in id and text are treated
    alike: both keep a first occurrence or both lose a repeat. Null ids come after all others. A
    text whose lines all go becomes empty. Fewer than ``min_lines`` lines in a row are never removed.
    """
    gone = repeats(pick(docs, id=id_col, text=text_col), mean, span, min_lines, sets)
    gone = measured(gone.select(F.col("id").alias("__id"), F.col("th").alias("__th"), F.col("gone").alias("__gone")))
    ident, text = docs[f"`{id_col}`"], docs[f"`{text_col}`"]
    d = docs.join(gone, ident.eqNullSafe(F.col("__id")) & (F.xxhash64(text) == F.col("__th")), "left")
    d = d.withColumn("__lines", F.when(F.col("__gone").isNotNull(), F.split(text, "\n")))
    after = lambda k: F.when(k > 0, F.get("__gone", k - 1)["place"] + F.get("__gone", k - 1)["n"]).otherwise(F.lit(0))
    last = after(F.size("__gone"))
    kept = F.flatten(F.concat(
        F.transform("__gone", lambda g, k: F.slice("__lines", after(k) + 1, g["place"] - after(k))),
        F.array(F.slice("__lines", last + 1, F.size("__lines") - last))))
    new = F.when(F.col("__gone").isNull(), text).otherwise(F.array_join(kept, "\n"))
    out = [new.alias(c) if c == text_col else d[f"`{c}`"] for c in docs.columns]
    if counts:
        n_lines = F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit(""))) + 1
        removed = F.aggregate("__gone", F.lit(0), lambda a, g: a + g["n"])
        out += [F.coalesce(n_lines, F.lit(0)).cast("long").alias("n_lines"),
                F.coalesce(removed, F.lit(0)).cast("long").alias("n_removed")]
    return d.select(*out)
