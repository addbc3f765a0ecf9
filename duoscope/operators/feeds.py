"""The data side of every chart (G1-G12): histograms, OLS lines, box summaries,
point sets and the small long-form feeds built from grouped statistics."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import num_text, point_label, sign_class
from ..session import cut_lineage
from .stats import kll_quantiles, quantiles, value_counts


# G1 -------------------------------------------------------------------------
def histogram(df: DataFrame, col: str, bins: int = 15, lo: float = 0.0, hi: float = 10.0) -> DataFrame:
    """Counts in ``bins`` equal bins centred on lo .. hi (width (hi-lo)/(bins-1)),
    right-closed, values outside [lo, hi] dropped; empty bins reported with 0. ``mean`` is
    the mean of all non-missing values (the chart's line), repeated on each bin.

    Binning is one projection + a partial aggregation; the ``range(bins)`` side of the
    outer join is ``bins`` rows, the window runs over bins.
    """
    w = (hi - lo) / (bins - 1)
    x = F.col(col).cast("double")
    k = F.least(F.greatest(F.ceil((x - F.lit(lo)) / F.lit(w) - F.lit(0.5)), F.lit(0)), F.lit(bins - 1))
    inside = (x >= F.lit(lo)) & (x <= F.lit(hi))
    counts = (df.where(x.isNotNull() & ~F.isnan(x)).groupBy(F.when(inside, k.cast("long")).alias("b"))
              .agg(F.count(F.lit(1)).alias("n"), F.sum(x).alias("s")))
    grid = df.sparkSession.range(bins).withColumnRenamed("id", "bin")
    every = Window.partitionBy(F.lit(0))
    out = grid.join(counts, F.col("bin") == F.col("b"), "full").withColumn(
        "mean", F.sum("s").over(every) / F.sum("n").over(every)).where("bin IS NOT NULL")
    return out.select(
        "bin",
        (F.lit(lo) + F.col("bin") * F.lit(w)).alias("center"),
        F.coalesce(F.col("n"), F.lit(0)).cast("long").alias("count"), "mean").orderBy("bin")


# G2-G4 ----------------------------------------------------------------------
def ols(df: DataFrame, y: str, x: str, by: Sequence[str] = ()) -> DataFrame:
    """Least-squares line y ~ x over complete pairs, optionally per group."""
    g = df.groupBy(*by) if by else df.groupBy()
    return g.agg(F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"),
                 F.regr_r2(y, x).alias("r2"), F.regr_count(y, x).alias("n"))


# G4, G5, G11, G12 -----------------------------------------------------------
def _sampled(df: DataFrame, sample: float | None, seed: int) -> DataFrame:
    return df if sample is None else df.sample(fraction=sample, seed=seed)


#: Points that a cell of a bounded point set holds at most; hex digits by which points are counted.
_PER_CELL, _DIGITS = 4, 2


def limited_points(df: DataFrame, limit: int, key: Sequence[str], x: str = "x", y: str = "y",
                   by: Sequence[str] = ()) -> DataFrame:
    """``limit`` of the points (of each ``by`` group; all if there are no more), spread over the chart.

    The range of x and y is cut into square cells. Each cell's points of smallest MD5 of the key come
    first, up to half of the limit in all, so sparse regions and outliers stay; then the smallest
    of all others. The result depends on the points alone, whatever their order or
    partitioning. Points are not sorted: they are counted by cell and first digits of the MD5, which
    tells from where on a cell and a group need no more; only points before that are kept and
    ranked (about two in 256, and all of sparse cells). ``key`` identifies a point; points of one key
    count once.
    """
    if limit < 1:
        raise ValueError("limit: at least 1")
    bins = max(1, math.isqrt(limit // (2 * _PER_CELL)))
    per_cell = limit // (2 * bins ** 2)
    by = list(by)
    px, py = (F.col(c).cast("double") for c in (x, y))
    ends = df.groupBy(*[F.col(c).alias(f"_e_{c}") for c in by]).agg(
        F.min(px).alias("_x0"), F.max(px).alias("_x1"), F.min(py).alias("_y0"), F.max(py).alias("_y1"))
    same = F.lit(True)
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"_e_{c}"))

    def cell(v, lo: str, hi: str):
        place = F.floor((v - F.col(lo)) / (F.col(hi) - F.col(lo)) * bins)
        return F.when(F.col(hi) > F.col(lo), F.least(place, F.lit(bins - 1))).otherwise(F.lit(0))

    hashed = df.withColumn("_h", F.md5(F.concat_ws(":", *[F.col(k).cast("string") for k in key]).cast("binary")))
    placed = hashed.join(F.broadcast(ends), same).withColumns({
        "_cx": cell(px, "_x0", "_x1"), "_cy": cell(py, "_y0", "_y1"), "_b": F.substring("_h", 1, _DIGITS)})
    placed = placed.select(*df.columns, "_h", "_cx", "_cy", "_b")
    counts = placed.groupBy(*by, "_cx", "_cy", "_b").agg(F.count(F.lit(1)).alias("n"))

    def enough(n: int, name: str, *parts: str) -> DataFrame:
        """The first digits up to which each part has n points; parts with fewer are left out."""
        upto = F.sum("n").over(Window.partitionBy(*(parts or [F.lit(0)])).orderBy("_b"))
        found = counts.groupBy(*parts, "_b").agg(F.sum("n").alias("n")).withColumn("n", upto).where(F.col("n") >= n)
        return F.broadcast(found.groupBy(*parts).agg(F.min("_b").alias(name)).withColumnsRenamed({c: f"{name}{c}" for c in parts}))

    for name, n, parts in (("_s", per_cell, [*by, "_cx", "_cy"]), ("_a", limit, by)):
        told = enough(n, name, *parts)
        match = F.lit(True)
        for c in parts:
            match = match & F.col(c).eqNullSafe(F.col(f"{name}{c}"))
        placed = placed.join(told, match, "left").drop(*[f"{name}{c}" for c in parts])
    reach = F.greatest(*[F.coalesce(F.col(c), F.lit("g")) for c in ("_s", "_a")])    # "g": behind all digits
    # read twice, for both lists
    placed = cut_lineage(placed.where(F.col("_b") <= reach).drop("_s", "_a", "_b"))
    order = [F.col("_h"), *[F.col(k) for k in key]]

    def first(rows: DataFrame, n: int, *parts: str) -> DataFrame:
        if not parts:
            return rows.orderBy(*order).limit(n)
        w = Window.partitionBy(*parts).orderBy(*order)
        return rows.withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= n).drop("_n")

    columns = [*df.columns, "_h"]
    spread = first(placed, per_cell, *by, "_cx", "_cy").select(*columns, F.lit(0).alias("_rest"))
    even = first(placed, limit, *by).select(*columns, F.lit(1).alias("_rest"))
    # at most 1.5 limits of rows from here on
    both = spread.unionByName(even)
    once = Window.partitionBy(*by, *key).orderBy("_rest")
    both = both.withColumn("_n", F.row_number().over(once)).where("_n = 1").drop("_n")
    order = [F.col("_rest"), *order]
    return first(both, limit, *by).select(*df.columns)


def scatter_points(df: DataFrame, x: str, y: str, color: str | None = None,
                   title: str = "title", year: str = "year", label_parts=None,
                   sample: float | None = None, seed: int = 1, limit: int | None = None,
                   key: Sequence[str] = ()) -> DataFrame:
    """Non-NULL (x, y) points with a hover label; all rows, as in the reference, unless the
    caller asks for a ``sample`` or for ``limit`` points at most (``limited_points``, by the MD5 of
    the ``key`` columns; default: title and year). ``label_parts``: (name, column name or text Column)."""
    parts = label_parts if label_parts is not None else [(x, x), (y, y)]
    cols = [F.col(x).alias("x"), F.col(y).alias("y")]
    if color:
        cols.append(F.col(color).alias("color"))
    cols.append(point_label(F.col(title), F.col(year), parts).alias("label"))
    out = df.where(F.col(x).isNotNull() & F.col(y).isNotNull())
    if limit is None:
        return _sampled(out.select(*cols), sample, seed)
    key = list(key) or [title, year]
    # labels are made for the points that stay
    narrow = out.withColumns({"_px": F.col(x), "_py": F.col(y)})
    return _sampled(limited_points(narrow, limit, key, "_px", "_py"), sample, seed).select(*cols)


def scatter_panels(df: DataFrame, pairs: Sequence[tuple[str, str]], title: str = "title", year: str = "year",
                   sample: float | None = None, seed: int = 1, limit: int | None = None,
                   key: Sequence[str] = ()) -> DataFrame:
    """The points of several (x, y) charts from one pass over the rows, tagged ``panel``; with
    ``limit`` so many at most of each panel."""
    def label(a: str, b: str, y: str, x: str):
        return point_label(F.col(title), F.col(year), [(a, y), (b, x)])

    def tag(a: str, b: str):
        return [F.lit(f"{a}~{b}").alias("panel"), F.col(b).cast("double").alias("x"), F.col(a).cast("double").alias("y")]

    if limit is None:
        panels = [F.struct(*tag(a, b), label(a, b, a, b).alias("label")) for a, b in pairs]
        return _sampled(df.select(F.inline(F.array(*panels))).where("x IS NOT NULL AND y IS NOT NULL"), sample, seed)
    # labels are made for the points that stay
    key = list(key) or [title, year]
    carried = list(dict.fromkeys([title, year, *key]))
    out = df.select(*[F.col(c) for c in carried], F.inline(F.array(*[F.struct(*tag(a, b)) for a, b in pairs])))
    out = limited_points(out.where("x IS NOT NULL AND y IS NOT NULL"), limit, key, by=["panel"])
    text = F.coalesce(*[F.when(F.col("panel") == f"{a}~{b}", label(a, b, "y", "x")) for a, b in pairs])
    return _sampled(out.select("panel", "x", "y", text.alias("label")), sample, seed)


# G6, G7 ---------------------------------------------------------------------
def box_stats(df: DataFrame, by: str, col: str, levels: Sequence[str] | None = None,
              approx: int | None = None) -> DataFrame:
    """Box-plot summary per group: quartiles (linear, type 7), whiskers at the most
    extreme values within 1.5 IQR of the box, and the outlier count.

    ``approx=k`` takes the quartiles from a KLL sketch of size k per group (``stats.kll_quantiles``): for
    groups with nearly as many values as rows. Whiskers and outliers are exact for its fences.

    The base rows are read once, into counts of (group, value); quartiles, whiskers and
    outliers come from those. ``levels`` maps the key to a fixed order; values outside
    become the NULL group.
    """
    key = F.when(F.col(by).isin(list(levels)), F.col(by)) if levels is not None else F.col(by)
    if approx is None:
        counts = value_counts(df.select(key.alias("grp"), F.col(col).alias("v")), "v", "grp")
        found = quantiles(counts, (0.25, 0.5, 0.75))
    else:
        v = F.col(col).cast("double")
        counts = df.select(key.alias("grp"), v.alias("v"), F.lit(1).cast("long").alias("n")).where(v.isNotNull() & ~F.isnan(v))
        found = kll_quantiles(counts, (0.25, 0.5, 0.75), approx)
    q = found.select(
        F.col("grp").alias("q_grp"), F.col("n").alias("rows"), F.col("q0").alias("q1"), F.col("q1").alias("median"), F.col("q2").alias("q3"))
    q = q.withColumns({"lo_fence": F.col("q1") - 1.5 * (F.col("q3") - F.col("q1")),
                       "hi_fence": F.col("q3") + 1.5 * (F.col("q3") - F.col("q1"))})
    inside = (F.col("v") >= F.col("lo_fence")) & (F.col("v") <= F.col("hi_fence"))
    out = counts.join(q, F.col("grp").eqNullSafe(F.col("q_grp"))).groupBy(
        "q_grp", F.col("rows").alias("n"), "q1", "median", "q3").agg(
        F.min(F.when(inside, F.col("v"))).alias("whisker_lo"),
        F.max(F.when(inside, F.col("v"))).alias("whisker_hi"),
        F.coalesce(F.sum(F.when(~inside, counts["n"])), F.lit(0)).cast("long").alias("n_outliers"))
    out = out.withColumnRenamed("q_grp", by)
    if levels is not None:
        pos = F.array_position(F.array(*[F.lit(lv) for lv in levels]), F.col(by)).cast("int")
        out = out.withColumn("level_ord", F.when(pos > 0, pos))
        return out.orderBy(F.col("level_ord").asc_nulls_last())
    return out.orderBy(F.col(by).asc_nulls_last())


# Status levels in display order.
STATUS_LEVELS = ("certified", "fresh", "rotten")


# G8 -------------------------------------------------------------------------
def _pos(order_cols) -> F.Column:
    # Window over an aggregated frame of one row per group (bounded by the number of
    # groups, never by base rows), so a single ordered partition is fine here.
    return F.row_number().over(Window.orderBy(*order_cols))


def group_diff_feed(stats: DataFrame, key: str = "primary_genre") -> DataFrame:
    """Bars of mean difference per group: position, sign class and 'n=.. | Diff=..' label."""
    return stats.select(
        key, "avg_diff", "count",
        _pos([F.col("avg_diff").asc_nulls_last(), F.col(key)]).alias("pos"),
        sign_class(F.col("avg_diff")).alias("sign"),
        F.concat(F.lit("n="), F.col("count").cast("string"), F.lit(" | Diff="),
                 num_text(F.col("avg_diff"))).alias("label"))


# G9 -------------------------------------------------------------------------
def group_series_feed(stats: DataFrame, key: str = "primary_genre",
                      series: Sequence[str] = ("avg_a", "avg_b", "avg_c")) -> DataFrame:
    """Grouped bars: groups ordered by mean A, three series in long form."""
    ranked = stats.select(key, *series, _pos([F.col(series[0]).asc_nulls_last(), F.col(key)]).alias("pos"))
    return ranked.unpivot([key, "pos"], list(series), "series", "value")


# G10 ------------------------------------------------------------------------
def decade_feed(stats: DataFrame, series: Sequence[str] = ("avg_a", "avg_b")) -> DataFrame:
    """Two lines over decades, with a '<decade>s | n=<count>' label."""
    long = stats.select("decade", "count", *series).unpivot(["decade", "count"], list(series),
                                                             "series", "value")
    return long.withColumn("label", F.concat(F.col("decade").cast("string"), F.lit("s | n="),
                                             F.col("count").cast("string"), F.lit(" / "),
                                             num_text(F.col("value"))))
