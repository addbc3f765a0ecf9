"""Quality rules: counts per text, hard limits, and robust multivariate outliers.

DataFrame functions only. Texts that pass the hard limits get a vector of transformed
statistics (log mean word length; square roots of symbols a word, of the odds of repeated lines, and
of repeated words to what the hard limit leaves; all shrunk for short texts, none with an upper bound,
so each alone can reach the cutoff). For every language and source (sources of fewer than
``MIN_GROUP`` texts: for all texts of the language) the minimum covariance determinant estimate of centre and scatter is found by concentration steps: take the
share ``KEEP`` of vectors nearest to the present estimate, re-estimate from them, repeat; the start
with the smallest determinant wins, and one reweighting step follows. Texts whose squared
Mahalanobis distance exceeds the chi-square quantile ``CUTOFF`` are rejected.

Null and empty texts have no words and fail the hard limits; very long texts are counted whole, in their row;
vectors of one distance fall into one bin and are taken together, so repeated rows are judged alike.

Each step is two aggregations with map-side partial sums (a histogram of log distances, which
gives the nearest share, and sums of products), so a source may hold any part of the rows. What
is carried between the steps is one row per group.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from duoscope.llm.common import cut, pick

MIN_WORDS, MAX_REPEAT_PERCENT, WINDOW = 10, 20, 5
KEEP, STEPS, MIN_GROUP = 0.75, 5, 25
REWEIGHT, CUTOFF = 0.975, 1 - 1e-9
#: Standard deviations below which a statistic's scatter is not taken seriously.
FLOORS = (0.06, 0.06, 0.1, 0.2)
_WS = r"[\x20\x09-\x0D]+"
_P = len(FLOORS)
_X = [f"x{i}" for i in range(_P)]


def base_counts(df: DataFrame) -> DataFrame:
    """Counts of ``text`` as the columns n_words, word_chars, n_symbols, n_lines, n_dup_lines,
    n_repeat_words (long) beside the other columns; null counts as empty."""
    t = F.coalesce("text", F.lit(""))
    trimmed = F.btrim(t, F.lit(" \t\n\x0b\x0c\r"))
    d = df.withColumn("__w", F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, _WS)))
    d = d.withColumn("__l", F.filter(F.split(t, "\n"), lambda x: F.btrim(x, F.lit(" \t\n\x0b\x0c\r")) != ""))
    d = (d.withColumn("n_words", F.size("__w").cast("long"))
         .withColumn("word_chars", F.length(F.array_join("__w", "")).cast("long"))
         .withColumn("n_symbols", F.regexp_count(t, F.lit("[#*$%&|<>]")).cast("long"))
         .withColumn("n_lines", F.size("__l").cast("long"))
         .withColumn("n_dup_lines", (F.size("__l") - F.size(F.array_distinct("__l"))).cast("long"))
         .withColumn("__h", F.transform("__w", lambda x: F.xxhash64(x))).drop("__w", "__l", "text"))
    # hashes of all windows; most texts have no repeated one
    last = F.size("__h") - WINDOW
    d = d.withColumn("__win", F.when(last >= 1, F.transform(
        F.sequence(F.lit(0), last), lambda i: F.xxhash64(*[F.get("__h", i + j) for j in range(WINDOW)]))))
    d = d.withColumn("__s", F.when(F.size(F.array_distinct("__win")) < F.size("__win"), F.array_sort(
        F.transform("__win", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    # beginnings of windows that occur twice or more, in order; the union of what they cover
    d = d.withColumn("__at", F.array_sort(F.transform(
        F.filter("__s", lambda x, k: (x["h"] == F.get("__s", k - 1)["h"]).eqNullSafe(True)
                 | (x["h"] == F.get("__s", k + 1)["h"]).eqNullSafe(True)), lambda x: x["i"])))
    cover = F.aggregate(F.transform("__at", lambda a, k: F.least(
        F.coalesce(F.get("__at", k + 1) - a, F.lit(WINDOW)), F.lit(WINDOW))), F.lit(0), lambda a, x: a + x)
    return (d.withColumn("n_repeat_words", F.coalesce(cover, F.lit(0)).cast("long"))
            .drop("__h", "__win", "__s", "__at"))


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def vector() -> list[Column]:
    """Transformed statistics; adding 50 ordinary words shrinks what short texts cannot show."""
    more = F.col("n_words") + 50
    return [F.log((F.col("word_chars") + 250) / more), F.sqrt(F.col("n_symbols") / more),
            F.sqrt(F.col("n_dup_lines") / (F.col("n_lines") + 5 - F.col("n_dup_lines"))),
            # base_failed texts have no distance; they only must not divide by zero
            F.sqrt(F.col("n_repeat_words") / F.greatest(more * MAX_REPEAT_PERCENT / 100 - F.col("n_repeat_words"), F.lit(1.0)))]


def chi2_cdf(x: float, even: int) -> float:
    term = total = 1.0
    for i in range(1, even // 2):
        term *= x / 2 / i
        total += term
    return 1 - math.exp(-x / 2) * total


def chi2_quantile(p: float, even: int) -> float:
    low, high = 0.0, 400.0
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if chi2_cdf(mid, even) < p else (low, mid)
    return high


def _distance2() -> Column:
    """Squared Mahalanobis distance of x0.. from m0.. with the Cholesky factor l_i_j."""
    z: list[Column] = []
    for i in range(_P):
        r = F.col(f"x{i}") - F.col(f"m{i}")
        for j in range(i):
            r = r - F.col(f"l_{i}_{j}") * z[j]
        z.append(r / F.col(f"l_{i}_{i}"))
    return sum((x * x for x in z[1:]), z[0] * z[0])


def _estimates(rows: DataFrame, by: list[str], factor: float) -> DataFrame:
    """Centre, Cholesky factor of the scatter (times ``factor``) and its log determinant by group."""
    sums = [F.avg(x).alias(f"m{i}") for i, x in enumerate(_X)]
    sums += [F.avg(F.col(f"x{i}") * F.col(f"x{j}")).alias(f"s_{i}_{j}") for i in range(_P) for j in range(i + 1)]
    g = rows.groupBy(*by).agg(*sums)
    for i in range(_P):
        for j in range(i + 1):
            c = (F.col(f"s_{i}_{j}") - F.col(f"m{i}") * F.col(f"m{j}")) * factor
            if i == j:
                c = F.greatest(c, F.lit(0.0)) + FLOORS[i] ** 2
            for k in range(j):
                c = c - F.col(f"l_{i}_{k}") * F.col(f"l_{j}_{k}")
            # rounding cannot push a pivot under a tenth of its floor
            g = g.withColumn(f"l_{i}_{j}", F.sqrt(F.greatest(c, F.lit(FLOORS[i] ** 2 / 10))) if i == j
                             else c / F.col(f"l_{j}_{j}"))
    det = sum((F.log(f"l_{i}_{i}") for i in range(1, _P)), F.log("l_0_0"))
    return g.withColumn("logdet", det).drop(*[f"s_{i}_{j}" for i in range(_P) for j in range(i + 1)])


def _with(rows: DataFrame, groups: DataFrame, how: str = "inner", by=("lang", "source")) -> DataFrame:
    g = groups.withColumnsRenamed({x: f"__{x}" for x in by})
    on = [rows[x].eqNullSafe(g[f"__{x}"]) for x in by]
    return rows.join(g, on, how).drop(*[f"__{x}" for x in by])


def _nearest(rows: DataFrame, by: list[str], share: float) -> DataFrame:
    """The rows (with d2) of each group up to the bin of log d2 in which the share is reached."""
    rows = rows.withColumn("bin", F.floor(F.log(F.greatest("d2", F.lit(1e-9))) * 16).cast("int"))
    counts = rows.groupBy(*by, "bin").agg(F.count("*").alias("n"))
    w = Window.partitionBy(*by)
    upto = counts.withColumn("upto", F.sum("n").over(w.orderBy("bin"))).withColumn("all", F.sum("n").over(w))
    limit = upto.where(F.col("upto") >= share * F.col("all")).groupBy(*by).agg(F.min("bin").alias("limit"))
    return _with(rows, limit, by=by).where("bin <= limit")


def _first(rows: DataFrame, by: list[str]) -> DataFrame:
    """Two starts for each group: all vectors (0), and medians with interquartile scatter (1)."""
    whole = _estimates(rows, by, 1.0).withColumn("start", F.lit(0))
    long = rows.select(*by, F.posexplode(F.array(*[F.floor(F.col(x) / (f / 8)).cast("long") for x, f in zip(_X, FLOORS)]))
                       .alias("dim", "bin"))
    counts = long.groupBy(*by, "dim", "bin").agg(F.count("*").alias("n"))
    w = Window.partitionBy(*by, "dim")
    upto = counts.withColumn("upto", F.sum("n").over(w.orderBy("bin"))).withColumn("all", F.sum("n").over(w))
    quart = [F.min(F.when(F.col("upto") >= q * F.col("all"), F.col("bin"))) for q in (0.25, 0.5, 0.75)]
    q = upto.groupBy(*by, "dim").agg(*[x.alias(f"q{i}") for i, x in enumerate(quart)])
    wide = q.groupBy(*by).agg(
        *[F.max(F.when(F.col("dim") == i, (F.col("q1") + 0.5) * (f / 8))).alias(f"m{i}") for i, f in enumerate(FLOORS)],
        *[F.max(F.when(F.col("dim") == i, F.greatest((F.col("q2") - F.col("q0")) * (f / 8) / 1.349, F.lit(f)))).alias(f"l_{i}_{i}")
          for i, f in enumerate(FLOORS)])
    for i in range(_P):
        for j in range(i):
            wide = wide.withColumn(f"l_{i}_{j}", F.lit(0.0))
    wide = wide.withColumn("logdet", F.lit(0.0)).withColumn("start", F.lit(1))
    return whole.unionByName(wide)


def robust_estimates(rows: DataFrame) -> DataFrame:
    """lang, source, m0.., l_i_j of every group of a language of MIN_GROUP vectors or more.

    A group that is smaller itself has the estimate of its language.
    """
    total = F.sum("size").over(Window.partitionBy("lang"))
    sizes = cut(rows.groupBy("lang", "source").agg(F.count("*").alias("size")).withColumn("total", total))
    big = sizes.where(F.col("size") >= MIN_GROUP).select("lang", "source")
    small = sizes.where((F.col("size") < MIN_GROUP) & (F.col("total") >= MIN_GROUP)).select("lang", "source")
    pooled = not small.isEmpty()
    all_rows, rows = rows, _with(rows, big).withColumn("pooled", F.lit(False))
    if pooled:
        whole = _with(all_rows, small.select("lang").distinct(), by=["lang"]).withColumn("pooled", F.lit(True))
        rows = rows.unionByName(whole.withColumn("source", F.lit(None).cast(all_rows.schema["source"].dataType)))
    by = ["lang", "source", "pooled"]
    alpha = chi2_quantile(KEEP, _P)
    factor = KEEP / chi2_cdf(alpha, _P + 2)
    est = cut(_first(rows, by))
    for _ in range(STEPS):
        near = _nearest(_with(rows, est, by=by).withColumn("d2", _distance2()).select(*by, "start", *_X, "d2"), [*by, "start"], KEEP)
        est = cut(_estimates(near, [*by, "start"], factor))
    best = Window.partitionBy(*by).orderBy("logdet", "start")
    est = cut(est.withColumn("rank", F.row_number().over(best)).where("rank = 1").drop("rank", "start"))
    q = chi2_quantile(REWEIGHT, _P)
    inside = _with(rows, est, by=by).withColumn("d2", _distance2()).where(F.col("d2") <= q).select(*by, *_X)
    est = _estimates(inside, by, REWEIGHT / chi2_cdf(q, _P + 2))
    out = est.where("NOT pooled").drop("pooled")
    if pooled:
        est = cut(est)
        out = est.where("NOT pooled").drop("pooled").unionByName(
            _with(small, est.where("pooled").drop("source", "pooled"), by=["lang"]))
    return out


def quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
            source_col: str = "source") -> DataFrame:
    """One row per row: id, the counts, base_failed, distance2 and kept.

    Null and empty texts have no words and fail the base. Null languages and sources are groups
    like others. In a language of fewer than MIN_GROUP texts that pass the base, and for texts that
    fail it, there is no distance (null); the base alone decides. Repeated rows are judged
    alike. Other columns are not read.
    """
    d = pick(docs, id=id_col, text=text_col, lang=lang_col, source=source_col)
    d = base_counts(d).withColumn("base_failed", base_failed())
    d = cut(d.select("*", *[x.alias(n) for x, n in zip(vector(), _X)]))
    est = cut(robust_estimates(d.where("NOT base_failed").select("lang", "source", *_X)))
    out = _with(d, est, "left").withColumn("distance2", F.when(~F.col("base_failed"), _distance2()))
    kept = ~F.col("base_failed") & F.coalesce(F.col("distance2") <= chi2_quantile(CUTOFF, _P), F.lit(True))
    return out.select(F.col("id").alias(id_col), "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines",
                      "n_repeat_words", "base_failed", "distance2", kept.alias("kept"))
