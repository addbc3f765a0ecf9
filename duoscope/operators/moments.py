"""One mergeable state of counts, means and co-moments; the grouped statistics roll it up.

``moment_state`` reads the rows once and keeps, per cell of a fine grain (genre, decade, bucket,
status ...), the number, mean and sum of squared deviations of each value, the same with the
co-moment of each pair over its complete rows, and conditional counts. States of any rows
merge exactly: numbers add, means weigh, and deviations move to the common mean (Chan, Golub and
LeVeque's rule, written for any number of parts):

    M2 = sum(M2_i + n_i (mean_i - mean)^2),   C = sum(C_i + n_i dx_i dy_i)

so every statistic of a coarser grouping (A1-A12, A15, A16, G2-G4) is an aggregation over
cells instead of rows, and yesterday's state can be merged with today's.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import stats as A


@dataclass(frozen=True)
class Moments:
    """What a state holds: value columns, (x, y) pairs, conditional counts (name -> condition)."""
    values: tuple[str, ...]
    pairs: tuple[tuple[str, str], ...] = ()
    counts: Mapping[str, Column | str] = field(default_factory=dict)

    def pair(self, x: str, y: str) -> tuple[int, bool]:
        """Number of a pair, and whether it is held the other way round."""
        if (x, y) in self.pairs:
            return self.pairs.index((x, y)), False
        return self.pairs.index((y, x)), True


def moment_state(df: DataFrame, by: Sequence[str], m: Moments) -> DataFrame:
    """One row per group: ``rows``, ``n_v mean_v m2_v min_v max_v`` of each value, ``pn pa pb paa pbb pab``
    of each pair (number, means, deviations, co-moment over rows with both), ``c_`` counts."""
    aggs = [F.count(F.lit(1)).alias("rows")]
    for v in m.values:
        aggs += [F.count(v).alias(f"n_{v}"), F.avg(v).alias(f"mean_{v}"),
                 (F.var_pop(v) * F.count(v)).alias(f"m2_{v}"), F.min(v).alias(f"min_{v}"), F.max(v).alias(f"max_{v}")]
    for k, (x, y) in enumerate(m.pairs):
        aggs += [F.regr_count(y, x).alias(f"pn{k}"), F.regr_avgx(y, x).alias(f"pa{k}"), F.regr_avgy(y, x).alias(f"pb{k}"),
                 F.regr_sxx(y, x).alias(f"paa{k}"), F.regr_syy(y, x).alias(f"pbb{k}"), F.regr_sxy(y, x).alias(f"pab{k}")]
    aggs += [F.count_if(F.expr(c) if isinstance(c, str) else c).alias(f"c_{name}") for name, c in m.counts.items()]
    return df.groupBy(*by).agg(*aggs)


def roll_up(state: DataFrame, by: Sequence[str], m: Moments) -> DataFrame:
    """The state of coarser groups (``by`` empty: of everything), null groups included.

    Two aggregations over cells: common means first, then deviations around them.
    """
    by = list(by)
    keyed = state.withColumn("_all", F.lit(0))
    keys = by or ["_all"]
    slots = [(f"n_{v}", [f"mean_{v}"]) for v in m.values] + [(f"pn{k}", [f"pa{k}", f"pb{k}"]) for k in range(len(m.pairs))]
    first = [F.sum("rows").alias("rows"), *[F.sum(f"c_{name}").alias(f"c_{name}") for name in m.counts]]
    for v in m.values:
        first += [F.min(f"min_{v}").alias(f"min_{v}"), F.max(f"max_{v}").alias(f"max_{v}")]
    for n, means in slots:
        first.append(F.sum(n).alias(n))
        first += [F.try_divide(F.sum(F.col(n) * F.col(mean)), F.sum(n)).alias(mean) for mean in means]
    whole = keyed.groupBy(*keys).agg(*first)

    centre = whole.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)],
                          *[F.col(mean).alias(f"_{mean}") for _, means in slots for mean in means])
    same = F.lit(True)
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    cells = keyed.join(centre, same)

    def moved(own: str, n: str, a: str, b: str) -> Column:
        return F.sum(F.col(own) + F.col(n) * (F.col(a) - F.col(f"_{a}")) * (F.col(b) - F.col(f"_{b}"))).alias(own)

    second = [moved(f"m2_{v}", f"n_{v}", f"mean_{v}", f"mean_{v}") for v in m.values]
    for k in range(len(m.pairs)):
        second += [moved(f"paa{k}", f"pn{k}", f"pa{k}", f"pa{k}"), moved(f"pbb{k}", f"pn{k}", f"pb{k}", f"pb{k}"),
                   moved(f"pab{k}", f"pn{k}", f"pa{k}", f"pb{k}")]
    spread = cells.groupBy(*keys).agg(*second).withColumnsRenamed({k: f"_k{i}" for i, k in enumerate(keys)})
    out = whole.join(spread, same).drop(*[f"_k{i}" for i in range(len(keys))])
    return out if by else out.drop("_all")


def merge(states: Sequence[DataFrame], by: Sequence[str], m: Moments) -> DataFrame:
    """One state of the same grain from several (of other days, shards, catalogues)."""
    out = states[0]
    for more in states[1:]:
        out = out.unionByName(more)
    return roll_up(out, by, m)


def _sd(v: str) -> Column:
    return F.when(F.col(f"n_{v}") > 1, F.sqrt(F.col(f"m2_{v}") / (F.col(f"n_{v}") - 1)))


# A1-A3
def correlations(state: DataFrame, m: Moments, pairs=A.DEFAULT_PAIRS, by: Sequence[str] = (), with_p: bool = True) -> DataFrame:
    s = roll_up(state, by, m)
    cols = []
    for i, (x, y) in enumerate(pairs):
        k, _ = m.pair(x, y)
        spread = F.sqrt(F.col(f"paa{k}")) * F.sqrt(F.col(f"pbb{k}"))
        cols += [F.try_divide(F.col(f"pab{k}"), spread).alias(f"r{i}"), F.col(f"pn{k}").alias(f"n{i}")]
    return A.correlation_rows(s.select(*by, *cols), pairs, list(by), with_p)


# A4, A5
def ttest_1samp(state: DataFrame, m: Moments, col: str = "rating_diff", mu: float = 0.0, by: Sequence[str] = (),
                with_p: bool = True, conf: float = 0.95) -> DataFrame:
    s = roll_up(state, by, m).select(*by, F.col(f"mean_{col}").alias("mean"), _sd(col).alias("sd"), F.col(f"n_{col}").alias("n"))
    return A.ttest_rows(s, mu, with_p, conf)


def cohens_d(state: DataFrame, m: Moments, col: str = "rating_diff", by: Sequence[str] = ()) -> DataFrame:
    return roll_up(state, by, m).select(*by, F.try_divide(F.col(f"mean_{col}"), _sd(col)).alias("cohens_d"))


# A6-A9
def group_stats(state: DataFrame, m: Moments, by: Sequence[str] | str, metrics: Mapping[str, str], min_n: int | None = None,
                order: Sequence[str] | None = None) -> DataFrame:
    """Means and row counts per group, as ``stats.group_stats``."""
    by = [by] if isinstance(by, str) else list(by)
    out = roll_up(state, by, m).select(*by, *[F.col(f"mean_{c}").alias(a) for a, c in metrics.items()], F.col("rows").alias("count"))
    if min_n is not None:
        out = out.where(F.col("count") >= min_n)
    return out.orderBy(*[F.col(k).asc_nulls_last() for k in order or by], *by)


# A10, A12
def overall_summary(state: DataFrame, m: Moments) -> DataFrame:
    return roll_up(state, [], m).select(
        F.col("rows").alias("n_total"), F.col("mean_rating_diff").alias("avg_diff"), F.col("mean_rating_a").alias("avg_a"),
        F.col("mean_b_norm").alias("avg_b"), F.col("c_low_count").alias("n_low_count"),
        F.col("min_rating_a").alias("min_a"), F.col("max_rating_a").alias("max_a"))


# A11, A16
def share(state: DataFrame, m: Moments, count: str, of: str | None = None, by: Sequence[str] = ()) -> DataFrame:
    """Share of a conditional count in the rows, or in those with a value of ``of``."""
    return roll_up(state, by, m).select(*by, F.try_divide(F.col(f"c_{count}"), F.col(f"n_{of}" if of else "rows")).alias("share"))


# A15
def pair_mean_diffs(state: DataFrame, m: Moments, pairs=A.DEFAULT_PAIRS, by: Sequence[str] = ()) -> DataFrame:
    """Mean of x - y over rows with both, one row per (group and) pair."""
    rows = []
    for x, y in pairs:
        k, swapped = m.pair(x, y)
        d = F.col(f"pa{k}") - F.col(f"pb{k}")
        rows.append(F.struct(F.lit(x).alias("x"), F.lit(y).alias("y"), (-d if swapped else d).alias("mean_diff")))
    return roll_up(state, by, m).select(*by, F.inline(F.array(*rows)))


# A16
def spread_ratio(state: DataFrame, m: Moments, num: str = "b_norm", den: str = "rating_a") -> DataFrame:
    a, b = (F.col(f"max_{v}") - F.col(f"min_{v}") for v in (num, den))
    return roll_up(state, [], m).select(a.alias("spread_num"), b.alias("spread_den"), F.try_divide(a, b).alias("spread_ratio"))


# G2-G4
def ols(state: DataFrame, m: Moments, y: str, x: str, by: Sequence[str] = ()) -> DataFrame:
    """Least-squares line y ~ x over complete pairs, as ``feeds.ols``."""
    k, swapped = m.pair(x, y)
    a, b = ("b", "a") if swapped else ("a", "b")
    sxx, syy, sxy = F.col(f"p{a}{a}{k}"), F.col(f"p{b}{b}{k}"), F.col(f"pab{k}")
    slope = F.try_divide(sxy, sxx)
    r2 = F.when(sxx > 0, F.when(syy > 0, sxy * sxy / (sxx * syy)).otherwise(1.0))
    return roll_up(state, by, m).select(
        *by, slope.alias("slope"), (F.col(f"p{b}{k}") - slope * F.col(f"p{a}{k}")).alias("intercept"),
        r2.alias("r2"), F.col(f"pn{k}").alias("n"))


# J8
def link_report(state: DataFrame, m: Moments, rating_a: str = "rating_a", b_norm: str = "b_norm") -> DataFrame:
    return roll_up(state, [], m).select(
        F.col("c_exact").alias("n_exact"), F.col("c_fuzzy").alias("n_fuzzy"), F.col("rows").alias("n_total"),
        F.col(f"mean_{rating_a}").alias("avg_rating_a"), F.col(f"mean_{b_norm}").alias("avg_b_norm"))


#: The state of a linked table: its grain, and what the run's statistics need.
GRAIN = ("primary_genre", "decade", "vote_bucket", "vote_bucket_ord", "status")
LINKED = Moments(("rating_a", "b_norm", "c_norm", "rating_diff"),
                 (*A.DEFAULT_PAIRS, ("votes_log10", "rating_diff"), ("rating_a", "rating_diff")),
                 {"low_count": "low_count", "b_at_least_9": "b_norm >= 9.0"})
