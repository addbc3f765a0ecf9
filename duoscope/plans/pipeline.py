"""X1: the whole run - load, clean, link, derive, gate, statistics - as DataFrame jobs.

The linked table is cut from its lineage once (reliable checkpoint into the cluster's
``spark.checkpoint.dir``); a lost executor then re-reads the checkpoint instead of re-running
the fuzzy join. The gate reads it, the ranked lists do, and ``moment_state`` does once for all
other statistics, which are roll-ups of that state.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import clean as C
from ..operators import link as J
from ..operators import moments as M
from ..operators import quality as Q
from ..operators import stats as A
from ..operators import topk as K
from ..session import cut_lineage


@dataclass
class RunConfig:
    """Column mapping of the two catalogues (generic names by default)."""
    a_title: str = "title"
    a_year_text: str = "year_text"           # parsed with tolerant_int (C1)
    a_block: str = "year"                    # a whole number; decades follow from it
    rating_a: str = "rating_a"
    b_title: str = "title"
    b_release_date: str = "release_date"     # release year (C5)
    b_block: str = "release_year"
    score_b: str = "score_b"
    score_c: str | None = "score_c"
    order_col: str = "b_id"
    b_cols: list[str] = field(default_factory=lambda: ["b_id", "b_norm", "c_norm", "score_b",
                                                       "n_reviews", "status"])
    max_dist: float = J.MAX_DIST
    floor_transpositions: bool = False
    genre_min_n: int = 5
    decade_min_n: int = 48
    enforce_gate: bool = True
    checkpoint: bool = True
    cut_inputs: bool = True
    dedupe_right: bool = False               # one right row per (title, block), the first


def clean_sides(a_raw: DataFrame, b_raw: DataFrame, cfg: RunConfig) -> tuple[DataFrame, DataFrame]:
    a = C.clean_a(a_raw, cfg.a_year_text, cfg.a_block, cfg.a_title, cfg.rating_a)
    b = C.clean_b(b_raw, cfg.score_b, cfg.b_title, cfg.b_release_date, cfg.b_block)
    b = b.withColumn("b_norm", S.rescale(F.col(cfg.score_b)))
    return a, b.withColumn("c_norm", S.rescale(F.col(cfg.score_c)) if cfg.score_c else F.lit(None).cast("double"))


def link_and_derive(a: DataFrame, b: DataFrame, cfg: RunConfig) -> tuple[DataFrame, J.LinkResult]:
    res = J.link(a, b, cfg.a_block, cfg.b_block, cfg.order_col, b_cols=cfg.b_cols,
                 max_dist=cfg.max_dist, floor=cfg.floor_transpositions, cut_inputs=cfg.cut_inputs,
                 dedupe_right=cfg.dedupe_right)
    return C.derive(res.linked, rating_a=cfg.rating_a, score_b=None, score_c=None, year=cfg.a_block), res


def run(a_raw: DataFrame, b_raw: DataFrame, cfg: RunConfig | None = None) -> dict:
    """Returns ``{"data": DataFrame, "stats": {name: DataFrame}, "state": DataFrame, "checks": dict, "link": ...,
    "accounting": callable}``; the last gives the rows before and after cleaning, counted on the way.

    Raises ``QualityGateError`` when the gate fails and ``cfg.enforce_gate``.
    """
    cfg = cfg or RunConfig()
    a_raw, seen_a = C.observed(a_raw, C.keep_condition_a(cfg.a_year_text, cfg.rating_a), "a")
    b_raw, seen_b = C.observed(b_raw, C.keep_condition_b(cfg.score_b, cfg.b_title), "b")
    a, b = clean_sides(a_raw, b_raw, cfg)
    data, res = link_and_derive(a, b, cfg)
    if cfg.checkpoint:
        data = cut_lineage(data)
    names = dict(title=cfg.a_title, year=cfg.a_block)
    if cfg.enforce_gate:
        checks = Q.assert_quality(data, **names)
    else:
        checks = Q.quality_report(data, **names).first().asDict()
    # The one scan for all statistics but the ranked lists: every other is a roll-up of it.
    m = M.Moments((cfg.rating_a, "b_norm", "c_norm", "rating_diff"), A.DEFAULT_PAIRS,
                  {"low_count": "low_count", "exact": "match_type = 'exact'", "fuzzy": "match_type = 'fuzzy'"})
    state = M.moment_state(data, M.GRAIN, m)
    if cfg.checkpoint:
        state = cut_lineage(state)
    ranked = [cfg.a_title, cfg.a_block, cfg.rating_a, "b_norm", "rating_diff"]
    stats = {
        "correlations": M.correlations(state, m),
        "ttest": M.ttest_1samp(state, m, "rating_diff"),
        "cohens_d": M.cohens_d(state, m, "rating_diff"),
        "genre_stats": M.group_stats(state, m, "primary_genre", A.GENRE_METRICS, cfg.genre_min_n, ["avg_diff"]),
        "decade_stats": M.group_stats(state, m, "decade", A.DECADE_METRICS, cfg.decade_min_n),
        "vote_stats": M.group_stats(state, m, ["vote_bucket", "vote_bucket_ord"], A.BUCKET_METRICS, None, ["vote_bucket_ord"]),
        "status_stats": M.group_stats(state, m, "status", A.BUCKET_METRICS),
        "overall": M.overall_summary(state, m),
        "link_report": M.link_report(state, m, cfg.rating_a),
        "top_largest": K.top_k(data, "rating_diff", 5, True, ranked),
        "top_smallest": K.top_k(data, "rating_diff", 5, False, ranked),
    }
    return {"data": data, "stats": stats, "state": state,
            "accounting": lambda: C.accounting({"a": seen_a, "b": seen_b}), "checks": checks, "link": res}
