import random

import pytest
from pyspark.sql import functions as F

from duoscope.operators import feeds as G
from duoscope.operators import moments as M
from duoscope.operators import stats as A

SCHEMA = ("primary_genre string, decade int, vote_bucket string, vote_bucket_ord int, status string, "
          "rating_a double, b_norm double, c_norm double, rating_diff double, votes_log10 double, low_count boolean")


@pytest.fixture(scope="module")
def linked(spark):
    rng = random.Random(6)
    rows = []
    for _ in range(800):
        bucket = rng.choice([("x", 1), ("y", 2), (None, None)])
        a, b, c = (rng.choice([None, rng.gauss(7, 1), 5.0]) for _ in range(3))
        rows.append((rng.choice(["g1", "g2", "g3", None]), rng.choice([1990, 2000, None]), *bucket,
                     rng.choice(["certified", "fresh", None]), a, b, c, None if a is None or b is None else a - b,
                     rng.choice([None, rng.random() * 5]), rng.choice([True, False, None])))
    rows.append(("alone", 1980, "x", 1, "fresh", 1e9, 1e9 + 1, None, -1.0, None, False))
    return spark.createDataFrame(rows, SCHEMA)


def same(got, want):
    key = lambda r: repr([x if not isinstance(x, float) else 0 for x in r])
    g, w = sorted(map(tuple, got.collect()), key=key), sorted(map(tuple, want.collect()), key=key)
    assert got.columns == want.columns and len(g) == len(w)
    for x, y in zip(g, w):
        for a, b in zip(x, y):
            assert a == b or (isinstance(a, float) and a == pytest.approx(b, rel=1e-9, abs=1e-9)), (x, y)


@pytest.mark.parametrize("by", [[], ["decade"], ["primary_genre", "status"]])
def test_roll_ups_equal_the_direct_statistics(linked, by):
    rows = linked.where("primary_genre <> 'alone' OR primary_genre IS NULL")
    state, m = M.moment_state(rows, M.GRAIN, M.LINKED), M.LINKED
    same(M.correlations(state, m, by=by), A.correlations(rows, by=by))
    same(M.ttest_1samp(state, m, "rating_diff", by=by), A.ttest_1samp(rows, "rating_diff", by=by))
    same(M.cohens_d(state, m, "rating_diff", by=by), A.cohens_d(rows, "rating_diff", by=by).select(*by, "cohens_d"))
    for y, x in (("rating_diff", "votes_log10"), ("rating_a", "b_norm"), ("b_norm", "rating_a")):
        same(M.ols(state, m, y, x, by), G.ols(rows, y, x, by))


def test_whole_table_statistics(linked):
    state, m = M.moment_state(linked, M.GRAIN, M.LINKED), M.LINKED
    same(M.group_stats(state, m, "primary_genre", A.GENRE_METRICS, 5, ["avg_diff"]), A.genre_stats(linked))
    same(M.group_stats(state, m, "status", A.BUCKET_METRICS), A.status_stats(linked))
    same(M.overall_summary(state, m), A.overall_summary(linked))
    same(M.share(state, m, "b_at_least_9", "b_norm"), A.share_at_least(linked))
    same(M.pair_mean_diffs(state, m), A.pair_mean_diffs(linked))
    same(M.spread_ratio(state, m), A.spread_ratio(linked))


def test_states_of_any_parts_merge_to_the_whole(linked):
    m = M.LINKED
    parts = [M.moment_state(linked.where(F.pmod(F.xxhash64(*linked.columns), F.lit(5)) == i), M.GRAIN, m) for i in range(5)]
    merged = M.merge(parts, M.GRAIN, m)
    whole = M.moment_state(linked, M.GRAIN, m)
    same(merged.select(*whole.columns), whole)
    assert M.merge(parts[:1], M.GRAIN, m).count() == parts[0].count()


def test_large_values_lose_no_digits(spark):
    """Means far from 0: deviations are moved between means, never taken from sums of squares."""
    rows = [(g, None, None, None, None, 1e8 + i, 1e8 + 2 * i, None, float(i), None, False) for i in range(50) for g in "ab"]
    df = spark.createDataFrame(rows, SCHEMA)
    state = M.moment_state(df, M.GRAIN, M.LINKED)
    (r,) = M.correlations(state, M.LINKED, [("rating_a", "b_norm")], with_p=False).collect()
    assert r.r == pytest.approx(1.0, abs=1e-12) and r.n == 100


def test_empty_table(spark):
    state = M.moment_state(spark.createDataFrame([], SCHEMA), M.GRAIN, M.LINKED)
    assert state.count() == 0 and M.correlations(state, M.LINKED, by=["decade"]).count() == 0


def test_the_run_scans_the_linked_table_once_for_its_statistics(spark):
    """Every statistic but the ranked lists starts from the checkpointed state."""
    from duoscope.plans import pipeline as X
    a = spark.createDataFrame([(i, f"title {i}", str(1990 + i % 3), 5.0 + i % 4, 1000.0 * i, "g, h") for i in range(30)],
                              "a_id long, title string, year_text string, rating_a double, votes double, genre_list string")
    b = spark.createDataFrame([(i, f"title {i}", f"{1990 + i % 3}-01-01", 50.0 + i, 60.0, 10 + i, "fresh") for i in range(30)],
                              "b_id long, title string, release_date string, score_b double, score_c double, n_reviews int, status string")
    res = X.run(a, b)
    cells = set(res["state"].columns)
    for name, df in res["stats"].items():
        leaves = df._jdf.queryExecution().optimizedPlan().toString()
        if not name.startswith("top_"):
            assert "Scan ExistingRDD" in leaves or "LogicalRDD" in leaves
            assert "title" not in leaves and "rows" in cells, name
    same(res["stats"]["correlations"], A.correlations(res["data"]))
    same(res["stats"]["link_report"], X.J.link_report(res["data"]))
