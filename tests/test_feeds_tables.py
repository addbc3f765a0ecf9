import pytest

from duoscope.operators import feeds as G
from duoscope.operators import quality as Q
from duoscope.operators import stats as A
from duoscope.operators import topk as K


@pytest.fixture()
def stats_frame(spark):
    return spark.createDataFrame(
        [("Drama", 8.0, 7.0, 6.0, 1.0, 10), ("Action", 7.0, 8.5, 7.5, -1.5, 6), ("Comedy", 7.5, 7.5, None, 0.0, 5)],
        "primary_genre string, avg_a double, avg_b double, avg_c double, avg_diff double, count long")


def test_median_exact_and_approx(spark):
    df = spark.createDataFrame([(v,) for v in [1, 2, 3, 4, 100, None]], "n_reviews int")
    exact = A.median_of(df).first()
    assert exact.median == 3.0 and exact.median_display == 3.0
    approx = A.median_of(df, approx=True).first()
    assert approx.median in (2.0, 3.0, 4.0)
    even = spark.createDataFrame([(88,), (89,)], "n_reviews int")
    # 88.5 rounds half-even to 88, as R's round() does
    assert A.median_of(even).first().median_display == 88.0


def test_missing_by_column_orders(spark):
    df = spark.createDataFrame([(None, 1.0), (None, None), (1.0, 2.0)], "a double, b double")
    desc = [r.variable for r in Q.missing_by_column(df, ["a", "b"]).collect()]
    asc = [r.variable for r in Q.missing_by_column(df, ["a", "b"], desc=False).collect()]
    assert desc == ["a", "b"] and asc == ["b", "a"]


def test_choices_and_filter_in(spark, stats_frame):
    assert [r.primary_genre for r in K.choices(stats_frame).collect()] == ["Action", "Comedy", "Drama"]
    assert K.filter_in(stats_frame, "primary_genre", []).count() == 3
    assert K.filter_in(stats_frame, "primary_genre", None).count() == 3
    assert K.filter_in(stats_frame, "primary_genre", ["Drama", "X"]).count() == 1


def test_group_feeds(spark, stats_frame):
    diff = {r.primary_genre: r for r in G.group_diff_feed(stats_frame).collect()}
    assert diff["Action"].pos == 1 and diff["Action"].sign == "b" and diff["Drama"].sign == "a"
    assert diff["Drama"].label == "n=10 | Diff=1" and diff["Action"].label == "n=6 | Diff=-1.5"
    series = G.group_series_feed(stats_frame).collect()
    assert len(series) == 9 and {r.series for r in series} == {"avg_a", "avg_b", "avg_c"}
    assert [r for r in series if r.primary_genre == "Comedy" and r.series == "avg_c"][0].value is None
    dec = spark.createDataFrame([(1990, 7.5, 8.0, 50)], "decade int, avg_a double, avg_b double, count long")
    labels = sorted(r.label for r in G.decade_feed(dec).collect())
    assert labels == ["1990s | n=50 / 7.5", "1990s | n=50 / 8"]


def test_ols_and_pair_diffs(spark):
    df = spark.createDataFrame([(1.0, 3.0, 2.0), (2.0, 5.0, None), (3.0, 7.0, 4.0)], "x double, y double, z double")
    r = G.ols(df, "y", "x").first()
    assert r.slope == pytest.approx(2.0) and r.intercept == pytest.approx(1.0) and r.n == 3
    d = {(r.x, r.y): r.mean_diff for r in A.pair_mean_diffs(df, [("y", "x"), ("z", "x")]).collect()}
    assert d[("y", "x")] == pytest.approx(3.0) and d[("z", "x")] == pytest.approx(1.0)
