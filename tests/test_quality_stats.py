import math

import pytest
from pyspark.sql import functions as F

from duoscope.functions import tdist
from duoscope.operators import quality as Q
from duoscope.operators import stats as A
from duoscope.operators import topk as K
from duoscope.operators import feeds as G

SCHEMA = ("title string, year int, rating_a double, b_norm double, c_norm double, "
          "rating_diff double, low_count boolean, primary_genre string")


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


GOOD = [("a", 2000, 8.0, 7.0, 6.0, 1.0, False, "Drama"),
        ("b", 2000, 7.5, 8.0, None, -0.5, True, "Drama"),
        ("c", 2001, 9.0, 6.0, 7.0, 3.0, None, None)]


def test_gate_passes_and_reports(spark):
    rep = Q.assert_quality(frame(spark, GOOD))
    assert rep["duplicates"] == 0 and rep["n_low_count"] == 1
    assert (rep["min_rating_a"], rep["max_rating_a"]) == (7.5, 9.0)


def test_gate_fires_on_duplicates_with_null_equal_null(spark):
    rows = GOOD + [("a", 2000, 8.0, 7.0, 6.0, 1.0, False, "Drama"),
                   (None, None, 5.0, 5.0, 5.0, 0.0, False, "X"),
                   (None, None, 5.0, 5.0, 5.0, 0.0, False, "X")]
    df = frame(spark, rows)
    assert Q.quality_report(df).first().duplicates == 2
    with pytest.raises(Q.QualityGateError, match="duplicate"):
        Q.assert_quality(df)


def test_gate_fires_on_null_or_nan_rating(spark):
    df = frame(spark, GOOD + [("d", 1999, float("nan"), 5.0, 5.0, 0.0, False, "X")])
    with pytest.raises(Q.QualityGateError, match="rating_a"):
        Q.assert_quality(df)


def test_missing_by_column_and_qa(spark):
    df = frame(spark, GOOD).withColumns({"n_reviews": F.lit(None).cast("int"), "votes": F.lit(1.0)})
    miss = {r.variable: r.n_missing for r in Q.missing_by_column(df).collect()}
    assert miss == {"rating_a": 0, "b_norm": 0, "c_norm": 1, "n_reviews": 3, "votes": 0,
                    "primary_genre": 1, "year": 0}
    qa = {r.metric: r.value for r in Q.qa_metrics(df).collect()}
    assert qa["rows"] == 3 and qa["distinct_genres"] == 1 and qa["missing_c_norm"] == 1


def test_text_key_duplicates_count_na_as_text(spark):
    df = spark.createDataFrame([("x", None), ("x", None), ("x NA", None)], "title string, year int")
    # 'x NA' pasted with a NULL year gives 'x NA NA'; the two ('x', NULL) rows collide.
    assert Q.duplicate_count(df).first().duplicates == 1


@pytest.mark.parametrize("r,n,lo,hi,log10p", [
    (0.227, 641, 0.152, 0.299, math.log10(6.0e-9)),
    (0.489, 641, 0.427, 0.545, math.log10(9.3e-40)),
    (0.370, 641, 0.302, 0.435, math.log10(2.8e-22)),
])
def test_published_correlation_figures(spark, r, n, lo, hi, log10p):
    clo, chi = A.corr_ci_from(r, n)
    assert clo == pytest.approx(lo, abs=1e-3) and chi == pytest.approx(hi, abs=1e-3)
    t = r * math.sqrt((n - 2) / (1 - r * r))
    df = spark.createDataFrame([(t, float(n - 2))], "t double, df double")
    p = df.select(tdist.t_two_sided_p(F.col("t"), F.col("df"))).first()[0]
    assert math.log10(p) == pytest.approx(log10p, abs=0.2)


def test_t_distribution_reference_points(spark):
    df = spark.createDataFrame([(2.228138851964938, 10.0), (1.959963984540054, 1e9), (0.0, 5.0)],
                               "t double, df double")
    out = df.select(tdist.t_two_sided_p(F.col("t"), F.col("df")).alias("p"),
                    tdist.t_quantile_two_sided(0.05, F.col("df")).alias("q")).collect()
    assert out[0].p == pytest.approx(0.05, abs=1e-9)
    assert out[0].q == pytest.approx(2.228138851964938, abs=1e-7)
    assert out[1].p == pytest.approx(0.05, abs=1e-6)
    assert out[2].p == pytest.approx(1.0, abs=1e-12)


def test_ttest_and_effect_size(spark):
    vals = [(-1.0,), (-0.5,), (-1.5,), (-0.8,), (-1.2,), (0.3,)]
    df = spark.createDataFrame(vals, "rating_diff double")
    r = A.ttest_1samp(df).first()
    xs = [v[0] for v in vals]
    mean = sum(xs) / len(xs)
    sd = math.sqrt(sum((x - mean) ** 2 for x in xs) / (len(xs) - 1))
    assert r.mean == pytest.approx(mean) and r.sd == pytest.approx(sd)
    assert r.t == pytest.approx(mean / (sd / math.sqrt(6))) and r.df == 5
    assert r.ci_lo < mean < r.ci_hi
    # 95 % CI half-width uses t_{0.975, 5} = 2.570582
    assert (r.ci_hi - mean) == pytest.approx(2.5705818366147395 * sd / math.sqrt(6), rel=1e-7)
    d = A.cohens_d(df).first().cohens_d
    assert d == pytest.approx(mean / sd)
    # report check: t = d * sqrt(n): -0.871 * sqrt(641) ~ -22.06
    assert -0.8713 * math.sqrt(641) == pytest.approx(-22.06, abs=0.01)


def test_cohens_d_zero_sd_is_null(spark):
    df = spark.createDataFrame([(1.0,), (1.0,)], "rating_diff double")
    assert A.cohens_d(df).first().cohens_d is None


def test_correlations_pairwise_complete(spark):
    df = frame(spark, GOOD + [("d", 2002, 6.0, 5.0, 5.5, 1.0, False, "X")])
    res = {(r.x, r.y): r for r in A.correlations(df).collect()}
    assert res[("rating_a", "b_norm")].n == 4
    assert res[("rating_a", "c_norm")].n == 3  # one NULL audience score


def test_group_min_n_inclusive(spark):
    df = frame(spark, GOOD)
    got = A.group_stats(df, "primary_genre", {"avg_a": "rating_a"}, min_n=2).collect()
    assert [(r.primary_genre, r["count"]) for r in got] == [("Drama", 2)]


def test_top_k_keeps_ties(spark):
    df = spark.createDataFrame([(i, None if v is None else float(v)) for i, v in enumerate([5, 5, 4, 4, 4, 3, 2, 1, None])],
                               "id int, rating_diff double")
    top = K.top_k(df, "rating_diff", 3, True, columns=["id", "rating_diff"])
    assert sorted(r.id for r in top.collect()) == [0, 1, 2, 3, 4]
    bottom = K.top_k(df, "rating_diff", 2, False, columns=["id"])
    assert sorted(r.id for r in bottom.collect()) == [6, 7]


def test_browse_pages_are_stable(spark):
    df = spark.createDataFrame([(i, f"t{i % 3}", float(i % 4)) for i in range(40)],
                               "id int, title string, v double")
    pages = [K.browse(df, order_by=["v"], tie_break=["id"], page=p, size=7).collect() for p in range(1, 7)]
    ids = [r.id for page in pages for r in page]
    assert sorted(ids) == list(range(40)) and len(ids) == 40
    found = K.browse(df, filters={"v": ("range", (1, 2))}, search="T1", size=100).collect()
    assert {r.id % 3 for r in found} == {1} and all(1 <= r.v <= 2 for r in found)
    # seek paging gives the same pages
    last = pages[1][-1]
    again = K.browse(df, order_by=["v"], tie_break=["id"], size=7, after=[last.v, last.id]).collect()
    assert again == pages[2]


def test_browse_filter_kinds(spark):
    df = spark.createDataFrame([(1, "fresh", 1994, 7.25), (2, "rotten", 1995, 8.0), (3, None, 2000, 19.94)],
                               "id int, status string, year int, v double")
    ids = lambda **kw: sorted(r.id for r in K.browse(df, size=9, order_by=["id"], **kw).collect())
    assert ids(filters={"status": ("in", ["fresh"])}) == [1]
    assert ids(filters={"status": ("contains", "OTT")}) == [2]
    assert ids(filters={"year": ("contains", "199")}) == [1, 2]
    assert ids(filters={"year": ("range", (None, 1995))}) == [1, 2]
    assert ids(search="1994") == [1] and ids(search="19.94") == [3] and ids(search="7.25") == [1]
    assert K.browse(df, search="1994", hidden=["year"], size=9).columns == ["id", "status", "v"]
    assert K.browse(df, search="1994", hidden=["year"], size=9).count() == 0
    with pytest.raises(ValueError, match="not one text"):
        K.browse(df, filters={"status": ("in", "fresh")})
    with pytest.raises(ValueError, match="unknown kind"):
        K.browse(df, filters={"status": ("like", "fresh")})


def test_constant_columns_have_no_correlation(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 3.0), (1.0, 4.0)], "a double, b double")
    r = A.correlations(df, [("a", "b")]).first()
    assert r.r is None and r.p_value is None and r.n == 3


def test_quantiles_equal_numpy(spark):
    import numpy as np
    rng = np.random.default_rng(3)
    rows = [(g, float(v)) for g, vs in {"x": rng.normal(size=4000), "y": rng.integers(0, 4, 500), "z": [7.5] * 3, None: [1.0, 2.0]}.items() for v in vs]
    df = spark.createDataFrame(rows + [("x", None), ("x", float("nan"))], "g string, v double")
    got = {r.grp: r for r in A.quantiles(A.value_counts(df, "v", "g"), (0.0, 0.25, 0.5, 0.9, 1.0)).collect()}
    for g in ("x", "y", "z", None):
        vs = [v for h, v in rows if h == g]
        assert got[g].n == len(vs)
        assert [got[g][f"q{i}"] for i in range(5)] == pytest.approx(np.quantile(vs, (0.0, 0.25, 0.5, 0.9, 1.0)))


def test_top_k_runs_nothing_while_it_is_planned(spark):
    df = spark.createDataFrame([(i, None) for i in range(3)], "id int, rating_diff double")
    assert K.top_k(df, "rating_diff", 2, True, columns=["id"]).count() == 0


def test_histogram_bins(spark):
    df = spark.createDataFrame([(0.0,), (0.35,), (0.36,), (10.0,), (11.0,), (None,)], "x double")
    h = {r.bin: r["count"] for r in G.histogram(df, "x").collect()}
    assert len(h) == 15 and sum(h.values()) == 4
    assert h[0] == 2 and h[1] == 1 and h[14] == 1  # width 10/14: bin 0 ends at 0.357...
    means = {r["mean"] for r in G.histogram(df, "x").collect()}
    assert len(means) == 1 and means.pop() == pytest.approx((0.35 + 0.36 + 10 + 11) / 5)


def test_box_stats_type7_and_levels(spark):
    df = spark.createDataFrame([("fresh", float(v)) for v in [1, 2, 3, 4, 100]] + [("odd", 5.0)],
                               "status string, v double")
    out = {r.status: r for r in G.box_stats(df, "status", "v", levels=("certified", "fresh")).collect()}
    f = out["fresh"]
    assert (f.q1, f.median, f.q3) == (2.0, 3.0, 4.0)
    assert f.whisker_hi == 4.0 and f.n_outliers == 1
    assert out[None].n == 1  # unknown level -> NULL group
