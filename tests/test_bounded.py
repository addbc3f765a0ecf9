"""Bounded point sets, sketches, the gate inside a plan, accounting on the way."""

import bisect
import hashlib
import random

import pytest
from pyspark.sql import functions as F

from duoscope.operators import clean as C
from duoscope.operators import feeds as G
from duoscope.operators import quality as Q
from duoscope.operators import stats as A


@pytest.fixture(scope="module")
def points(spark):
    rng = random.Random(1)
    rows = [(i, f"t{i}", 1990 + i % 5, rng.gauss(0, 1), rng.gauss(0, 1)) for i in range(3000)]
    rows += [(9000, "far", 2000, 50.0, -40.0), (9001, "none", 2000, None, 1.0), (9002, None, None, 0.0, 0.0)]
    return spark.createDataFrame(rows, "id long, title string, year int, x double, y double")


@pytest.mark.parametrize("limit", [1, 3, 40, 400, 100_000])
def test_limit_holds_whatever_the_partitions(points, limit):
    draw = lambda df: sorted(map(tuple, G.scatter_points(df, "x", "y", limit=limit, key=["id"]).collect()), key=repr)
    one, many = draw(points.coalesce(1)), draw(points.repartition(7))
    assert one == many and len(one) <= limit
    if limit == 400:
        assert any(x == 50.0 for x, *_ in one)      # the lone point stays
    whole = {tuple(r) for r in G.scatter_points(points, "x", "y").collect()}
    assert set(one) <= whole and len(one) == min(limit, 3002)


def test_limit_of_equal_points_and_of_none(spark, points):
    same = points.withColumns({"x": F.lit(1.0), "y": F.lit(2.0)})
    assert G.scatter_points(same, "x", "y", limit=10, key=["id"]).count() == 10
    assert G.scatter_points(points.where("false"), "x", "y", limit=10).count() == 0
    with pytest.raises(ValueError):
        G.scatter_points(points, "x", "y", limit=0)


def test_panels_have_a_limit_each(points):
    pairs = [("x", "y"), ("y", "x")]
    got = G.scatter_panels(points, pairs, limit=50, key=["id"])
    counts = {r.panel: r["count"] for r in got.groupBy("panel").count().collect()}
    assert set(counts) == {"x~y", "y~x"} and all(n == 50 for n in counts.values())
    assert got.columns == G.scatter_panels(points, pairs).columns


def test_row_numbers_are_limited_before_the_shuffle(points):
    plan = G.scatter_points(points, "x", "y", limit=40, key=["id"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


@pytest.mark.parametrize("k, error", [(200, 0.0195), (1600, 0.003)])
def test_sketched_quartiles_are_near_in_rank(spark, k, error):
    rng = random.Random(3)
    groups = {"a": [rng.random() for _ in range(20_000)], "b": [float(i % 7) for i in range(5000)], None: [1.0, 2.0, 4.0]}
    df = spark.createDataFrame([(g, v) for g, vs in groups.items() for v in vs] + [("a", None), ("a", float("nan"))],
                               "g string, v double").repartition(6)
    for r in G.box_stats(df, "g", "v", approx=k).collect():
        vs = sorted(groups[r.g])
        assert r.n == len(vs)
        for q, p in ((r.q1, 0.25), (r.median, 0.5), (r.q3, 0.75)):
            lo, hi = bisect.bisect_left(vs, q) / len(vs), bisect.bisect_right(vs, q) / len(vs)
            assert lo - error - 1 / len(vs) <= p <= hi + error + 1 / len(vs), (r.g, p, q)
    rows = df.select(F.col("g").alias("grp"), "v").where("v IS NOT NULL AND NOT isnan(v)")
    plan = A.kll_quantiles(rows, [0.5], k)._jdf.queryExecution().executedPlan().toString()
    assert "partial_kll_sketch_agg_double" in plan


LINKED = "title string, year int, rating_a double, b_norm double"


def test_the_gate_fails_the_write_itself(spark, tmp_path):
    good = spark.createDataFrame([("a", 1, 1.0, 2.0), ("a", 2, 1.0, 2.0), (None, 2, 1.0, 2.0)], LINKED)
    Q.gated(good).write.parquet(f"{tmp_path}/good")
    assert spark.read.parquet(f"{tmp_path}/good").count() == 3
    assert Q.gated(good.where("false")).count() == 0
    cases = {"duplicate \\(title, year\\) rows: 2": [("a", 1, 1.0, 2.0)] * 2 + [(None, None, 1.0, 2.0)] * 2,
             "NULL values in rating_a": [("a", 1, None, 2.0)], "NULL values in b_norm": [("a", 1, 1.0, float("nan"))]}
    for i, (message, rows) in enumerate(cases.items()):
        bad = Q.gated(spark.createDataFrame(rows, LINKED))      # nothing runs yet
        with pytest.raises(Exception, match=message):
            bad.write.parquet(f"{tmp_path}/bad{i}")
        with pytest.raises(Exception, match=message):
            bad.select("title").collect()                        # also where the ratings are not read


def test_accounting_comes_from_the_cleaning_job(spark):
    raw = spark.createDataFrame([("1999", 5.0, "t"), ("x", 5.0, "u"), ("2000", None, "v"), ("2001.5", 1.0, None)],
                                "year_text string, rating_a double, title string")
    df, seen = C.observed(raw, C.keep_condition_a(), "a")
    cleaned = C.clean_a(df).checkpoint()
    (told,) = C.accounting({"a": seen})
    (want,) = C.cleaning_report(raw, C.keep_condition_a(), "a").collect()
    assert told == want.asDict() and cleaned.count() == told["rows_after"] == 2


def test_few_points_are_ranked_and_they_are_the_right_ones(spark, monkeypatch):
    kept, cut = [], G.cut_lineage
    monkeypatch.setattr(G, "cut_lineage", lambda df: kept.append(df.count()) or cut(df))
    df = spark.range(30_000).selectExpr("id", "concat('t', id) AS title", "2000 AS year", "CAST(id % 10 AS double) AS x",
                                        "CAST(id % 7 AS double) AS y", "id % 3 AS grp")
    got = G.limited_points(df, 8 * 9, ["id"], by=["grp"])
    want = []
    for grp in range(3):        # three by three cells of four points, then the smallest of all
        rows = sorted((hashlib.md5(str(i).encode()).hexdigest(), i) for i in range(30_000) if i % 3 == grp)
        cells = {}
        for h, i in rows:
            cells.setdefault((min(i % 10 * 3 // 9, 2), min(i % 7 * 3 // 6, 2)), []).append((h, i))
        spread = {x for c in cells.values() for x in c[:4]}
        want += [i for _, i in sorted(spread) + [r for r in rows if r not in spread][:72 - len(spread)]]
    assert sorted(r.id for r in got.collect()) == sorted(want) and len(want) == 216
    assert kept and kept[0] < 1500
