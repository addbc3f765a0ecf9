import random
import string

import pytest

from duoscope.operators import link as J

A_SCHEMA = "a_id long, title_clean string, year int, rating_a double"
B_SCHEMA = "b_id long, title_clean string, release_year int, b_norm double"


def run_link(spark, left, right, **kw):
    a = spark.createDataFrame(left, A_SCHEMA)
    b = spark.createDataFrame(right, B_SCHEMA)
    return J.link(a, b, "year", "release_year", "b_id", b_cols=["b_id", "b_norm"], **kw)


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_exact_many_to_many_and_tags(spark):
    left = [(1, "heat", 1995, 8.3), (2, "heat", 1995, 8.3)]
    right = [(10, "heat", 1995, 8.6), (11, "heat", 1995, 8.0)]
    res = run_link(spark, left, right)
    assert rows(res.linked, "a_id", "b_id", "match_type") == [
        (1, 10, "exact"), (1, 11, "exact"), (2, 10, "exact"), (2, 11, "exact")]


def test_remake_in_other_year_is_never_fuzzy_matched(spark):
    # 'heat' matched exactly in 1995, so the 1986 'heat' (no 1986 partner) is excluded
    # from the fuzzy stage even though 'heat!' exists in 1986 (title-only anti-join).
    left = [(1, "heat", 1995, 8.3), (2, "heat", 1986, 7.0)]
    right = [(10, "heat", 1995, 8.6), (11, "heat!", 1986, 5.0)]
    res = run_link(spark, left, right)
    assert rows(res.linked, "a_id", "b_id", "match_type") == [(1, 10, "exact")]
    assert rows(res.unlinked, "a_id") == []


def test_right_row_reused_by_exact_and_fuzzy(spark):
    left = [(1, "the godfather", 1972, 9.2), (2, "the godfathers", 1972, 9.0)]
    right = [(10, "the godfather", 1972, 10.0)]
    res = run_link(spark, left, right)
    assert rows(res.linked, "a_id", "b_id", "match_type") == [(1, 10, "exact"), (2, 10, "fuzzy")]
    fz = res.linked.where("match_type = 'fuzzy'").first()
    assert fz.title_clean is None  # fuzzy rows carry no title_clean


def _with_replacements(base, k):
    repl = "#$%&*+-/:;<=>?@^_~!|"
    return base[: len(base) - k] + repl[:k]


def test_threshold_is_strict():
    base = (string.ascii_lowercase + string.digits + "ABCDEFGHIJKLMN")[:50]
    assert len(set(base)) == 50
    # 41 of 50 matches, no transpositions -> similarity 0.88 exactly -> distance 0.12
    from duoscope.functions.jaro import jaro_distance_value
    assert jaro_distance_value(base, _with_replacements(base, 9)) == 0.12
    assert jaro_distance_value(base, _with_replacements(base, 8)) < 0.12
    assert jaro_distance_value(base, _with_replacements(base, 10)) > 0.12


def test_distance_below_at_above_threshold(spark):
    base = (string.ascii_lowercase + string.digits + "ABCDEFGHIJKLMN")[:50]
    left = [(1, base, 2000, 7.0), (2, base, 2001, 7.0), (3, base, 2002, 7.0)]
    right = [(10, _with_replacements(base, 8), 2000, 5.0),   # 0.1067 -> match
             (11, _with_replacements(base, 9), 2001, 5.0),   # 0.12   -> no match (strict)
             (12, _with_replacements(base, 10), 2002, 5.0)]  # 0.1333 -> no match
    res = run_link(spark, left, right)
    assert rows(res.linked, "a_id", "b_id", "match_type") == [(1, 10, "fuzzy")]
    assert rows(res.unlinked, "a_id") == [(2,), (3,)]


def test_equal_distance_tie_goes_to_first_right_row(spark):
    left = [(1, "abcdefghij", 2000, 7.0)]
    right = [(12, "abcdefghiX", 2000, 5.0), (11, "abcdefghiY", 2000, 6.0), (13, "abcdefghiZ", 2000, 6.0)]
    res = run_link(spark, left, right)
    assert rows(res.linked, "a_id", "b_id") == [(1, 11)]


def test_no_candidate_in_year_and_null_title(spark):
    left = [(1, "alien", 1979, 8.5), (2, None, 1979, 6.0)]
    right = [(10, "alien", 1980, 9.0)]
    res = run_link(spark, left, right)
    assert res.linked.count() == 0
    assert rows(res.unlinked, "a_id") == [(1,), (2,)]


def test_unlinked_plus_linked_left_rows_cover_the_left(spark):
    left = [(1, "alien", 1979, 8.5), (2, "aliens", 1979, 8.0), (3, "zzz", 1979, 1.0)]
    right = [(10, "alien", 1979, 9.0)]
    res = run_link(spark, left, right)
    linked_ids = {r.a_id for r in res.linked.select("a_id").collect()}
    unlinked_ids = {r.a_id for r in res.unlinked.select("a_id").collect()}
    assert linked_ids == {1, 2} and unlinked_ids == {3}


def _random_titles(rnd, n, alpha="abcdef ghij"):
    base = ["".join(rnd.choice(alpha) for _ in range(rnd.randint(3, 18))) for _ in range(n)]
    out = []
    for t in base:
        s = list(t)
        for _ in range(rnd.randint(0, 3)):
            if s and rnd.random() < 0.5:
                s.pop(rnd.randrange(len(s)))
            else:
                s.insert(rnd.randrange(len(s) + 1), rnd.choice(alpha))
        out.append("".join(s))
    return base, out


@pytest.mark.parametrize("max_dist,cell_rows", [(0.12, 4096), (0.2, 7), (0.35, 5)])
def test_pruning_and_salting_are_lossless(spark, max_dist, cell_rows):
    rnd = random.Random(11)
    lt, rt = _random_titles(rnd, 120)
    left = [(i, t, 2000 + i % 3, 5.0) for i, t in enumerate(lt)]
    right = [(100 + i, t, 2000 + i % 3, 5.0) for i, t in enumerate(rt + lt[:10])]
    a = spark.createDataFrame(left, A_SCHEMA)
    b = spark.createDataFrame(right, B_SCHEMA)
    pruned = J.link(a, b, "year", "release_year", "b_id", b_cols=["b_id", "b_norm"],
                    max_dist=max_dist, cell_rows=cell_rows)
    full = J.link(a, b, "year", "release_year", "b_id", b_cols=["b_id", "b_norm"],
                  max_dist=max_dist, prune=False)
    got = rows(pruned.linked, "a_id", "b_id", "match_type")
    want = rows(full.linked, "a_id", "b_id", "match_type")
    assert got == want
    assert pruned.candidates.count() <= full.candidates.count()


def test_brute_force_reference(spark):
    """The Spark link equals a plain-Python implementation of the rules."""
    from duoscope.functions.jaro import jaro_distance_value
    rnd = random.Random(5)
    lt, rt = _random_titles(rnd, 60)
    left = [(i, t, 1990 + i % 2, 5.0) for i, t in enumerate(lt)]
    right = [(100 + i, t, 1990 + i % 2, 5.0) for i, t in enumerate(rt + lt[:5])]
    exact = [(a[0], b[0]) for a in left for b in right if a[1] == b[1] and a[2] == b[2]]
    exact_titles = {a[1] for a in left for b in right if a[1] == b[1] and a[2] == b[2]}
    fuzzy = []
    for a in left:
        if a[1] in exact_titles:
            continue
        cands = [(jaro_distance_value(a[1], b[1]), b[0]) for b in right if b[2] == a[2]]
        if cands:
            d, bid = min(cands)
            if d < 0.12:
                fuzzy.append((a[0], bid))
    res = run_link(spark, left, right)
    assert rows(res.exact, "a_id", "b_id") == sorted(exact)
    assert rows(res.fuzzy, "a_id", "b_id") == sorted(fuzzy)


@pytest.mark.parametrize("cell_rows", [3, 50])
def test_grid_join_path_equals_broadcast_path(spark, cell_rows):
    """Force the sort-merge grid path (hot keys split into cells) and compare."""
    rnd = random.Random(23)
    lt, rt = _random_titles(rnd, 150)
    left = [(i, t, 2000 + i % 2, 5.0) for i, t in enumerate(lt)]
    right = [(100 + i, t, 2000 + i % 2, 5.0) for i, t in enumerate(rt + lt[:15])]
    a = spark.createDataFrame(left, A_SCHEMA)
    b = spark.createDataFrame(right, B_SCHEMA)
    kw = dict(b_cols=["b_id", "b_norm"])
    grid = J.link(a, b, "year", "release_year", "b_id", broadcast_rows=0, cell_rows=cell_rows, **kw)
    bcast = J.link(a, b, "year", "release_year", "b_id", **kw)
    assert rows(grid.candidates, "a_t", "b_t") == rows(bcast.candidates, "a_t", "b_t")
    assert rows(grid.linked, "a_id", "b_id", "match_type") == rows(bcast.linked, "a_id", "b_id", "match_type")


def test_result_does_not_depend_on_partition_count(spark):
    rnd = random.Random(31)
    lt, rt = _random_titles(rnd, 80)
    left = [(i, t, 1999, 5.0) for i, t in enumerate(lt)]
    right = [(100 + i, t, 1999, 5.0) for i, t in enumerate(rt)]
    out = []
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for n in ("1", "7"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            a = spark.createDataFrame(left, A_SCHEMA).repartition(int(n))
            b = spark.createDataFrame(right, B_SCHEMA).repartition(int(n))
            res = J.link(a, b, "year", "release_year", "b_id", b_cols=["b_id", "b_norm"])
            out.append(rows(res.linked, "a_id", "b_id", "match_type"))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert out[0] == out[1]


def test_without_order_column_ties_are_deterministic(spark):
    a = spark.createDataFrame([(1, "abcdefghij", 2000, 7.0)], A_SCHEMA)
    b = spark.createDataFrame([(12, "abcdefghiX", 2000, 5.0), (11, "abcdefghiY", 2000, 6.0),
                               (11, "abcdefghiY", 2000, 6.0)], B_SCHEMA)
    res = J.link(a, b, "year", "release_year", None, b_cols=["b_id", "b_norm"])
    got = rows(res.linked, "a_id", "b_id", "match_type")
    # both candidates are equally close; ordered by all right columns in frame order
    # (b_id first), the duplicated row 11 wins once
    assert got == [(1, 11, "fuzzy")]
    assert "_b_order" not in res.linked.columns


def test_repeated_order_value_picks_the_smallest_row(spark):
    a = spark.createDataFrame([(1, "abcdefghij", 2000, 7.0)], A_SCHEMA)
    rows = [(11, "abcdefghiY", 2000, 9.0), (11, "abcdefghiY", 2000, 6.0), (11, "abcdefghiY", 2000, 8.0)]
    for part in (1, 3):
        b = spark.createDataFrame(rows, B_SCHEMA).repartition(part)
        res = J.link(a, b, "year", "release_year", "b_id", b_cols=["b_id", "b_norm"])
        assert [r.b_norm for r in res.linked.collect()] == [6.0]


def test_dedupe_right_keeps_the_first_of_each_title(spark):
    left = [(1, "heat", 1995, 8.3), (2, "heap", 1995, 8.3)]
    right = [(12, "heat", 1995, 1.0), (11, "heat", 1995, 2.0)]
    res = run_link(spark, left, right, dedupe_right=True)
    assert rows(res.exact, "a_id", "b_id") == [(1, 11)]


def test_exact_stage_does_not_touch_the_fuzzy_one(spark, monkeypatch):
    def no(*a, **k):
        raise AssertionError("fuzzy stage was built")
    monkeypatch.setattr(J, "fuzzy_link", no)
    res = run_link(spark, [(1, "heat", 1995, 8.3)], [(10, "heat", 1995, 8.6)])
    assert res.exact.count() == 1 and res.unmatched.count() == 0


def test_nothing_stays_cached(spark):
    res = run_link(spark, [(1, "the godfather", 1972, 9.2), (2, "the godfathers", 1972, 9.0)], [(10, "the godfather", 1972, 9.7)])
    assert res.linked.count() == 2 and res.unlinked.count() == 0
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == 0


def test_grid_plan_shuffles_no_row_on_the_bare_key(spark):
    rnd = random.Random(3)
    lt, rt = _random_titles(rnd, 40)
    a = spark.createDataFrame([(i, t, 2000, 5.0) for i, t in enumerate(lt)], A_SCHEMA)
    b = spark.createDataFrame([(i, t, 2000, 5.0) for i, t in enumerate(rt)], B_SCHEMA)
    res = J.link(a, b, "year", "release_year", "b_id", b_cols=["b_id"], broadcast_rows=0, cell_rows=4)
    plan = res.candidates._jdf.queryExecution().executedPlan().toString()
    import re
    keys = [re.sub(r"#\d+L?", "", k) for k in re.findall(r"hashpartitioning\(([^)]*?), \d+\)", plan)]
    assert keys and all("i" in k.split(", ") or "r_i" in k.split(", ") for k in keys), keys


def test_a_hot_block_is_many_cells(spark):
    """Cells bound what a task's group holds: no group key without the grid cell, whatever the block."""
    rnd = random.Random(9)
    lt, rt = _random_titles(rnd, 200)
    u = spark.createDataFrame([(t, 2000) for t in set(lt)], "a_t string, blk int")
    b = spark.createDataFrame([(t, 2000, i) for i, t in enumerate(sorted(set(rt)))], "b_t string, blk int, b_ord int")
    got = J.close_pairs(u, b, cell_rows=10)
    plan = got._jdf.queryExecution().executedPlan().toString()
    import re
    keys = {re.sub(r"#\d+L?", "", k) for k in re.findall(r"hashpartitioning\(([^)]*?), \d+\)", plan)}
    assert keys == {"cell"}, keys
    whole = J.close_pairs(u, b)
    assert rows(got, "a_t", "b_t", "dist") == rows(whole, "a_t", "b_t", "dist")
    from duoscope.functions.jaro import jaro_distance_value
    assert rows(got, "a_t", "b_t") == sorted((x, y) for x in set(lt) for y in set(rt) if jaro_distance_value(x, y) < 0.12)


def test_empty_sides(spark):
    u = spark.createDataFrame([], "a_t string, blk int")
    b = spark.createDataFrame([("abc", 1, 2)], "b_t string, blk int, b_ord int")
    assert J.close_pairs(u, b).count() == 0 and J.close_pairs(u.union(spark.createDataFrame([("abd", 2)], u.schema)), b).count() == 0


def test_a_hot_exact_key_is_dealt_over_cells(spark):
    """One key with half of all rows of either side: result as before, in more than one cell."""
    left = [(i, "hot" if i % 2 else f"t{i % 40}", 2000, 5.0) for i in range(120)] + [(500, None, 2000, 1.0)]
    left += [(501, "hot", None, 1.0), (502, "twin", 2000, 1.0), (502, "twin", 2000, 1.0)]
    right = [(i, "hot" if i % 2 else f"t{i % 30}", 2000, 5.0) for i in range(90)] + [(600, None, 2000, 1.0), (601, "twin", 2000, 2.0)]
    a, b = spark.createDataFrame(left, A_SCHEMA), spark.createDataFrame(right, B_SCHEMA)
    got = J.exact_link(a, b, "year", "release_year", hot_rows=7)
    want = sorted((x[0], y[0]) for x in left for y in right if x[1] is not None and x[1:3] == y[1:3])
    assert rows(got, "a_id", "b_id") == want and got.columns == J.exact_link(a, b, "year", "release_year").columns
    key = J.F.xxhash64("title_clean", "k").alias("h")
    hot = J.hot_keys(a.withColumnRenamed("year", "k").select(key), b.withColumnRenamed("release_year", "k").select(key), 7)
    (one,) = hot.collect()
    assert (one.sa, one.sb) == (9, 7)   # 61 rows (its other block has its own key) and 45 rows of 7 each
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "_i" in plan.split("Join Inner")[1].split("\n")[0] and "approx_top_k" in plan
    none = spark.createDataFrame([], A_SCHEMA)
    assert J.exact_link(none, b, "year", "release_year").count() == 0


def test_cells_are_not_merged_by_their_bytes(spark):
    """Cells are few bytes and much work: every one may have its task."""
    from pyspark.sql import functions as F

    titles = [f"the {w} of {v} night {i}" for i, (w, v) in enumerate((w, v) for w in ("end", "start", "edge") for v in ("this", "that", "every"))]
    u = spark.createDataFrame([(t, y) for t in titles for y in range(40)], "a_t string, blk int")
    b = spark.createDataFrame([(t + "s", y, i) for i, t in enumerate(titles) for y in range(40)], "b_t string, blk int, b_ord long")
    close = J.close_pairs(u, b, cell_rows=4)
    assert close.where("dist < 0.12").count() >= 360
    found = close.withColumn("p", F.spark_partition_id()).select("p").distinct().count()
    assert found > 1
