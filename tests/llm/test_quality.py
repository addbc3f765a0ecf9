import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from duoscope.llm import quality as Q
from tests.llm.util import ODD, SPACED, frame, prose


def counts(t):
    t = t or ""
    w, seen, dup = SPACED.findall(t), set(), 0
    for line in t.split("\n"):
        if SPACED.search(line):
            dup += line in seen
            seen.add(line)
    five = Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
    covered = {i + j for i in range(len(w) - 4) if five[tuple(w[i:i + 5])] > 1 for j in range(5)}
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), dup, len(covered)


def table(spark):
    rng = random.Random(4)
    rows = []
    for i in range(240):
        w = prose(rng, rng.randrange(30, 300), 3000)
        rows.append((i, "\n".join(" ".join(w[j:j + 12]) for j in range(0, len(w), 12)), "en", ["a", None][i % 2]))
    junk = [(1000 + i, " ".join(x + "###$" for x in prose(rng, 200, 3000)), "en", "a") for i in range(20)]
    loops = [(2000 + i, " ".join(prose(rng, 30, 50) * 6), "en", "a") for i in range(5)]
    few = [(3000 + i, " ".join(prose(rng, 40)) + " %%%%%%%%%%" * 9, None, "few") for i in range(4)]
    odd = [(4000 + i, t, "en", "a") for i, t in enumerate([*ODD, " a b c d e a b c d e \n\n", "a b c d e\n" * 3, "x " * 30000])]
    rows += junk + loops + few + odd + [(None, "a b", "en", "a"), rows[0], rows[0]]
    return frame(spark, rows), rows


@pytest.fixture(scope="module")
def judged(spark):
    docs, rows = table(spark)
    return Q.quality(docs).collect(), rows


def test_counts_equal_brute_force(judged):
    got, rows = judged
    want = [(i, *counts(t)) for i, t, *_ in rows]
    assert sorted(str((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)) for r in got) == sorted(map(str, want))
    for r in got:
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
        assert not (r.kept and r.base_failed) and (r.distance2 is None or not r.base_failed)


def test_outliers_go_and_clean_texts_stay(judged):
    got, _ = judged
    kept = {r.doc_id: r.kept for r in got}
    assert all(kept[i] for i in range(240))
    assert not any(kept[1000 + i] for i in range(20))
    assert not any(kept[2000 + i] for i in range(5))
    assert all(kept[3000 + i] for i in range(4))        # too few for an estimate


def test_chi_square():
    assert Q.chi2_cdf(Q.chi2_quantile(0.975, 4), 4) == pytest.approx(0.975)
    assert Q.chi2_quantile(0.95, 2) == pytest.approx(-2 * math.log(0.05))


def test_estimate_ignores_a_fifth_of_outliers(spark):
    """Centre and scatter against those of the good vectors alone (NumPy)."""
    rng = np.random.default_rng(5)
    mix = rng.normal(size=(4, 4)) * 0.3 + np.eye(4)
    good = rng.normal(size=(1500, 4)) @ mix.T + [1, 2, 3, 4]
    bad = rng.normal(size=(350, 4)) * 0.2 + [25, -20, 3, 30]
    rows = [("en", "s", *map(float, v)) for v in np.vstack((good, bad))]
    df = spark.createDataFrame(rows, "lang string, source string, x0 double, x1 double, x2 double, x3 double")
    est = Q.robust_estimates(df).first()
    assert np.allclose([est[f"m{i}"] for i in range(4)], good.mean(0), atol=0.15)
    low = np.array([[est[f"l_{i}_{j}"] if j <= i else 0.0 for j in range(4)] for i in range(4)])
    want = np.cov(good.T)
    assert np.abs(low @ low.T - want).max() < 0.2 * np.abs(want).max()
    d2 = df.crossJoin(spark.createDataFrame([est.asDict()]).drop("lang", "source")).select(Q._distance2().alias("d"), "x0").collect()
    limit = Q.chi2_quantile(Q.CUTOFF, 4)
    assert all(r.d > limit for r in d2[1500:]) and sum(r.d > limit for r in d2[:1500]) == 0


def test_no_python_and_empty(spark):
    docs, _ = table(spark)
    plan = Q.base_counts(docs.select(F.col("doc_id").alias("id"), "text"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert Q.quality(docs.limit(0)).count() == 0


def test_each_statistic_alone_decides_and_small_sources_use_their_language(spark):
    rng = random.Random(6)
    lined = lambda w: [" ".join(w[j:j + 12]) for j in range(0, len(w), 12)]
    rows = [(i, "\n".join(lined(prose(rng, rng.randrange(30, 300), 3000))), "en", "a") for i in range(150)]
    w = prose(rng, 910, 10**6)
    bad = {1000: " ".join("x" * 30 + x for x in prose(rng, 200, 3000)),
           1001: "\n".join(lined([x + "#" for x in prose(rng, 200, 3000)])),
           1002: "\n".join(f"{x}\nRead more" for x in lined(prose(rng, 480, 3000))),
           1003: " ".join(w + w[300:390])}
    rows += [(i, t, "en", "a") for i, t in bad.items()]
    rows += [(2000 + i, t, "en", "tiny") for i, t in enumerate([*bad.values(), rows[0][1], rows[1][1]])]
    rows += [(3000, bad[1001], "de", "tiny")]
    got = {r.doc_id: r for r in Q.quality(frame(spark, rows)).collect()}
    assert len(got) == len(rows) and not any(r.base_failed for r in got.values())
    assert all(got[i].kept for i in range(150))
    assert not any(got[i].kept for i in bad)
    assert [got[2000 + i].kept for i in range(6)] == [False] * 4 + [True] * 2
    assert got[2004].distance2 is not None and got[3000].distance2 is None and got[3000].kept
