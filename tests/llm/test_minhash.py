import random

import numpy as np
import pytest

from duoscope.llm import minhash as M
from tests.llm.util import ODD, frame, prose, spaced


def sets(rows, k):
    out = []
    for _, t, *_ in rows:
        w = spaced(t)
        out.append(frozenset(tuple(w[i:i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else []))
    return out


def brute(rows, k, percent):
    """Per row: (id, set size, smallest id of the component)."""
    s = sets(rows, k)
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(s[i] & s[j])
            if both and 100 * both >= percent * len(s[i] | s[j]):
                parent[max(find(i), find(j))] = min(find(i), find(j))
    low = {}
    for i, (ident, *_) in enumerate(rows):
        if ident is not None:
            low[find(i)] = min(low.get(find(i), ident), ident)
    return [(r[0], len(s[i]), low.get(find(i)) if s[i] else r[0]) for i, r in enumerate(rows)]


def table(spark, seed=1, n=30):
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        base = prose(rng, rng.choice([1, 2, 3, 8, 60, 200]), 3000)
        for _ in range(rng.choice([1, 1, 2, 6])):
            w = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 3, 4])):
                w[rng.randrange(len(w))] = f"x{rng.randrange(999)}"
            rows.append((0, (" " if rng.random() < 0.5 else "\n").join(w)))
    chain = prose(rng, 300, 3000)                # neighbours are alike, the ends are not
    for _ in range(12):
        rows.append((0, " ".join(chain)))
        chain = chain[4:] + prose(rng, 4, 3000)
    rng.shuffle(rows)
    rows = [(3 * i + 1, t, "en", "s") for i, (_, t) in enumerate(rows)]
    rows += [(2000 + i, t, "en", "s") for i, t in enumerate(ODD)]
    rows += [rows[4], (rows[7][0], rows[9][1], "en", "s"), (None, rows[11][1], "en", "s"), (None, "quite alone here", "en", "s"), (5000, "ONE", None, None)]
    return frame(spark, rows), rows


@pytest.mark.parametrize("k, percent", [(3, 85), (5, 80)])
def test_components_equal_brute_force(spark, k, percent):
    docs, rows = table(spark)
    got = [tuple(r) for r in M.near_duplicates(docs, shingle=k, percent=percent).collect()]
    assert sorted(map(str, got)) == sorted(map(str, brute(rows, k, percent)))


def test_star_alone_is_not_relied_on(spark):
    """Links between members of one bucket that do not match its hub are found by the cells."""
    rng = random.Random(7)
    core, rows = prose(rng, 220, 5000), []
    for g in range(6):                           # groups at about 0.75 from each other
        base = list(core)
        for i in range(0, 220, 30):
            base[i + g] = f"g{g}{i}"
        for c in range(3):
            w = list(base)
            w[100 + 3 * c] = f"c{g}{c}"
            rows.append((len(rows), " ".join(w), "en", "s"))
    docs = frame(spark, rows)
    got = sorted(tuple(r) for r in M.near_duplicates(docs).collect())
    assert got == sorted(brute(rows, 3, 85))
    assert len({c for _, _, c in got}) > 1


def test_templates_are_left_out_before_pairs(spark):
    """A shared template of three quarters: same result, and no member is left to be paired."""
    rng = random.Random(3)
    template, rows = prose(rng, 150, 10**6), []
    for _ in range(60):
        own = prose(rng, 50, 10**6)
        rows.append((len(rows), " ".join(template + own), "en", "s"))
        if rng.random() < 0.3:
            own[20] = "edited"
            rows.append((len(rows), " ".join(template + own), "en", "s"))
    docs = frame(spark, rows)
    got = sorted(tuple(r) for r in M.near_duplicates(docs).collect())
    assert got == sorted(brute(rows, 3, 85)) and 55 < len({c for _, _, c in got}) < len(rows)
    label = {i: c for i, _, c in got}
    member = spark.createDataFrame([(0, i, label[i]) for i in label], "grp long, node long, label long")
    items = [(i, np.unique([hash(x) & (2**62 - 1) for x in s]).astype(np.uint64).tobytes()) for (i, *_), s in zip(rows, sets(rows, 3))]
    full = spark.createDataFrame(items, "node long, items binary")
    assert M.linkable(member, full, 85).count() == 0
    alike = spark.createDataFrame([(0, i, i) for i in label], "grp long, node long, label long")    # as if no link were known
    left = {r.node for r in M.linkable(alike, full, 85).collect()}
    assert {i for i, c in label.items() if sum(x == c for x in label.values()) > 1} <= left


def test_components_of_paths_stars_and_cycles(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 9)] + [(200, 201), (201, 202), (202, 200)] + [(300, 301)]
    got = {r.node: r.root for r in M.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = {i: 0 for i in range(1, 41)} | {100 + i: 100 for i in range(1, 9)} | {201: 200, 202: 200, 301: 300}
    assert got == want
    assert M.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_signature_agreement_estimates_similarity():
    rng = np.random.default_rng(3)
    a, b = M._coefficients(512, 1)
    x = rng.integers(0, 1 << 63, 3000).astype(np.uint64)
    y = np.concatenate((x[:2400], rng.integers(0, 1 << 63, 600).astype(np.uint64)))
    assert abs((M.signature(x, a, b) == M.signature(y, a, b)).mean() - 2400 / 3600) < 0.07


def test_empty_table(spark):
    docs, _ = table(spark, n=2)
    assert M.near_duplicates(docs.limit(0)).count() == 0
