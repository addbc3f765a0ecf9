import random

import numpy as np
from hypothesis import given, settings, strategies as st

from duoscope.llm import mixing as M
from tests.llm.util import ODD, frame, prose, spaced


def table(spark):
    rng = random.Random(8)
    rows = []
    for i in range(300):
        source = rng.choice(["a", "a", "a", "a", "b", "c", "ä", None])
        rows.append((i, " ".join(prose(rng, rng.choice([0, 3, 40, 300]))), "en", source))
    rows += [(900 + i, t, "en", "b") for i, t in enumerate(ODD)]
    rows += [rows[0], rows[0], (None, "a b c", "en", "d"), (950, " ".join(prose(rng, 20000)), "en", "c"), (951, None, "en", "empty")]
    return frame(spark, rows), rows


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 5000), st.integers(0, 1 << 40))
def test_permutation(n, key):
    assert sorted(M.permute(np.arange(n), n, key).tolist()) == list(range(n))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 10_000), min_size=1, max_size=9))
def test_targets_share_all(sizes):
    w = [1 + i % 3 for i in range(len(sizes))]
    t = M.targets(sizes, w)
    assert abs(sum(t) - sum(sizes)) < 1e-6 * max(1, sum(sizes))
    assert all(x <= 3 * s + 1e-6 for x, s in zip(t, sizes))
    free = [x / v for x, s, v in zip(t, sizes, w) if x < 3 * s - 1e-6]
    assert not free or max(free) - min(free) < 1e-6 * max(1.0, max(free))


def test_draws_meet_the_quotas():
    quota = np.array([100, 0, 7, 3000])
    got = M.draw(quota, 128, 1)
    assert np.array_equal(sum(got), quota) and all(g.sum() == 128 for g in got[:-1])


def test_blocks_fill_the_mixture(spark):
    """Each drawn block comes out whole, and taken equals the words of the mixture."""
    docs, rows = table(spark)
    mix = M.Mix(docs, block=64, shard_blocks=50)
    pieces = [r.asDict() for r in mix.mixed().collect()]
    blocks = {r.src: (r.n_blocks, r.source_size) for r in mix.sources.collect()}
    size = {}
    for p in pieces:
        size[p["src"], p["slot"], p["block"]] = size.get((p["src"], p["slot"], p["block"]), 0) + p["n"]
    for (src, _, block), n in size.items():
        total = blocks[src][1]
        assert n == min(64, total - 64 * block)
    for src, (n, _) in blocks.items():
        slots = sorted((s, b) for x, s, b in size if x == src)
        for turn in range(3):       # every pass over a source takes each block once at most
            part = [b for s, b in slots if s // max(n, 1) == turn]
            assert len(part) == len(set(part))
    assert sum(p["n"] for p in pieces) == sum(r.taken for r in mix.taken().collect())


def test_mix(spark):
    docs, rows = table(spark)
    got = M.mix_sources(docs, block=64, shard_blocks=50).collect()
    key = lambda i: (i is None, i or 0)
    assert sorted((key(r.doc_id), r.size) for r in got) == sorted((key(i), len(spaced(t))) for i, t, _, _ in rows)
    assert all(r.taken <= 3 * r.size for r in got)
    sizes, taken = {}, {}
    for i, t, _, s in rows:
        sizes[s] = sizes.get(s, 0) + len(spaced(t))
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    want = dict(zip(order, M.targets([sizes[s] for s in order], [1 + i % 3 for i in range(len(order))])))
    source = {i: s for i, _, _, s in rows}
    for r in got:
        s = source[r.doc_id]
        assert r.source_size == sizes[s] and abs(r.target - want[s]) < 1e-6
        taken[s] = taken.get(s, 0) + r.taken
    for s in order:
        assert abs(taken[s] - want[s]) <= 64 + 0.02 * want[s], s
    again = M.mix_sources(docs.repartition(7), block=64, shard_blocks=50).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))
    assert M.mix_sources(docs.limit(0)).count() == 0
