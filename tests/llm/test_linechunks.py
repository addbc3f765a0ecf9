import hashlib
import random

from pyspark.sql import functions as F

from duoscope.llm import linechunks as L
from tests.llm.util import ODD, frame, prose


def chunks(text, which=0):
    lines = text.split("\n")
    h = [int(hashlib.md5(x.encode()).hexdigest()[:8], 16) % (1 << 31) for x in lines]
    out, at = [], 0
    for i in range(len(lines)):
        rolling = h[i] + (h[i - 1] * 31 % (1 << 31) if i else 0)
        if i == len(lines) - 1 or rolling // L.MEAN ** which % L.MEAN == 0:
            out.append((at, lines[at:i + 1]))
            at = i + 1
    return out


def neighbours(text):
    """(place, chunk, chunk before, chunk after) of all sets."""
    for which in range(L.SETS):
        cut = chunks(text, which)
        for k, (place, own) in enumerate(cut):
            if len(own) > 1 or own[0].strip(" "):
                yield place, own, cut[k - 1][1] if k else [], cut[k + 1][1] if k + 1 < len(cut) else []


def agreeing(a, b):
    n = 0
    while n < min(len(a), len(b)) and a[n] == b[n]:
        n += 1
    return n


def brute(rows, hashed=lambda t: 0):
    """hashed: what orders texts of one id."""
    first = {}
    for i, t in {(r[0], r[1]) for r in rows if r[1] is not None}:
        for place, own, before, after in neighbours(t):
            digests = [[hashlib.md5(x.encode()).digest() for x in side] for side in (before, after)]
            found = ((i is None, i or 0, hashed(t), place), -len(before) - len(after), digests, before, after)
            key = tuple(own)
            first[key] = min(first.get(key, found), found)
    out = []
    for i, t, *_ in rows:
        if t is None:
            out.append((i, None, 0, 0))
            continue
        lines, gone = t.split("\n"), set()
        for place, own, before, after in neighbours(t):
            at, _, _, f_before, f_after = first[tuple(own)]
            if at != (i is None, i or 0, hashed(t), place):
                lo = place - agreeing(before[::-1], f_before[::-1])
                hi = place + len(own) + agreeing(after, f_after)
                if hi - lo >= 2:
                    gone |= set(range(lo, hi))
        out.append((i, "\n".join(x for n, x in enumerate(lines) if n not in gone), len(lines), len(gone)))
    return out


def table(spark):
    rng = random.Random(6)
    lines = [" ".join(prose(rng, rng.randrange(0, 9))) for _ in range(60)]
    shared = [rng.sample(lines, 25) for _ in range(4)]
    rows = []
    for i in range(50):
        own = [" ".join(prose(rng, 6)) for _ in range(rng.randrange(0, 20))]
        at = rng.randrange(len(own) + 1)
        if rng.random() < 0.6:
            own[at:at] = rng.choice(shared)
        rows.append((i, "\n".join(own), "en", "s"))
    rows += [(100 + i, t, "en", "s") for i, t in enumerate(ODD)]
    rows += [rows[3], rows[3], (None, rows[5][1], "en", "s"), (7, rows[7][1] + "\nmore", "en", "s")]
    rows += [(200, "\n".join(shared[0] * 40), "en", "s"), (201, "\n".join(lines * 30), "en", "s")]
    return frame(spark, rows), rows


def test_equals_brute_force(spark):
    docs, rows = table(spark)
    th = {r[0]: r[1] for r in docs.select("text", F.xxhash64("text")).collect()}
    out = L.dedup_lines(docs, counts=True)
    assert out.columns == docs.columns + ["n_lines", "n_removed"]
    got = [(r.doc_id, r.text, r.n_lines, r.n_removed) for r in out.collect()]
    assert sorted(map(str, got)) == sorted(map(str, brute(rows, th.get)))
    assert sum(r[3] for r in got) > 100


def test_boundaries_resist_shifts():
    rng = random.Random(2)
    text = [" ".join(prose(rng, 7)) for _ in range(200)]
    a = {"\n".join(c) for _, c in chunks("\n".join(text))}
    b = {"\n".join(c) for _, c in chunks("\n".join(["new first line", "and another"] + text))}
    assert len(a & b) >= len(a) - 2


def recall(spark, lengths, per=60):
    """Share of repeated passages of so many lines, in other texts each time, that lose a line; of their lines."""
    rng = random.Random(1)
    line = lambda: " ".join(prose(rng, 8, 10**6))
    rows, found = [], []
    for n in lengths:
        for _ in range(per):
            passage, at = [line() for _ in range(n)], len(rows)
            for k in range(2):
                own = [line() for _ in range(rng.randrange(1, 12))]
                cut = rng.randrange(len(own) + 1)
                rows.append((at + k, "\n".join(own[:cut] + passage + own[cut:]), "en", "s"))
            found.append((n, at + 1, len(passage)))
    got = {r.doc_id: r for r in L.dedup_lines(frame(spark, rows), counts=True).collect()}
    assert all(got[i].n_removed == 0 for i in range(0, len(rows), 2))
    out = {}
    for n in lengths:
        mine = [got[i].n_removed / k for m, i, k in found if m == n]
        assert max(mine) <= 1
        out[n] = (round(sum(x > 0 for x in mine) / per, 2), round(sum(mine) / per, 2))
    return out


def test_recall_by_length(spark):
    """The README's figures: passages of five lines or more are found nearly always, and then whole."""
    got = recall(spark, (2, 3, 4, 5, 6, 8, 10, 20))
    print(got)
    assert all(got[n][0] >= 0.9 for n in (5, 6, 8, 10, 20)) and all(got[n][1] >= 0.85 for n in (5, 6, 8, 10, 20))


def test_no_line_vanishes_altogether(spark):
    docs, rows = table(spark)
    kept = {x for r in L.dedup_lines(docs).collect() if r.text is not None for x in r.text.split("\n")}
    assert {x for _, t, *_ in rows if t for x in t.split("\n")} <= kept | {""}


def test_plan_has_no_python(spark):
    docs, _ = table(spark)
    plan = L.dedup_lines(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_empty_table(spark):
    docs, _ = table(spark)
    assert L.dedup_lines(docs.limit(0)).count() == 0
