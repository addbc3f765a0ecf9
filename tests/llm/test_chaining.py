import random

import pytest
from hypothesis import given, settings, strategies as st

from duoscope.llm import chaining as C
from tests.llm.util import ODD, frame, prose, spaced


def brute_chain(x, y, k, gap):
    """Best chain score by trying every predecessor."""
    rows = sorted(range(len(x)), key=lambda i: (x[i], -y[i]))
    score = {}
    for n, i in enumerate(rows):
        score[i] = float(k)
        for j in rows[:n]:
            if x[j] < x[i] and y[j] < y[i]:
                joined = score[j] - gap * (x[i] + y[i] - x[j] - y[j])
                if joined > 0:
                    new = min(k, x[i] - x[j], y[i] - y[j])
                    score[i] = max(score[i], joined + new + gap * 2 * new)
    return max(score.values())


def chain_score(c, x, y, k, gap):
    s = float(k)
    for j, i in zip(c[:-1], c[1:]):
        new = min(k, x[i] - x[j], y[i] - y[j])
        s = s - gap * (x[i] + y[i] - x[j] - y[j]) + new + gap * 2 * new
    return s


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 10), st.integers(0, 10)), min_size=1, max_size=12, unique=True))
def test_chains_go_forward_and_the_best_is_near_the_optimum(points):
    x, y = [8 * p for p, _ in points], [8 * q for _, q in points]
    found = C.chains(x, y, 5, 0.15)
    assert sorted(i for c in found for i in c) == list(range(len(x)))
    for c in found:
        assert all(x[a] < x[b] and y[a] < y[b] for a, b in zip(c[:-1], c[1:]))
    best = max(chain_score(c, x, y, 5, 0.15) for c in found)
    assert best == pytest.approx(brute_chain(x, y, 5, 0.15))


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from("abcdef"), max_size=14), st.lists(st.sampled_from("abcdef"), max_size=14))
def test_equal_blocks_are_equal_and_in_order(p, q):
    a = b = 0
    for i, j, n in C.equal_blocks(p, q):
        assert n and i >= a and j >= b and p[i:i + n] == q[j:j + n]
        a, b = i + n, j + n


def coded_align(p, q):
    import pyarrow as pa
    texts = [" ".join(w).encode() for w in (q, p, [], q)]
    c = C.Coded(pa.array(texts, pa.large_binary()))
    assert c.size.tolist() == [len(q), len(p), 0, len(q)]
    return c.align(int(c.start[1]), int(c.start[1]) + len(p), int(c.start[3]), int(c.start[3]) + len(q))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from("abcdefgh"), max_size=30), st.lists(st.sampled_from("abcdefgh"), max_size=30), st.integers(0, 30))
def test_coded_texts_align_as_lists_of_words(p, q, at):
    """Also where texts repeat themselves, or hold the same runs in another order."""
    assert coded_align(p, q) == C.align(p, q)
    q = q[:5] + p[at:] + q[5:] + p[:at]
    assert coded_align(p, q) == C.align(p, q)
    assert coded_align(p, p) == (0, len(p), 0, len(p), len(p))


def test_coded_edited_copies_have_one_anchor_for_each_run():
    """Anchors and the alignment cost by runs that agree, not by words."""
    import pyarrow as pa
    rng = random.Random(6)
    p = prose(rng, 300, 10**6)
    q = [f"other{i}" if i % 20 == 10 else w for i, w in enumerate(p)]
    c = C.Coded(pa.array([" ".join(w).encode() for w in (p, q)], pa.large_binary()))
    assert len(c.anchors(0, 300, 300, 600)) == 16
    assert coded_align(p, q) == C.align(p, q) == (0, 300, 0, 300, 285)
    none = C.Coded(pa.array([], pa.large_binary()))
    assert not len(none.size) and none.anchors(0, 0, 0, 0) == []


def test_alignment_of_edited_copies():
    rng = random.Random(5)
    p = prose(rng, 300, 60)
    q = list(p)
    for i in range(10, 290, 20):
        q[i] = "other"
    del q[100:103]
    assert C.align(p, p) == (0, 300, 0, 300, 300)
    a0, a1, b0, b1, same = C.align(["x"] * 5 + p, q + ["y"] * 7)
    assert (a0, a1, b0, b1) == (5, 305, 0, 297) and same >= 270
    assert C.align(["a", "b"] * 100, ["a", "b"] * 90)[4] >= 170


def test_fenwick():
    rng = random.Random(1)
    t, plain = C.Fenwick(50), [float("-inf")] * 50
    for _ in range(300):
        i, v = rng.randrange(50), rng.random()
        t.put(i, (v, 0))
        plain[i] = max(plain[i], v)
        j = rng.randrange(51)
        assert t.top(j)[0] == max(plain[:j], default=float("-inf"))


def table(spark):
    rng = random.Random(2)
    passages = [prose(rng, n, 50000) for n in (55, 80, 200)]
    rows, planted = [], {}
    for i in range(80):
        w = prose(rng, rng.randrange(60, 300), 50000)
        if i % 2:
            p = passages[i % 3]
            q = list(p)
            for j in range(7, len(q), 25):          # every 25th word differs
                q[j] = f"edit{i}{j}"
            at = rng.randrange(len(w))
            w[at:at] = q if i % 5 else p
            planted[i] = (i % 3, at, at + len(p))
        rows.append((i, " ".join(w), "en", "s"))
    rows += [(100 + i, t, "en", "s") for i, t in enumerate(ODD)]
    rows += [(None, rows[1][1], "en", "s"), (200, rows[1][1], "en", "s"), (200, rows[1][1], "en", "s"),
             (201, " ".join(prose(rng, 30000, 10**6) + passages[2]), "en", "s"), (202, "same words again and again " * 60, "en", "s"),
             (203, "same words again and again " * 50, "en", "s")]
    return frame(spark, rows), rows, planted


def test_planted_passages_are_found_and_nothing_else(spark):
    docs, rows, planted = table(spark)
    got = C.repeated_passages(docs).collect()
    words = {i: spaced(t) for i, t, *_ in rows if i is not None}
    first = {}
    for i, (p, _, _) in planted.items():
        first.setdefault(p, i)
    hit = {}
    for r in got:
        assert r.other_doc_id < r.doc_id and r.end_word - r.first_word >= 50 and 0.7 <= r.identity <= 1
        assert r.end_word <= len(words[r.doc_id]) and r.other_end_word <= len(words[r.other_doc_id])
        hit.setdefault(r.doc_id, []).append((r.first_word, r.end_word))
    for i, (p, a, b) in planted.items():
        if i != first[p]:
            assert any(max(a, x) < min(b, y) and min(b, y) - max(a, x) >= 0.8 * (b - a) for x, y in hit[i]), i
    known = set(planted) | {200, 201, 203}
    assert set(hit) <= known and {200, 201, 203} <= set(hit)
    (whole,) = [r for r in got if r.doc_id == 200 and r.other_doc_id == 1]
    assert (whole.first_word, whole.end_word) == (0, len(words[200])) and whole.identity == 1


def test_empty_table(spark):
    docs, *_ = table(spark)
    assert C.repeated_passages(docs.limit(0)).count() == 0


def planted(rng, cases, vocabulary=10**6):
    """rows, and per case the (document, other) pairs that hold one passage."""
    rows, pairs = [], {}

    def add(words):
        rows.append((len(rows), " ".join(words), "en", "s"))
        return len(rows) - 1

    def hidden(part, n):
        w = prose(rng, n, vocabulary)
        at = rng.randrange(n)
        return w[:at] + part + w[at:]

    for name, n, every, times in cases:
        for c in range(times):
            p = prose(rng, n, vocabulary)
            if name == "phrases":           # earlier documents quote a phrase each
                for _ in range(9):
                    at, size = rng.randrange(n - 15), rng.randrange(9, 16)
                    add(hidden(p[at:at + size], 100))
            q = list(p)
            for j in range(rng.randrange(every), n, every):
                q[j] = f"e{c}x{j}"
            a = add(hidden(p, 120))
            pairs.setdefault((name, n, every), []).append((add(hidden(p if name == "phrases" else q, 120)), a))
    return rows, pairs


def test_recall_by_identity_and_among_phrases(spark):
    """The README's figures. An edit every 8 words is an identity of 0.875; below that recall falls."""
    cases = [("phrases", 60, 1000, 40)] + [("edits", n, e, 40) for n in (60, 100) for e in (25, 10, 8, 7, 6)]
    rows, pairs = planted(random.Random(7), cases)
    got = {(r.doc_id, r.other_doc_id) for r in C.repeated_passages(frame(spark, rows)).collect()}
    recall = {k: sum(x in got for x in v) / len(v) for k, v in pairs.items()}
    print(recall)
    assert all(r >= 0.9 for (_, _, every), r in recall.items() if every >= 8) and recall["phrases", 60, 1000] >= 0.95
    assert got == {x for v in pairs.values() for x in v if x in got}       # nothing else


def test_result_does_not_depend_on_the_partitions(spark):
    rng = random.Random(3)
    rows, _ = planted(rng, [("phrases", 60, 1000, 6), ("edits", 80, 9, 6)])
    rows += [(1000 + i, rows[3][1], "en", "s") for i in range(30)] + [(2000 + i, "a common line of text " * 30, "en", "s") for i in range(20)]
    docs = frame(spark, rows)
    one = sorted(map(tuple, C.repeated_passages(docs.coalesce(1)).collect()))
    many = sorted(map(tuple, C.repeated_passages(docs.repartition(9)).collect()))
    assert one == many and len(one) > 40


def overlapping(rng, copies, size=60, part=30):
    """Earlier documents hold parts of a passage, as many of each as ``copies``; two later ones hold all of it."""
    p = prose(rng, size, 10**6)
    texts = [prose(rng, 80, 10**6) + p[at:at + part] + prose(rng, 80, 10**6)
             for at in range(0, size - part + 1, part // 2) for _ in range(copies)]
    texts += [prose(rng, 90, 10**6) + p + prose(rng, 90, 10**6) for _ in range(2)]
    return texts


@pytest.mark.parametrize("copies", [1, 3, C.FEW + 8])
def test_links_whose_seeds_all_occur_in_earlier_documents(spark, copies):
    rng = random.Random(copies)
    rows, pairs = [], set()
    for _ in range(6):
        texts = overlapping(rng, copies)
        rows += [(len(rows) + i, " ".join(t), "en", "s") for i, t in enumerate(texts)]
        pairs.add((len(rows) - 1, len(rows) - 2))
    got = {(r.doc_id, r.other_doc_id): r for r in C.repeated_passages(frame(spark, rows)).collect()}
    assert set(got) == pairs
    assert all(r.end_word - r.first_word >= 60 and r.identity > 0.95 for r in got.values())


def test_a_copy_leads_to_the_first_of_its_text(spark):
    """Also where its parts stand in earlier documents, however often the text occurs."""
    rng = random.Random(11)
    p = prose(rng, 60, 10**6)
    texts = [prose(rng, 50, 10**6) + p[at:at + 30] for at in (0, 15, 30)] + [p] * (C.FEW + 8) + [prose(rng, 50, 10**6) + p]
    rows = [(i, " ".join(t), "en", "s") for i, t in enumerate(texts)]
    got = {(r.doc_id, r.first_word, r.end_word, r.other_doc_id) for r in C.repeated_passages(frame(spark, rows)).collect()}
    copies = range(4, 3 + C.FEW + 8)
    assert {(i, 0, 60, 3) for i in copies} <= got
    assert (len(rows) - 1, 50, 110, 3) in got


def test_few_texts_are_all_linked_and_seeds_of_many_are_given_out():
    import pyarrow as pa

    class Rows:             # runs the two steps of linked as Spark would, in one task
        sparkSession = type("S", (), {"conf": type("C", (), {"get": staticmethod(lambda k: "1")})})

        def __init__(self, batches):
            self.batches = batches

        def mapInArrow(self, step, schema):
            return Rows([b for b in step(iter(self.batches)) if b.num_rows])

        def repartition(self, *_):
            return self

        def sortWithinPartitions(self, *keys):
            t = pa.Table.from_batches(self.batches).sort_by([(k, "ascending") for k in keys])
            return Rows(t.to_batches(max_chunksize=7))

    rng = random.Random(4)
    places = sorted({(rng.choice([1, 2, 3, 4, 5]), rng.randrange(1, 9 if h % 2 else 60), rng.randrange(20)) for h in range(400)})
    own = {d: rng.random() < 0.8 for _, d, _ in places}
    batch = pa.RecordBatch.from_arrays([pa.array(c) for c in (*zip(*places), [own[d] for _, d, _ in places])], ["h", "d", "x", "own"])
    out = C.linked(Rows([batch]), lambda b: [tuple(b[c].to_numpy(zero_copy_only=False) for c in b.schema.names)])
    got = {r for b in out.batches for r in zip(*(c.to_pylist() for c in b.columns))}
    want = set()
    for h in range(1, 6):
        of = [(d, x) for s, d, x in places if s == h]
        first = {d: min(x for e, x in of if e == d) for d, _ in of if own[d]}
        want |= {(*p, *of[0]) for p in of if p[0] != of[0][0]}
        if len(first) <= C.FEW:
            want |= {(d, x, e, y) for d, x in first.items() for e, y in first.items() if e < d}
        else:
            want |= {(d, x, d, h) for d, x in first.items()}
    assert got == want
