import random

import duckdb
import pytest

from duoscope.functions.jaro import jaro_distance_value, jaro_similarity


def test_known_values():
    assert jaro_similarity("martha", "marhta") == pytest.approx(0.944444, abs=1e-6)  # plain Jaro, no prefix bonus
    assert jaro_similarity("abcdefgh", "bcadefgh", floor=True) == pytest.approx(0.958333, abs=1e-6)
    assert jaro_similarity("abcdefgh", "bcadefgh", floor=False) == pytest.approx(0.9375, abs=1e-6)
    assert jaro_similarity("", "") == 1.0
    assert jaro_similarity("abc", "") == 0.0
    assert jaro_similarity("abc", "xyz") == 0.0


def _random_pairs(n, seed=7):
    rnd = random.Random(seed)
    alpha = "abcde fgh"
    out = []
    for _ in range(n):
        a = "".join(rnd.choice(alpha) for _ in range(rnd.randint(1, 14)))
        b = list(a)
        for _ in range(rnd.randint(0, 4)):
            op = rnd.random()
            if op < 0.3 and b:
                b.pop(rnd.randrange(len(b)))
            elif op < 0.6:
                b.insert(rnd.randrange(len(b) + 1), rnd.choice(alpha))
            elif len(b) > 1:
                i = rnd.randrange(len(b) - 1)
                b[i], b[i + 1] = b[i + 1], b[i]
        out.append((a, "".join(b)))
    return out


def test_floor_variant_equals_duckdb():
    pairs = _random_pairs(2000)
    con = duckdb.connect()
    con.execute("CREATE TABLE p(a VARCHAR, b VARCHAR)")
    con.executemany("INSERT INTO p VALUES (?, ?)", pairs)
    for a, b, s in con.execute("SELECT a, b, jaro_similarity(a, b) FROM p").fetchall():
        assert jaro_similarity(a, b, floor=True) == pytest.approx(s, abs=1e-12)


def test_properties():
    for a, b in _random_pairs(1000, seed=3):
        s = jaro_similarity(a, b)
        assert 0.0 <= s <= 1.0
        assert s == pytest.approx(jaro_similarity(b, a), abs=1e-12)
        assert (jaro_distance_value(a, b) == 0.0) == (a == b)


def test_code_points_not_bytes():
    # 'été' vs 'ete': 1 of 3 code points matches -> (1/3 + 1/3 + 1) / 3
    assert jaro_similarity("été", "ete") == pytest.approx(5 / 9)


def test_cutoff_is_exact_below_the_threshold():
    for a, b in _random_pairs(3000, seed=9):
        for cut in (0.05, 0.12, 0.3):
            full = jaro_distance_value(a, b, floor=True)
            fast = jaro_distance_value(a, b, floor=True, cutoff=cut)
            if full < cut:
                assert fast == full
            else:
                assert fast >= cut


def _textbook_jaro(x, y, floor):
    """Direct transcription of the definition: scan the whole window for each character."""
    if x == y:
        return 1.0
    lx, ly = len(x), len(y)
    if not lx or not ly:
        return 0.0
    w = max(0, max(lx, ly) // 2 - 1)
    used = [False] * ly
    xm = []
    for i in range(lx):
        for j in range(max(0, i - w), min(ly, i + w + 1)):
            if not used[j] and x[i] == y[j]:
                used[j] = True
                xm.append(x[i])
                break
    if not xm:
        return 0.0
    ym = [y[j] for j in range(ly) if used[j]]
    k = sum(a != b for a, b in zip(xm, ym))
    t = k // 2 if floor else k / 2
    m = len(xm)
    return (m / lx + m / ly + (m - t) / m) / 3


from hypothesis import given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402

_text = st.text(alphabet="abcé d", max_size=24)


@settings(max_examples=400, deadline=None)
@given(_text, _text, st.booleans())
def test_kernel_equals_textbook_definition(x, y, floor):
    assert jaro_similarity(x, y, floor) == pytest.approx(_textbook_jaro(x, y, floor), abs=1e-12)
    cut = 0.12
    fast = jaro_distance_value(x, y, floor, cutoff=cut)
    full = jaro_distance_value(x, y, floor)
    assert fast == full if full < cut else fast >= cut


_long = st.text(alphabet="abcé d", min_size=55, max_size=75)


@settings(max_examples=120, deadline=None)
@given(st.lists(st.tuples(st.one_of(_text, _long, st.none()), st.one_of(_text, _long, st.none())), max_size=12), st.booleans())
def test_batch_kernel_equals_the_pair_helper(pairs, floor):
    from duoscope.functions.jaro import batch_distance
    got = batch_distance([x for x, _ in pairs], [y for _, y in pairs], floor)
    want = [jaro_distance_value(x, y, floor) for x, y in pairs]
    assert [None if g != g else g for g in got.tolist()] == want


def test_batch_kernel_beyond_ascii_and_at_the_word_size():
    from duoscope.functions.jaro import batch_distance
    xs = ["a" * 64, "ab" * 32, "😀été", "", "日本語", "x" * 64]
    ys = ["a" * 64, "ba" * 32, "ete😀", "", "日本", "x" * 63 + "y"]
    assert batch_distance(xs, ys).tolist() == [jaro_distance_value(x, y) for x, y in zip(xs, ys)]


def test_long_titles_stay_in_the_batch(monkeypatch):
    """Several words a title: equal to the pair helper, which is never called."""
    import random

    from duoscope.functions import jaro
    rng = random.Random(4)
    xs, ys = [], []
    for size in (64, 65, 127, 128, 129, 191, 256, 257, 700, 1024, 1025, 3000):
        for _ in range(5):
            x = "".join(rng.choice("abcdefg éß中😀") for _ in range(size + rng.randint(-2, 2)))
            y = list(x[rng.randrange(9):])
            for _ in range(size // 5):
                y[rng.randrange(len(y))] = rng.choice("abcxyz")
            if rng.random() < 0.4:
                rng.shuffle(y)
            xs += [x, x]
            ys += ["".join(y), ""]
    for floor in (False, True):
        want = [jaro.jaro_distance_value(x, y, floor) for x, y in zip(xs, ys)]
        with monkeypatch.context() as m:
            m.setattr(jaro, "jaro_similarity", lambda *a, **k: pytest.fail("per-pair helper"))
            assert jaro.batch_distance(xs, ys, floor).tolist() == want
            m.setattr(jaro, "_MASK_WORDS", 64)   # pairs then go in groups of one or a few
            assert jaro.batch_distance(xs[:40], ys[:40], floor).tolist() == want[:40]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(_text, _long), max_size=10), st.lists(st.one_of(_text, _long), max_size=10),
       st.sampled_from([0.05, 0.12, 0.3, 0.5, 0.9, 1.5]), st.booleans())
def test_a_cell_loses_no_pair(xs, ys, max_dist, floor):
    """Pruned by bits = all pairs compared one by one."""
    from duoscope.functions.jaro import close_in_cell
    a, b, d = close_in_cell(xs, ys, max_dist, floor)
    want = {(i, j): jaro_distance_value(x, y, floor) for i, x in enumerate(xs) for j, y in enumerate(ys)}
    assert {(i, j): v for i, j, v in zip(a.tolist(), b.tolist(), d.tolist())} == {
        k: v for k, v in want.items() if v < max_dist}


def test_a_cell_of_edited_titles(monkeypatch):
    import random

    from duoscope.functions import jaro
    rng = random.Random(8)
    xs = ["".join(rng.choice("abcdefghij klmnop") for _ in range(rng.randrange(3, 90))) for _ in range(150)]
    ys = []
    for x in xs + xs[:20]:
        y = list(x)
        for _ in range(rng.randrange(4)):
            y[rng.randrange(len(y))] = rng.choice("abcxyz😀")
        ys.append("".join(y))
    want = {(i, j) for i, x in enumerate(xs) for j, y in enumerate(ys) if jaro.jaro_distance_value(x, y) < 0.12}
    for pairs, words in ((1 << 22, 1 << 21), (100, 8)):
        monkeypatch.setattr(jaro, "_PAIRS", pairs)
        monkeypatch.setattr(jaro, "_MASK_WORDS", words)
        a, b, _ = jaro.close_in_cell(xs, ys, 0.12)
        assert set(zip(a.tolist(), b.tolist())) == want and len(a) == len(want) > 100
