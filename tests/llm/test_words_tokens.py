import random

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from duoscope.llm import tokens, words as W
from duoscope.llm.common import utf8
from duoscope.llm.queries import tokenizer_path
from tests.llm.util import ODD, alnum, frame, spaced

texts = st.lists(st.one_of(st.none(), st.text(max_size=60), st.text("aA zé09.\n\t ", max_size=80)), max_size=8)


@settings(max_examples=80, deadline=None)
@given(texts)
def test_words_equal_the_patterns(ts):
    ts = [t.encode("utf-8", "ignore").decode() if t is not None else None for t in ts]
    raw, off = utf8(pa.array(ts, pa.string()))
    for table, expected in ((W.SPACED, spaced), (W.ALNUM, alnum)):
        w = W.split_words(raw, off, table, lower=True)
        got = [[x.decode() for x in w.list_of(a, b)] for a, b in zip(w.of[:-1], w.of[1:])]
        assert got == [expected(t) for t in ts]
        ranges = [(a, b) for lo, hi in zip(w.of[:-1], w.of[1:]) for a in range(lo, hi + 1) for b in (a, hi)]
        assert w.joined(ranges) == [b" ".join(w.list_of(a, b)) for a, b in ranges]


def test_equal_words_have_equal_hashes_and_others_do_not():
    ws = ["a", "b", "ab", "ba", "x" * 47, "x" * 48, "x" * 49, "x" * 500, "x" * 501, "a"]
    raw, off = utf8(pa.array([" ".join(ws)]))
    h = W.split_words(raw, off, W.SPACED, lower=False).hash
    assert h[0] == h[-1] and len(set(h.tolist())) == len(ws) - 1


def test_a_hash_depends_on_the_word_alone():
    ws = [b"x" * n for n in range(1, W.LONG + 1)] + [b"abc", "é".encode()]
    raw, off = utf8(pa.array([b" ".join(ws)]))
    want = []
    for word in ws:
        h = len(word) + 1
        for byte in word:
            h = (h ^ byte) * int(W._MUL) % 2**64
            h ^= h >> 29
        want.append(h)
    assert W.split_words(raw, off, W.SPACED, lower=False).hash.tolist() == W.mix(np.array(want, np.uint64)).tolist()


def test_winnow_picks_a_minimum_of_every_window():
    rng = np.random.default_rng(1)
    h = rng.integers(0, 50, 300).astype(np.uint64)
    chosen = W.winnow(h, 6)
    for i in range(len(h) - 5):
        low = h[i:i + 6].min()
        assert all(chosen[i + j] for j in range(6) if h[i + j] == low)


@pytest.fixture(scope="module")
def enc():
    return tokens.Encoder(tokenizer_path())


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(tokenizer_path())


@settings(max_examples=60, deadline=None)
@given(st.one_of(st.text(max_size=200), st.text("ab' r1²\n\t.<|endofx> é", max_size=200)))
def test_ids_equal_the_library(enc, library, text):
    text = text.encode("utf-8", "ignore").decode()
    assert enc.encode(text) == library.encode(text, add_special_tokens=False).ids


@settings(max_examples=80, deadline=None)
@given(st.text("ab' r1²\n .<|é", max_size=160), st.integers(4, 40), st.integers(2, 12))
def test_spliced_chunks_equal_the_whole(enc, text, chunk, overlap):
    text = text + "<|endoftext|>" + text[::-1]
    assert enc.long(text, chunk, overlap) == enc.encode(text)


def test_alignment_that_fails_widens(enc):
    for text in ("a" * 700, " " * 500 + "b", "x" * 300 + "1" * 300, "日本" * 200, "'" * 200, "a " * 300):
        assert enc.long(text, 32, 4) == enc.encode(text)


def test_token_counts(spark, library):
    rng = random.Random(2)
    long = " ".join(f"wörd{rng.randrange(9999)}'s" for _ in range(6000))
    rows = [(i, t, "en", "s") for i, t in enumerate([*ODD, long, "a <|endoftext|> b", "a <|endoftext|> b"])] + [(None, "x", None, None)]
    docs = frame(spark, rows)
    got = tokens.over_limit(tokens.token_counts(docs, tokenizer_path(), chunk=4096, overlap=64), 1024).collect()
    want = sorted((i is not None, i or 0, len((t or "").encode()), n := len(library.encode(t or "", add_special_tokens=False).ids), n > 1024)
                  for i, t, _, _ in rows)
    assert sorted((r.doc_id is not None, r.doc_id or 0, r.n_bytes, r.n_tokens, r.over_limit) for r in got) == want
    assert tokens.token_counts(docs.limit(0), tokenizer_path()).count() == 0
