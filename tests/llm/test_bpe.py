import base64

import numpy as np
import pytest
import regex
from hypothesis import given, settings, strategies as st

from duoscope.llm import bpe
from duoscope.llm.queries import tokenizer_path
from duoscope.llm.tokens import PATTERN
from tests.llm.util import ODD, frame

PATH = tokenizer_path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def ranks():
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}


def brute(ranks, text):
    """Each match of the pattern: join the neighbours of least rank, leftmost first, while there are any."""
    out = []
    for match in regex.findall(PATTERN, text):
        parts = [bytes([b]) for b in match.encode()]
        while True:
            at = min(((ranks[x + y], i) for i, (x, y) in enumerate(zip(parts, parts[1:])) if x + y in ranks), default=None)
            if at is None:
                break
            i = at[1]
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
        out += [ranks[p] for p in parts]
    return out


@settings(max_examples=150, deadline=None)
@given(st.one_of(st.text(max_size=120), st.text("ab' r1²\n\t.<|é  中。̀", max_size=200)),
       st.integers(1, 60))
def test_parts_give_the_ids_of_the_whole(ranks, text, chunk):
    text = text.encode("utf-8", "ignore").decode()
    assert "".join(bpe.parts(text, chunk)) == text
    codec = bpe.codec(PATH)
    ids = [i for part in bpe.parts(text, chunk) for i in codec.encode(part).tolist()]
    assert ids == codec.encode(text).tolist() == brute(ranks, text)
    assert codec.decode(np.array(ids, np.int32)) == text.encode()


@pytest.mark.parametrize("text", ["a" * 3_000_000, " " * 1_500_000 + "x", "x" + "\n" * 1_200_000, "'" * 400_000,
                                  ("word " * 9 + "\n") * 40_000, "日本語。" * 100_000, " " * 1025 + "\t\t!"])
def test_very_long_texts_are_exact(text):
    codec = bpe.codec(PATH)
    ids = codec.encode(text)
    assert codec.decode(ids) == text.encode()
    if " " * 5000 not in text and "\n" * 5000 not in text:   # the library alone overflows there
        assert ids.tolist() == codec.bpe.encode_ordinary(text)
    else:   # the run up to its last character is one match; at the end of a text, the whole run
        run = text.rstrip("x")[:-1] if text.endswith("x") else text.lstrip("x")
        rest = text[len(run):] if text.endswith("x") else "x"
        one = codec.match.encode_ordinary(run)
        two = codec.bpe.encode_ordinary(rest)
        assert ids.tolist() == (one + two if text.endswith("x") else two + one)


def test_frame_round_trip(spark, ranks):
    texts = [*ODD, "same", "same", "It's 'round 1²3\x85  x", "p" * 200_000, " " * 70_000 + "y"]
    docs = frame(spark, [(i, t, "en", "s") for i, t in enumerate(texts)] + [(None, "no id", None, None)])
    out = bpe.decode(bpe.encode(docs, PATH), PATH)
    assert out.columns == ["doc_id", "token_ids", "decoded"]
    got = {r.doc_id: r for r in out.collect()}
    assert len(got) == len(texts) + 1 and out.count() == len(texts) + 1
    for i, t in enumerate(texts):
        assert bytes(got[i].decoded) == (t or "").encode()
        if len(t or "") < 10_000:
            assert got[i].token_ids == brute(ranks, t or "")


def test_bytes_that_are_not_utf8(spark):
    docs = spark.sql("SELECT 1L AS doc_id, CAST(X'61FF62' AS string) AS text")
    row = bpe.decode(bpe.encode(docs, PATH), PATH).collect()[0]
    assert bytes(row.decoded) == "a�b".encode()


def test_decode_of_odd_ids(spark):
    df = spark.createDataFrame([(1, [64, 65], "k"), (2, [], "k"), (3, None, "k"), (4, [99_999_999], "k"),
                                (5, [64, None], "k"), (6, [-1], "k")], "doc_id long, token_ids array<int>, decoded string")
    got = {r.doc_id: None if r.decoded is None else bytes(r.decoded) for r in bpe.decode(df, PATH).collect()}
    assert got == {1: bpe.codec(PATH).bpe.decode_bytes([64, 65]), 2: b"", 3: b"", 4: None, 5: None, 6: None}


def test_empty_table(spark):
    assert bpe.decode(bpe.encode(frame(spark, []), PATH), PATH).count() == 0
