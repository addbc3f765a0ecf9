import random
import zlib

import numpy as np

from duoscope.llm import langmix as L
from tests.llm.util import ODD, frame

WORDS = {"en": "the of and tion ing that with which from have they this would there".split(),
         "fr": "le la les des une pour dans avec être qui que nous vous était".split(),
         "de": "der die das und nicht eine mit für auf ist schon wird über ähnlich".split()}


def text(rng, lang, n):
    return " ".join(rng.choice(WORDS[lang]) for _ in range(n))


def table(spark):
    rng = random.Random(3)
    rows = []
    for i in range(240):
        lang = rng.choice(list(WORDS))
        rows.append((i, text(rng, lang, rng.randrange(5, 60)), lang, f"s{i % 3}"))
    rows += [(1000 + i, t, None, None) for i, t in enumerate(ODD)] + [(None, "the and of", "en", "s"), (5, rows[5][1], rows[5][2], "s0")]
    return frame(spark, rows), rows


def test_held_out_accuracy_and_defined_cases(spark):
    docs, rows = table(spark)
    model = L.train(docs)
    assert model.languages == ["de", "en", "fr"]
    got = L.languages(docs, model).collect()
    assert len(got) == len(rows)
    truth = {i: lang for i, _, lang, _ in rows if i is not None}
    out = [r for r in got if r.doc_id is not None and r.doc_id < 240 and zlib.crc32(str(r.doc_id).encode()) % 3 == 1]
    assert len(out) > 50 and all(r.lang_pred == truth[r.doc_id] for r in out)
    und = {r.doc_id for r in got if r.lang_pred == "und"}
    assert und == {1000 + i for i, t in enumerate(ODD) if not any(c.isalpha() for c in t or "")}
    assert all(0 <= r.score <= 1 and (r.score == 0) == (r.lang_pred == "und") for r in got)


def test_held_out_flag(spark):
    docs, rows = table(spark)
    got = docs.select("doc_id", L.held_out(docs["doc_id"]).alias("h")).collect()
    assert all(r.h == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)


def test_mixture_shares(spark):
    docs, _ = table(spark)
    model = L.train(docs)
    rng = random.Random(9)
    mixed = text(rng, "en", 70) + " " + text(rng, "de", 30)
    (lang, score, names, shares), = L.predict(model, [mixed])
    assert lang == "en" and names == ["en", "de"]
    assert abs(shares[0] - 0.7) < 0.08 and abs(sum(shares) - 1) < 1e-6 and abs(score - shares[0]) < 1e-6
    assert [len(r[2]) for r in L.predict(model, [text(rng, "fr", 200)])] == [1]


def test_shares_maximise_the_likelihood():
    """EM against a grid of shares of two languages."""
    import numpy as np

    rng = np.random.default_rng(4)
    scores = np.where(rng.random((300, 1)) < 0.65, [[0.0, -3.0]], [[-3.0, 0.0]]) + rng.normal(0, 0.3, (300, 2))
    share, _ = L.mixture(scores)
    grid = np.linspace(0.001, 0.999, 999)
    like = [np.log(np.exp(scores) @ [p, 1 - p]).sum() for p in grid]
    assert abs(share[0] - grid[int(np.argmax(like))]) < 0.01


def test_labels_of_held_out_rows_do_not_matter(spark):
    docs, rows = table(spark)
    other = frame(spark, [(i, t, "xx" if i is not None and zlib.crc32(str(i).encode()) % 3 == 1 else lang, s) for i, t, lang, s in rows])
    a = L.languages(docs, L.train(docs)).collect()
    b = L.languages(docs, L.train(other)).collect()
    assert sorted(map(str, a)) == sorted(map(str, b))


def test_empty_and_unlabelled_tables(spark):
    docs, _ = table(spark)
    model = L.train(docs.limit(0))
    assert {r.lang_pred for r in L.languages(docs, model).collect()} == {"und"}
    assert L.languages(docs.limit(0), model).count() == 0
    kept = L.keep_identified(docs, L.train(docs))
    assert kept.columns == docs.columns and kept.where("text IS NULL").count() == 0


def test_many_labels_fold_the_buckets(spark):
    """Two hundred labels: a smaller table each, and still the right one."""
    rng = random.Random(4)
    alphabets = ["".join(rng.sample("abcdefghijklmnopqrstuvwxyz", 6)) for _ in range(200)]
    text = lambda a, n: " ".join("".join(rng.choice(a) for _ in range(6)) for _ in range(n))
    rows = [(i, text(alphabets[i % 200], 60), f"l{i % 200:03}", "s") for i in range(1200)]
    docs = frame(spark, rows)
    model = L.train(docs)
    assert len(model.languages) == 200 and model.shift == 2 and model.logp.shape == (L.BUCKETS >> 2, 200)
    got = L.languages(docs, model).select("doc_id", "lang_pred").collect()
    assert sum(r.lang_pred == f"l{r.doc_id % 200:03}" for r in got) >= 1190
    assert [L.folded(n) for n in (1, 64, 65, 128, 129, 10**6)] == [0, 0, 1, 1, 2, 8]


def test_a_very_long_text_is_scored_in_pieces(spark):
    rng = random.Random(1)
    rows = [(i, " ".join("".join(rng.choice(a) for _ in range(5)) for _ in range(80)), n, "s")
            for i, (a, n) in enumerate([("abcde", "x"), ("vwxyz", "y")] * 40)]
    model = L.train(frame(spark, rows))
    long = (rows[0][1] + " ") * 3000 + (rows[1][1] + "\n") * 1000 + "q" * (L._SLICE + 50)
    assert "".join(L._slices(long)) == long and len(long) > 2 * L._SLICE
    (one,) = L.predict(model, [long])
    pieces = [L._words([p]) for p in L._slices(long)]
    grams, first, _ = L._words([long])
    scores = model.word_scores(grams, first)
    assert (np.concatenate([model.word_scores(g, f) for g, f, _ in pieces]) == scores).all()
    assert one[0] == "x" and one[2] == ["x", "y"] and abs(one[3][0] - 0.75) < 0.05
    assert [r[0] for r in L.predict(model, ["1" * (2 * L._SLICE), "\n" * 10])] == ["und", "und"]
