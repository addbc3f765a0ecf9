"""Language identification of mixed texts: expectation-maximisation over word likelihoods.

A bounded sample of labelled texts gives each language's character trigram counts (hashed to
``BUCKETS``, smoothed with the counts of all languages). In a text every word has a likelihood
under each language, the product of its trigrams' (tempered, since neighbouring trigrams
overlap). The text is a mixture: EM estimates the share of each language. The set of languages
starts as the best single one and grows by the one with the steepest likelihood while the
penalised likelihood (one ``log n`` per language, as in the Bayesian information criterion)
improves. Because the likelihood is concave in the shares, ``n log max D`` bounds what any further
language can add (D: mean ratio of likelihoods); texts under the bound need no EM.

Prediction reads the whole text, in bounded Arrow batches, without a shuffle; of a very long text only its
words' scores are held. Languages of equal likelihood or share rank by name.
"""

from __future__ import annotations

import sys
import unicodedata
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, functions as F, types as T

from duoscope.llm.common import prepare, pick

BUCKETS = 1 << 17
TRAIN_DOCS = 2000       # labelled texts per language, about
#: Languages that have all buckets; with more, buckets are folded, so that the model stays as large.
FULL_LANGUAGES = 64
TEMPER = 0.5
UNDETERMINED = "und"
SPACE = 32
_SLICE = 1 << 19        # characters handled at once


@lru_cache(1)
def _letters() -> np.ndarray:
    """Code point -> lower-case letter or mark; everything else -> space. Bit 31: a letter."""
    out = np.full(sys.maxunicode + 1, SPACE, np.uint32)
    for i in range(sys.maxunicode + 1):
        c = chr(i)
        if c.isalpha():
            out[i] = ord(c.lower()[0]) | 0x80000000
        elif unicodedata.category(c)[0] == "M":
            out[i] = i
    return out


def _words(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(trigram buckets, first trigram of each word, first word of each text and the end)."""
    codes = np.frombuffer(" ".join(texts).encode("utf-32-le"), np.uint32)
    sizes = np.array([len(t) for t in texts])
    begin = np.concatenate(([0], np.cumsum(sizes + 1)))[:len(texts)]
    code = _letters()[codes]
    inside = code != SPACE
    has_letter = code >= 0x80000000
    code = code & np.uint32(0x7FFFFFFF)
    # keep each word's letters and one space after it; a word without a letter is none
    start = np.flatnonzero(inside & ~np.concatenate(([False], inside[:-1])))
    if not len(start):
        return np.zeros(0, np.int64), start, np.zeros(len(texts) + 1, np.int64)
    stop = np.flatnonzero(inside & ~np.concatenate((inside[1:], [False]))) + 1
    some = np.add.reduceat(has_letter, start) > 0
    start, stop = start[some], stop[some]
    of = np.concatenate((np.searchsorted(start, begin), [len(start)]))
    size = stop - start         # a word of n letters has n trigrams: " ab", "abc", ..., "yz "
    first = np.concatenate(([0], np.cumsum(size)))[:-1]
    at = np.arange(size.sum()) - np.repeat(first, size) + np.repeat(start, size)
    padded = np.concatenate(([SPACE], code, [SPACE])).astype(np.uint64)
    h = (padded[at] * np.uint64(0x9E3779B97F4A7C15) + padded[at + 1]) * np.uint64(0xBF58476D1CE4E5B9)
    h = ((h ^ (h >> np.uint64(29))) + padded[at + 2]) * np.uint64(0x94D049BB133111EB)
    return (h >> np.uint64(47)).astype(np.int64), first, of


@dataclass
class Model:
    languages: list[str]
    logp: np.ndarray        # [BUCKETS >> shift, languages], tempered log probabilities
    shift: int = 0

    def word_scores(self, grams: np.ndarray, first: np.ndarray) -> np.ndarray:
        return np.add.reduceat(self.logp[grams >> self.shift], first, axis=0)


def folded(n_languages: int) -> int:
    """Bits that the buckets of so many languages lose (512 buckets are always left)."""
    shift = 0
    while n_languages > FULL_LANGUAGES << shift and BUCKETS >> shift > 512:
        shift += 1
    return shift


def model_of(counts: dict[str, np.ndarray], shift: int = 0) -> Model:
    """``counts``: trigrams of each language by bucket (``BUCKETS >> shift`` of them)."""
    languages = sorted(counts)
    c = np.array([counts[x] for x in languages], np.float64).reshape(len(languages), BUCKETS >> shift)
    base = (c.sum(0) + 0.1) / (c.sum() + 0.1 * c.shape[1])
    prior = 500.0
    p = (c + prior * base) / (c.sum(1, keepdims=True) + prior)
    return Model(languages, (TEMPER * np.log(p.T)).astype(np.float32).copy(), shift)


def mixture(scores: np.ndarray) -> tuple[np.ndarray, float]:
    """Shares of the languages in one text and the posterior of its first language.

    ``scores``: log likelihood of each word under each language.
    """
    n, k = scores.shape
    total = scores.sum(0, dtype=np.float64)
    best = int(total.argmax())
    posterior = 1.0 / np.exp(np.minimum(total - total[best], 0.0)).sum()
    share = np.zeros(k)
    share[best] = 1.0
    top = scores.max(1, keepdims=True)
    like = np.exp((scores - top).astype(np.float64))
    like = np.maximum(like, 1e-30)
    chosen, value = [best], np.log(like[:, best]).sum()
    penalty = np.log(max(n, 2))
    while len(chosen) < k:
        mean = (like / (like @ share)[:, None]).mean(0)
        mean[chosen] = 0.0
        new = int(mean.argmax())
        if n * np.log(max(mean[new], 1e-30)) <= penalty:
            break                       # no further language can pay for itself
        trial = chosen + [new]
        sub, part = like[:, trial], np.append(share[chosen] * 0.9, 0.1)
        old = -np.inf
        for _ in range(100):
            mixed = sub @ part
            part = part * (sub / mixed[:, None]).mean(0)
            now = np.log(mixed).sum()
            if now - old < 1e-3:
                break
            old = now
        if now - value <= penalty:
            break
        chosen, value = trial, now
        share = np.zeros(k)
        share[trial] = part
    return share, float(posterior)


def _slices(text: str):
    """A text in pieces of about ``_SLICE`` characters, cut where no word is."""
    at = 0
    while len(text) - at > _SLICE:
        stop = at + _SLICE
        while stop < len(text) and _letters()[ord(text[stop])] != SPACE:
            stop += 1
        yield text[at:stop]
        at = stop
    yield text[at:]


def predict(model: Model, texts: list[str | None]):
    """Per text: (language, score, languages of the mixture, their shares)."""
    i = 0
    while i < len(texts):
        j, size = i, 0
        while j < len(texts) and (j == i or size + len(texts[j] or "") <= _SLICE):
            size += len(texts[j] or "")
            j += 1
        if j == i + 1 and size > _SLICE:        # one long text: of its pieces only the words' scores are kept
            cut = (_words([piece]) for piece in _slices(texts[i]))
            found = [model.word_scores(grams, first) for grams, first, _ in cut if len(first) and model.languages]
            scores = np.concatenate(found) if found else None
            of = [0, len(scores) if found else 0]
        else:
            grams, first, of = _words([t or "" for t in texts[i:j]])
            scores = model.word_scores(grams, first) if len(first) and model.languages else None
        for d in range(j - i):
            a, b = of[d], of[d + 1]
            if a == b or scores is None:
                yield UNDETERMINED, 0.0, [], []
                continue
            share, posterior = mixture(scores[a:b])
            order = sorted(np.flatnonzero(share > 0), key=lambda x: (-share[x], model.languages[x]))
            names = [model.languages[x] for x in order]
            yield names[0], float(min(1.0, share[order[0]] * posterior)), names, [float(share[x]) for x in order]
        i = j


def held_out(id_col) -> F.Column:
    """crc32 of the id as text, mod 3, is 1 (false for a null id)."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          train_docs: int = TRAIN_DOCS) -> Model:
    """Counts from about ``train_docs`` texts of each language, none of them held out.

    The sample is chosen by a hash of the id, so reruns agree. The model, at most about
    FULL_LANGUAGES x BUCKETS numbers for any number of languages up to 16,384, is held by the driver
    and broadcast; more labels than that are learned too, with 512 buckets each.
    """
    spark = docs.sparkSession
    prepare(spark)
    df = pick(docs, id=id_col, text=text_col, lang=lang_col)
    usable = df.where(F.col("lang").isNotNull() & F.col("id").isNotNull() & F.col("text").isNotNull()
                      & ~held_out(F.col("id")))
    # one row per label
    sizes = [(r.lang, r["n"]) for r in usable.groupBy("lang").agg(F.count("*").alias("n")).collect()]
    shift = folded(len(sizes))
    buckets = BUCKETS >> shift
    if not sizes:
        return Model([], np.zeros((buckets, 0), np.float32), shift)
    share = spark.createDataFrame([(lang, int((1 << 30) * min(1.0, train_docs / n))) for lang, n in sizes],
                                  "label string, upto long")
    part = F.pmod(F.xxhash64(F.lit("train"), "id"), F.lit(1 << 30))
    chosen = usable.join(F.broadcast(share), (F.col("lang") == F.col("label")) & (part <= F.col("upto")), "left_semi")

    def count(batches):
        seen: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, text in zip(batch["lang"].to_pylist(), batch["text"].to_pylist()):
                for at in range(0, len(text), _SLICE):
                    grams, _, _ = _words([text[at:at + _SLICE]])
                    if lang not in seen:
                        seen[lang] = np.zeros(buckets, np.int64)
                    seen[lang] += np.bincount(grams >> shift, minlength=buckets)
        for lang, c in seen.items():
            at = np.flatnonzero(c)
            yield pa.RecordBatch.from_pydict({
                "lang": pa.array([lang] * len(at), pa.string()), "bucket": pa.array(at, pa.int32()),
                "n": pa.array(c[at], pa.int64())})

    rows = (chosen.select("lang", "text")
            .mapInArrow(count, "lang string, bucket int, n bigint")
            .groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow())
    order = np.argsort(np.asarray(rows["lang"].combine_chunks().to_pylist(), object), kind="stable")
    names = np.asarray(rows["lang"].combine_chunks().to_pylist(), object)[order]
    at, n = rows["bucket"].to_numpy()[order], rows["n"].to_numpy()[order]
    counts = {}
    for lang in sorted(set(names.tolist())):
        i, j = np.searchsorted(names, lang, "left"), np.searchsorted(names, lang, "right")
        counts[lang] = np.zeros(buckets, np.int64)
        counts[lang][at[i:j]] = n[i:j]
    return model_of(counts, shift)


def languages(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row: id, lang_pred, score, languages, shares.

    ``und`` with score 0 where the text is null or has no letter, or nothing was learned. Every
    row is judged by its text alone; repeated rows get equal results; other columns are not read.
    """
    prepare(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    df = pick(docs, id=id_col, text=text_col)

    def run(batches):
        for batch in batches:
            rows = list(predict(shared.value, batch["text"].to_pylist()))
            yield pa.RecordBatch.from_pydict({
                "id": batch["id"], "lang_pred": pa.array([r[0] for r in rows], pa.string()),
                "score": pa.array([r[1] for r in rows], pa.float64()),
                "languages": pa.array([r[2] for r in rows], pa.list_(pa.string())),
                "shares": pa.array([r[3] for r in rows], pa.list_(pa.float64()))})

    schema = T.StructType([df.schema["id"], T.StructField("lang_pred", T.StringType()),
                           T.StructField("score", T.DoubleType()),
                           T.StructField("languages", T.ArrayType(T.StringType())),
                           T.StructField("shares", T.ArrayType(T.DoubleType()))])
    return df.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def keep_identified(docs: DataFrame, model: Model, text_col: str = "text",
                    min_score: float = 0.5) -> DataFrame:
    """The rows, with all their columns, whose language is determined with at least ``min_score``."""
    prepare(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            good = [r[0] != UNDETERMINED and r[1] >= min_score
                    for r in predict(shared.value, batch[text_col].to_pylist())]
            yield batch.filter(pa.array(good, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
