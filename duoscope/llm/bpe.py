"""Byte-level BPE: texts to token ids by a local rank file, and ids back to bytes.

The tiktoken library encodes; its rank file is a parameter that every executor can read. The
library takes a text whole, so its memory follows the longest text, and its pattern engine
overflows its stack on a very long run of white space. Long texts are therefore cut first, with
a regular expression, at *safe boundaries*: places that no match of the pattern crosses whatever
stands around them. Those are

* after a letter, a number or another visible character where one of another class (or white
  space) follows, unless an apostrophe precedes (``'s`` is one match), and
* before the last of two or more white space characters where a visible one follows: the pattern
  gives the run up to there its own match.

The ids of the parts, one after the other, are the ids of the text. A run of white space longer
than ``RUN`` is one match by the same rule and is handed to the library as such. Characters on
which Unicode versions disagree are never cut at. A part holds ``chunk`` characters or a little
more; only a single match that is longer makes it longer.

Texts go through Arrow as bytes. Decoding concatenates the bytes of the ids; they need not be
UTF-8 (a token may end inside a character), so the result is binary.

Defined results: a null text counts as empty; an empty text has no ids and decodes to no bytes;
bytes that are not UTF-8 count as U+FFFD each, as in Python's ``errors="replace"``; very long
texts (also of one letter or of white space only) are exact; ties do not arise; repeated rows are
coded each; an empty table gives an empty table; other columns are not read. ``decode`` gives
no bytes for a null or empty list, and null for a list with a null or an id that the file lacks.
"""

from __future__ import annotations

import base64
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, types as T

from duoscope.llm.common import blocks, pick, prepare
from duoscope.llm.tokens import PATTERN

CHUNK, RUN = 1 << 15, 1 << 10
_SAFE = regex.compile(r"(?<=\p{L})(?!\p{L})|(?<=\p{N})(?!\p{N})|(?<=[^\s\p{L}\p{N}'])(?=[\s\p{L}\p{N}])"
                      r"|(?<=\s)(?=\s\S)")
_LONG_RUN = regex.compile(rf"\s{{{RUN},}}")


def _settled(c: str) -> bool:
    """Whether every Unicode version since 3.2 knows the character, in one class."""
    return c.isascii() or unicodedata.ucd_3_2_0.category(c)[0] == unicodedata.category(c)[0] != "C"


def parts(text: str, chunk: int = CHUNK) -> Iterator[str]:
    """The text in pieces of about ``chunk`` characters, cut at safe boundaries."""
    start = 0
    while len(text) - start > chunk:
        stop = len(text)
        for found in _SAFE.finditer(text, start + chunk):
            p = found.start()
            if p < stop and _settled(text[p - 1]) and _settled(text[p]):
                stop = p
                break
        yield text[start:stop]
        start = stop
    if start < len(text) or not text:
        yield text[start:]


class Codec:
    """Encoder and decoder of one rank file (lines of base64 token and rank)."""

    def __init__(self, path: str, pattern: str = PATTERN):
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
        self.bpe = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        #: Takes whatever it is given as one match.
        self.match = tiktoken.Encoding("match", pat_str="(?s:.+)", mergeable_ranks=ranks, special_tokens={})

    def _part(self, text: str) -> Iterator[list[int]]:
        start = 0
        for run in _LONG_RUN.finditer(text):
            # Before something visible the run's last character is not part of its match.
            stop = run.end() - (run.end() < len(text))
            yield self.bpe.encode_ordinary(text[start:run.start()])
            yield self.match.encode_ordinary(text[run.start():stop])
            start = stop
        yield self.bpe.encode_ordinary(text[start:])

    def encode(self, text: str, chunk: int = CHUNK) -> np.ndarray:
        if len(text) < min(chunk, RUN):
            return np.array(self.bpe.encode_ordinary(text), np.int32)
        return np.concatenate([np.array(ids, np.int32) for part in parts(text, chunk) for ids in self._part(part)])

    def decode(self, ids: np.ndarray) -> bytes | None:
        try:
            return self.bpe.decode_bytes(ids.tolist())
        except (KeyError, OverflowError):
            return None


@lru_cache(4)
def codec(path: str, pattern: str = PATTERN) -> Codec:
    return Codec(path, pattern)


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
           pattern: str = PATTERN, chunk: int = CHUNK) -> DataFrame:
    """One row per row: id and ``token_ids`` (array of int; empty for a null or empty text).

    ``pattern`` splits a text before merging; its matches must not cross safe boundaries.
    """
    prepare(docs.sparkSession)
    df = pick(docs, id=id_col, text=text_col)
    df = df.withColumn("text", df["text"].cast("binary"))
    schema = T.StructType([df.schema["id"], T.StructField("token_ids", T.ArrayType(T.IntegerType()))])

    def run(batches):
        enc = codec(path, pattern)
        for whole in batches:
            for i, j in blocks(whole["text"]):
                batch = whole.slice(i, j - i)
                ids = [enc.encode((v.as_py() or b"").decode("utf-8", "replace"), chunk) for v in batch["text"]]
                yield pa.RecordBatch.from_pydict({"id": batch["id"], "token_ids": _lists(ids)})

    return df.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def _lists(ids: list[np.ndarray]) -> pa.ListArray:
    ends = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.zeros(0, np.int32), *ids])))


def decode(tokens: DataFrame, path: str, ids_col: str = "token_ids", out_col: str = "decoded") -> DataFrame:
    """The frame's columns and the bytes of its lists of ids (a column named ``out_col`` is replaced)."""
    prepare(tokens.sparkSession)
    at = tokens.columns.index(ids_col)
    keep = [i for i, name in enumerate(tokens.columns) if name != out_col]
    schema = T.StructType([*(tokens.schema.fields[i] for i in keep), T.StructField(out_col, T.BinaryType())])

    def run(batches):
        enc = codec(path)
        for batch in batches:
            out = []
            for value in batch.column(at):
                ids = value.values if value.is_valid else pa.array([], pa.int32())
                out.append(None if ids.null_count else enc.decode(np.asarray(ids)))
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in keep), pa.array(out, pa.binary())],
                                             names=schema.names)

    return tokens.mapInArrow(run, schema)
