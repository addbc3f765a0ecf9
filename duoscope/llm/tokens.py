"""Token counts with a public byte-level BPE vocabulary; huge texts by resynchronised chunks.

The vocabulary file is a parameter. Its merge table is loaded once per Python worker. A text
of at most ``chunk`` characters is encoded whole. A longer one is cut into chunks that overlap
by ``overlap`` characters, each encoded by itself with the offset of every token. Two
neighbouring chunks are spliced at a token boundary that both have and that is *proven* stable:
the pattern that cuts text into pieces before merging never crosses from a letter, digit or
other visible character to a character of another class (an apostrophe excepted), so such a
place is a boundary of the whole text, whatever lies to its left, unless a special token's
string covers it. Left of it the first chunk's tokens stand, right of it the second's. If an
overlap holds no such place, it is widened, in the end to the whole text.
"""

from __future__ import annotations

import json
import unicodedata
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from duoscope.llm.common import prepare, pick

CHUNK, OVERLAP = 1 << 16, 1 << 10
#: Fixed value: the split pattern of this family of vocabularies.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def _byte_letters() -> dict[str, int]:
    """The vocabulary writes bytes as printable characters; the others follow from U+0100."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Encoder:
    """Ids and offsets of one vocabulary file (``.json``: byte-level BPE)."""

    def __init__(self, path: str):
        import tiktoken

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre = spec["pre_tokenizer"]
        if spec["model"]["type"] != "BPE" or pre["type"] != "ByteLevel" or pre.get("add_prefix_space") \
                or spec.get("normalizer"):
            raise ValueError(f"{path}: not a plain byte-level BPE vocabulary")
        letters = _byte_letters()
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        ranks = {bytes(letters[c] for c in token): i for token, i in spec["model"]["vocab"].items()
                 if token not in self.special}
        self.size = {i: len(b) for b, i in ranks.items()} | {i: len(s.encode()) for s, i in self.special.items()}
        self.bpe = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks,
                                     special_tokens=self.special)

    def encode(self, text: str) -> list[int]:
        return self.bpe.encode(text, allowed_special="all")

    def long(self, text: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> list[int]:
        """Ids of the whole text, encoded in overlapping chunks."""
        out: list[int] = []
        start = lead = 0        # the chunk's first character; tokens of it that are already out
        size = chunk
        while start + size < len(text):
            stop, wide, found = start + size, min(overlap, size // 2), None
            ids = self.encode(text[start:stop])
            while wide < size and not found:
                found = self._splice(text, ids, lead, stop - wide, stop)
                wide *= 2       # where alignment fails, the overlap is widened
            if not found:
                size *= 2       # no stable place in the chunk: take a longer one
                continue
            n, skip, begin = found
            out += ids[lead:n]
            start, lead, size = begin, skip, chunk
        return out + self.encode(text[start:])[lead:]

    def _splice(self, text: str, ids: list[int], lead: int, low: int, stop: int):
        """(tokens of this chunk that stand, tokens of the next to skip, where the next begins)."""
        after = self.encode(text[low:stop])
        # where tokens end, in bytes before the chunk's end
        mine = np.cumsum([self.size[i] for i in ids][::-1])[::-1] - [self.size[i] for i in ids]
        theirs = np.cumsum([self.size[i] for i in after][::-1])[::-1] - [self.size[i] for i in after]
        common = np.intersect1d(mine, theirs)
        back = 0
        for p in range(stop - 1, low, -1):
            back += len(text[p].encode())
            if self.stable(text, p) and back in common:
                n = int(np.flatnonzero(mine == back)[0]) + 1
                if n > lead:
                    return n, int(np.flatnonzero(theirs == back)[0]) + 1, low
        return None

    def stable(self, text: str, p: int) -> bool:
        """Whether text[:p] and text[p:] are cut into pieces apart from each other."""
        a, b = _kind(text[p - 1]), _kind(text[p])
        if a == "S" or a == b or text[p - 1] == "'":
            return False
        return all(text.find(s, max(0, p - len(s) + 1), p + len(s) - 1) < 0 for s in self.special)


@lru_cache(1 << 16)
def _kind(c: str) -> str:
    if c.isspace() and c not in "\x1c\x1d\x1e\x1f":
        return "S"
    kind = unicodedata.category(c)[0]
    return kind if kind in "LN" else "O"


@lru_cache(4)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def token_counts(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
                 chunk: int = CHUNK, overlap: int = OVERLAP, with_ids: bool = False) -> DataFrame:
    """One row per row: id, n_bytes (UTF-8), n_tokens, and with ``with_ids`` the ids themselves.

    No begin, end or added special tokens; the string of a special token inside a text becomes
    that token. Null and empty texts have 0 of both. Repeated rows are counted each; other
    columns are not read. ``path`` must be readable on every executor.
    """
    prepare(docs.sparkSession)
    df = pick(docs, id=id_col, text=text_col)
    schema = T.StructType([df.schema["id"], T.StructField("n_bytes", T.LongType()),
                           T.StructField("n_tokens", T.LongType())])
    if with_ids:
        schema = schema.add("token_ids", T.ArrayType(T.IntegerType()))

    def run(batches):
        enc = encoder(path)
        for batch in batches:
            size, n, ids = [], [], []
            for value in batch["text"]:
                text = value.as_py() or ""
                got = enc.encode(text) if len(text) <= chunk else enc.long(text, chunk, overlap)
                size.append(len(text.encode()))
                n.append(len(got))
                if with_ids:
                    ids.append(got)
            out = {"id": batch["id"], "n_bytes": pa.array(size, pa.int64()), "n_tokens": pa.array(n, pa.int64())}
            if with_ids:
                out["token_ids"] = pa.array(ids, pa.list_(pa.int32()))
            yield pa.RecordBatch.from_pydict(out)

    return df.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def over_limit(counts: DataFrame, limit: int = 1024) -> DataFrame:
    return counts.withColumn("over_limit", F.col("n_tokens") > limit)
