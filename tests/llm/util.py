"""Small document tables with the awkward cases, and brute-force versions to compare with."""

import random
import re

from pyspark.sql import types as T

SPACED = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

#: documents plus columns whose names an operator might use itself
DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType()), T.StructField("size", T.IntegerType()),
    T.StructField("lines", T.StringType()), T.StructField("node", T.StringType()),
    T.StructField("id", T.StringType()), T.StructField("n", T.LongType())])


def frame(spark, rows):
    """rows of (doc_id, text, lang, source)."""
    full = [(i, t, lang, s, len(t) if t is not None else None, 7, "x", "y", "z", 1) for i, t, lang, s in rows]
    return spark.createDataFrame(full, DOCS)


def prose(rng: random.Random, n: int, vocabulary: int = 400) -> list[str]:
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


def spaced(text):
    return SPACED.findall((text or "").translate(LOWER))


def alnum(text):
    return ALNUM.findall((text or "").translate(LOWER))


ODD = [None, "", "   \n\t ", "one", "one two", "!!! ### ...", "é", "A b c", "x" * 3000,
       "\n\n\n", "日本語の文章", "a\x1cb\x0bc"]
