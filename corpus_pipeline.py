"""From documents to a mixed corpus: five stages, each on all that the one before kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the
columns of documents. ``run`` writes each stage's result as Parquet in the shared checkpoint
folder and reads it again, so a lost executor costs one stage's tasks and no lineage grows.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from duoscope.llm import decontaminate, langmix, linechunks, minhash, mixing
from duoscope.llm.common import cut, measured
from duoscope.session import ensure_checkpoint_dir


def identify_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects texts without a letter and texts none of whose languages clearly leads.

    Null, empty and letterless texts go; very long ones are read whole; rows are judged one by one, so ties,
    repeated rows and null ids change nothing; columns of any name stay as they are.
    """
    return langmix.keep_identified(docs, langmix.train(docs))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes repeated lines (two or more in a row) out of the texts; n_chars follows the text.

    No row goes: a text of which all repeats becomes empty. The first occurrence is that of the smallest
    doc_id (null last), then of the smallest text hash; rows equal in both are treated alike.
    """
    out = linechunks.dedup_lines(docs)
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else out


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each component (five-word shingles, similarity 0.8): that of the smallest
    doc_id, null last, then of the smallest text hash.

    Rows are judged by themselves, whatever ids repeat: of texts under one id each stays or goes with
    its own component, rows with null ids count like others, and of rows equal in id and text one
    stays (the smallest by all columns). Texts without words are linked with nothing and all stay.
    """
    # the row's own name: what orders documents, then what tells texts of one id apart
    row = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", F.xxhash64("text").alias("hash"))
    named = docs.select(row.alias("row"), "text")
    groups = minhash.near_duplicates(named, id_col="row", shingle=5, percent=80, hashes=160)
    narrow = cut(groups.where("n_shingles > 0").select(
        F.col("row.doc_id").alias("g_id"), F.col("row.hash").alias("g_hash"), (F.col("row") != F.col("component_id")).alias("goes")))
    told = narrow.groupBy("g_id", "g_hash").agg(F.max("goes").alias("goes"), F.count("*").alias("rows"))
    told = measured(told.where("goes OR rows > 1"))
    of = docs.withColumn("__hash", F.xxhash64("text")).join(
        told, F.col("doc_id").eqNullSafe(F.col("g_id")) & (F.col("__hash") == F.col("g_hash")), "left")
    once = of.where("goes IS NULL").select(*docs.columns)
    twins = of.where("NOT goes").groupBy("doc_id", "__hash").agg(F.min(F.struct(*docs.columns)).alias("one"))
    return once.unionByName(twins.select("one.*"))


def decontaminate_(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a ten-word window of a benchmark item.

    Null and empty texts and items hold none; shorter items count whole; rows are judged one by one.
    """
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, size, source_size, target, taken of every document that is left.

    Null and empty texts have size 0 and are never taken; a null source is a source; repeated rows are
    documents of their own.
    """
    return mixing.mix_sources(docs)


STAGES = [
    ("language", identify_languages),
    ("lines", dedup_lines),
    ("near_duplicates", drop_near_duplicates),
    ("benchmark", decontaminate_),
    ("mix", mix),
]

#: EM, MinHash and the pseudorandom mixture have no SQL form; tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; what they wrote goes once the result is checkpointed."""
    shared = ensure_checkpoint_dir(spark)
    if not shared:
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    folder = f"{shared}/corpus-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs.write.parquet(f"{folder}/{i}-{name}")
            docs = spark.read.parquet(f"{folder}/{i}-{name}")
    docs = cut(docs)
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    return docs
