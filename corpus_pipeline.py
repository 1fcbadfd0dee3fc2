"""Corpus preparation: quality rules, near-dedup, decontamination, PII, tokens.

Every stage reads what the one before it wrote.  All but the last return the
columns of ``documents``; the last has a row per document that is left, with
its token ids in place of the text.  Where stages are called one by one, a
stage's result has to be written before the next stage is called for the same
folder: that call deletes the tables the result was read from.  :func:`run` does
this itself, and runs don't disturb each other.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dockmill.llm.bpe import encode_frame
from dockmill.llm.decontamination import decontaminate
from dockmill.llm.neardup import near_duplicates
from dockmill.llm.pii import mask, sanitise
from dockmill.llm.quality import judge
from dockmill.plans.shared import delete, new_path, spread, tables_made

_left: dict[str, set[str]] = {}  # by folder of tables: what its last stage has left in the shared folder


def _stage(f):
    """First delete what the stage before, over the same folder, has left."""

    @functools.wraps(f)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        for path in _left.pop(sf_dir, ()):
            delete(spark, path)
        with tables_made() as made:
            out = f(spark, docs, sf_dir)
        _left[sf_dir] = made
        return out

    return run


@_stage
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return judge(spread(docs), F.col("text")).where("kept").select(*docs.columns)


@_stage
def dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of near-duplicates (five-word shingles, similarity 0.8) the one with the smallest id stays.

    The operator sees ids and texts' hashes, so other columns are not carried
    through it; of rows that are equal in both, one stays.
    """
    keys = docs.withColumn("__hash", F.xxhash64("text"))
    found = near_duplicates(keys, "doc_id", "text", k=5, percent=80, carry=["doc_id", "__hash"])
    kept = found.where("first_of_component").select(F.col("doc_id").alias("__id"), F.col("__hash").alias("__h"))
    left = keys.join(kept, keys["doc_id"].eqNullSafe(kept["__id"]) & (keys["__hash"] == kept["__h"]), "left_semi")
    if found.groupBy("doc_id", "__hash").count().where("count > 1").limit(1).count():
        left = left.dropDuplicates(["doc_id", "__hash"])
    return left.select(*docs.columns)


@_stage
def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a window of a benchmark item go."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate(docs, "doc_id", "text", items, "item_id", "text").where("not contaminated").select(*docs.columns)


@_stage
def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data and what discloses it are masked in the texts; the count of characters follows."""
    found = sanitise(docs, "text", docs.columns)
    masked = found.withColumn("text", F.when(F.col("text").isNotNull(), mask(F.col("text"), F.col("spans"))))
    if "n_chars" in docs.columns:
        masked = masked.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return masked.select(*docs.columns)


@_stage
def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of the texts."""
    import public_tokenizers

    return encode_frame(docs, "text", public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [("quality", quality), ("dedup", dedup), ("decontamination", decontamination), ("pii", pii), ("tokens", tokens)]

# The sketches, the fitted rules and BPE have no SQL form; tests compare with brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``, each written as Parquet in the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = new_path(spark, f"stage-{name}")
        with tables_made() as made:
            stage.__wrapped__(spark, docs, sf_dir).write.parquet(path)
        for used in made:
            delete(spark, used)
        docs = spark.read.parquet(path)
    return docs
