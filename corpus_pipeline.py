"""From raw documents to token ids: quality filter, exact and near dedup, source mixing, byte-level BPE.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes
it to the shared folder and reads it back as the next stage's ``docs``. A
stage works on all rows it is given. All but the last return the columns of
``docs``. Every stage takes null texts and metadata, repeated rows and empty
tables as its operator says.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weft.llm import bpe, exact_dedup, mixing, near_dedup, quality
from weft.llm.common import stored, table

# Shares of the mix; the sources not named divide the rest equally.
WEIGHTS = {"src0": 0.3}
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a co-trained classifier, fitted on ``labels``, does not reject as low quality or toxic."""
    return quality.keep_good(docs, quality.co_train(docs, table(spark, sf_dir, "labels")))


def exact_unique(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that are equal but for white space, the one with the smallest doc_id."""
    return exact_dedup.keep_first(docs)


def near_unique(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents linked by a similarity of 0.8 on shingles of five words, the one with the smallest doc_id."""
    return near_dedup.keep_one(docs, n=5, percent=80)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated, or left out, by Poisson draws that bring the sources to WEIGHTS, in a random order."""
    return mixing.replicate(docs, WEIGHTS).select(*[F.col(f"`{c}`") for c in docs.columns])


def tokenised(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids, offsets and decoded_sha256 (of what the ids decode to) of every row."""
    # written between, so that a task has one Python worker at a time; each holds the ranks and its cache
    decoded = bpe.decode(stored(bpe.encode(docs, RANKS), "encoded"), RANKS, keep_ids=True)
    return decoded.withColumn("decoded_sha256", F.sha2("decoded", 256)).drop("decoded")


STAGES = [
    ("quality classifier", good_quality),
    ("exact dedup", exact_unique),
    ("near dedup", near_unique),
    ("source mixing", mixed),
    ("byte-level BPE", tokenised),
]

# SQL cannot express fitting the classifier or the encoding; tests/llm/test_pipeline.py holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
