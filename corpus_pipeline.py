"""Documents to token ids: toxic documents go, near copies go, repeated passages are cut, sources are
mixed to target weights, and what is left is encoded.

Each stage is written as Parquet and read again as the documents of the next, so a lost executor
costs no earlier stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from topicflow.llm import bpe, mixing, simhash, substring, toxicity
from topicflow.llm.common import stored

BPE_FILE = "byte_bpe_50k.json"


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the factorization machine gives a score below its threshold."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.keep_clean(docs, toxicity.fit(docs, labels))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of smallest id of each group of near copies."""
    return simhash.keep_first(docs)


def cut_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that an earlier document holds."""
    return substring.without_repeats(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated to the target weights of their sources, in random order."""
    return mixing.mix(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document; those of documents that the mixture repeats are repeated."""
    encoded = bpe.encode_decode(docs, public_tokenizers.path(BPE_FILE))
    return encoded.selectExpr("doc_id", "cast(size(ids) as bigint) as n_tokens", "ids", "decoded as text")


STAGES = [
    ("toxicity", reject_toxic),
    ("simhash_near_dedup", drop_near_copies),
    ("substring_dedup", cut_passages),
    ("mixing", mix_sources),
    ("bpe", encode),
]

#: A trained model, chains and merges are beyond SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = stored(docs)
    return docs
