"""One query for each operator, over its whole table and with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from topicflow.llm import (
    bpe,
    embeddings,
    extraction,
    fertility,
    infill,
    licenses,
    mixing,
    ordinal,
    resampling,
    simhash,
    substring,
    token_files,
    toxicity,
)

BPE_FILE = corpus_pipeline.BPE_FILE
PIECE_FILE = "piece_bpe_32k.model"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, _table(spark, sf_dir, "labels")))


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return bpe.digests(bpe.encode_decode(docs, public_tokenizers.path(BPE_FILE)))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents"), copy="copy")


def op4_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(_table(spark, sf_dir, "documents"))


def op5_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(_table(spark, sf_dir, "embeddings"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return ordinal.grade(docs, ordinal.fit(docs, ordinal.graded(_table(spark, sf_dir, "labels"))))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.simhash_components(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.fingerprint_text().alias("fingerprint"), "component_id")


def op8_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extraction.extract(_table(spark, sf_dir, "pages"))


def op9_fertility(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return fertility.quality(docs, public_tokenizers.path(PIECE_FILE))


def op10_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = substring.cut_repeats(_table(spark, sf_dir, "documents"))
    return cut.select(
        "doc_id",
        F.col("_n_words").alias("n_words"),
        F.array_distinct("_spans.other").alias("other_doc_ids"),
        F.col("_spans").alias("spans"),
        "text",
    )


def op11_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resample(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op12_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_files(_table(spark, sf_dir, "documents"), public_tokenizers.path(BPE_FILE))


def op13_infill(spark: SparkSession, sf_dir: str) -> DataFrame:
    filled = infill.fill_in_middle(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return infill.digests(filled)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_toxicity": op1_toxicity,
        "op2_bpe": op2_bpe,
        "op3_mixing": op3_mixing,
        "op4_licenses": op4_licenses,
        "op5_embeddings": op5_embeddings,
        "op6_quality": op6_quality,
        "op7_simhash": op7_simhash,
        "op8_extraction": op8_extraction,
        "op9_fertility": op9_fertility,
        "op10_substring": op10_substring,
        "op11_resampling": op11_resampling,
        "op12_token_files": op12_token_files,
        "op13_infill": op13_infill,
        "pipeline": corpus_pipeline.run,
    }


def oracle_sql() -> dict[str, str]:
    """SQL for what it can express; the others are tested against brute force."""
    return {"op3_mixing": mixing.SQL, "op11_resampling": resampling.SQL, "op13_infill": infill.SQL}
