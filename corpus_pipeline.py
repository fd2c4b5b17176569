"""Corpus pipeline: toxicity, near-dedup, decontamination, PII, packing."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm import decontaminate, neardup, packing, pii, toxicity
from tidemark.session import ensure_checkpoint_dir


def toxic_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the rows of each doc_id that the toxicity model rejects; rows without doc_id stay."""
    bad = toxicity.score(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")).where("predicted = 1")
    return docs.join(bad.select("doc_id").distinct(), "doc_id", "left_anti").select(docs.columns)


def neardup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One doc_id of each group of near copies stays (five words, similarity 0.8); empty texts stay."""
    gone = neardup.groups(docs, 5, 80, 100, m=14).where("not kept")
    return docs.join(gone.select("doc_id"), "doc_id", "left_anti").select(docs.columns)


def leak_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that hold a benchmark item, also with other numbers, names or units."""
    hit = decontaminate.contamination(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return docs.join(hit.select("doc_id").distinct(), "doc_id", "left_anti").select(docs.columns)


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in each text becomes <KIND>; null texts stay null; n_chars follows the new text."""
    chosen = pii.choose(pii.candidates(docs))
    return docs.withColumn("text", pii.redact(F.col("text"), chosen)).withColumn(
        "n_chars", F.length("text").cast("long"))


def pack_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per sequence with its bucket, shard and batch and its own part of the redacted text."""
    return packing.pack(docs, texts=True)


STAGES = [("toxicity", toxic_stage), ("near_dedup", neardup_stage), ("decontamination", leak_stage),
          ("pii", pii_stage), ("packing", pack_stage)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each stage is written to the shared checkpoint folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    top = f"{ensure_checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{top}/{name}")
        docs = spark.read.parquet(f"{top}/{name}")
    return docs
