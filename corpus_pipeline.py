"""Corpus pipeline: quality, near-dedup, decontamination, PII, mixing; each stage is written and read again."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from tenement.llm.common import fresh, removed, shared_dir, table, temporary
from tenement.llm.decontaminate import without_contaminated
from tenement.llm.mixing import mix
from tenement.llm.neardup import one_of_each
from tenement.llm.pii import find_pii, redact
from tenement.llm.quality import scored


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored 0.5 or more stay."""
    (score,) = fresh(docs, "score")
    rows = docs if "quality_score" not in docs.columns else docs.withColumnRenamed("quality_score", score)
    out = scored(rows, table(spark, sf_dir, "labels")).where("quality_score >= 0.5").drop("quality_score")
    return out.withColumnRenamed(score, "quality_score").select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row stays of every group of near copies: SimHash anchors and MinHash bands of five-word shingles propose, a Jaccard similarity of 0.8 or more decides."""
    return one_of_each(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark passage go, those without doc_id too."""
    return without_contaminated(docs, table(spark, sf_dir, "benchmark")).select(*docs.columns)


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Spans of personal data become [KIND]."""
    return redact(docs, find_pii(docs))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: words taken of every document."""
    return mix(docs).select("doc_id", "size", "source_size", "target", "taken")


STAGES = [("quality", quality), ("near_dedup", near_dedup), ("decontaminate", decontaminate), ("pii", pii), ("mixing", mixing)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in turn, each written to the shared folder and read again; what a stage has read, and what its operators
    kept there, goes when its own rows are written."""
    folder = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    docs, before = table(spark, sf_dir, "documents"), None
    for i, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{i}_{name}"
        with temporary(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        if before:
            removed(spark, before)
        docs, before = spark.read.parquet(path), path
    return docs
