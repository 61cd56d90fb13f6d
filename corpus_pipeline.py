"""Corpus pipeline: the whole ``documents`` table, stage by stage.

Every stage is a function ``(spark, docs, sf_dir) -> DataFrame`` over all the
rows its predecessor kept; its result is written as Parquet in the shared
folder and read back as the next stage's ``docs``.  All stages but the last
return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidewater.llm import decontaminate, packing, quality, simhash, toxicity
from tidewater.llm.common import remove_staged, stage, staged, table


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored toxic (0.7 or more) go; learnt from all labels."""
    return toxicity.keep_clean(docs, table(spark, sf_dir, "labels"))


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored of low quality (under 0.3) go; learnt from the
    labels of the documents left."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component stays (3 words, 2 bits)."""
    return simhash.dedup(docs, shingle=3, radius=2)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents holding a benchmark window go."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"), remove="documents")


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents left, with their places in the sequences."""
    placed = packing.pack_documents(docs)
    return placed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES = [
    ("toxicity", toxicity_filter),
    ("quality classifier", quality_filter),
    ("SimHash near-dedup", near_dedup),
    ("benchmark decontamination", decontamination),
    ("best-fit packing", best_fit_packing),
]

#: SQL cannot express trained scores, XXH64 fingerprints or tokenizing; the
#: pipeline is tested against a brute-force version of its stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``.  Once a stage's result is written, the
    one before and its inner steps are removed; the last one's stay, since
    the result is read from them."""
    docs, before = table(spark, sf_dir, "documents"), staged()
    for number, (_, step) in enumerate(STAGES):
        inner = staged()
        docs = stage(step(spark, docs, sf_dir), f"pipeline-stage-{number}")
        own = next(iter(p for p in staged() - inner if f"/pipeline-stage-{number}-" in p))
        remove_staged(spark, before, keep=own)
    return docs
