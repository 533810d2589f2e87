"""Corpus pipeline: five stages over ``documents``.

Each stage is ``function(spark, docs, sf_dir) -> DataFrame``; its result is
written as Parquet to the shared folder and read again as the next stage's
documents, so a lost executor costs at most the stage it worked on.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ctxanomaly.llm.common import cut, table
from ctxanomaly.llm.decontaminate import drop_leaks
from ctxanomaly.llm.packing import pack, pieces
from ctxanomaly.llm.quality_rules import keep_good
from ctxanomaly.llm.secret_scan import redact
from ctxanomaly.llm.simhash_neardup import keep_one


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that fail the base rules or come from a rejected host."""
    return keep_good(docs)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each near-duplicate class."""
    return keep_one(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that cover a benchmark item."""
    return drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace every secret span; all documents stay."""
    return redact(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack the documents into sequences: one row per piece."""
    return pack(pieces(docs))


STAGES = [
    ("quality rules", quality_rules),
    ("SimHash near-dedup", simhash_near_dedup),
    ("benchmark decontamination", benchmark_decontamination),
    ("secret scans", secret_scans),
    ("best-fit packing", best_fit_packing),
]

#: SimHash needs XXH64, which DuckDB lacks; tests hold run() against a
#: brute-force version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), "stage_" + name.replace(" ", "_"))
    return STAGES[-1][1](spark, docs, sf_dir)
