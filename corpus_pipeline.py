"""Corpus pipeline: from raw documents to packed training sequences.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that
``run`` writes as Parquet and reads back as the next stage's ``docs``.  All
but the last return the columns of ``documents``.

1. language ID: documents without a recognised language go;
2. quality rules: documents that fail the rules or the classifier go;
3. SimHash near-dedup: one document of each group of near copies stays;
4. benchmark decontamination: documents that hold a benchmark passage go;
5. best-fit packing: the rest becomes sequences of at most 2048 tokens.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quizlog.llm import best_fit_packing, decontaminate, language_id, quality_rules, simhash_dedup
from quizlog.llm.shared import scratch_path, table

STAGES = [
    ("language_id", language_id.stage),
    ("quality_rules", quality_rules.stage),
    ("simhash_near_dedup", simhash_dedup.stage),
    ("benchmark_decontamination", decontaminate.stage),
    ("best_fit_packing", best_fit_packing.stage),
]

#: The stages rest on learned models, hashes and a packing search, which SQL
#: cannot express; tests/llm/test_pipeline.py checks run() by brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what the last one returns."""
    docs = table(spark, sf_dir, "documents")
    folder = scratch_path(spark)
    for name, stage in STAGES:
        path = f"{folder}/{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
