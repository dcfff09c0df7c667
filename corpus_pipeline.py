"""A corpus pipeline: quality, exact duplicates, near duplicates, contamination, mixture.

Each stage takes (spark, docs, sf_dir) and returns what it keeps; the next one reads that from Parquet. All but the last
return the columns of documents; the last adds ``repeats``, the times that the mix takes a document.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quillmine.llm import decontaminate, exact_dedup, mixture, near_dedup, quality
from quillmine.llm.common import removed, table, written

STAGES = [
    ("quality", quality.stage_quality),
    ("exact_dedup", exact_dedup.stage_exact_dedup),
    ("near_dedup", near_dedup.stage_near_dedup),
    ("decontaminate", decontaminate.stage_decontaminate),
    ("mixture", mixture.stage_mixture),
]

#: SQL cannot express the classifier's scores; tests hold the rows against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages on ``documents``; each one's table is deleted as soon as the next one's is written, but for the last, which the result reads."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        docs, path = written(stage(spark, docs, sf_dir), name)
        if before:
            removed(spark, before)
        before = path
    return STAGES[-1][1](spark, docs, sf_dir)
