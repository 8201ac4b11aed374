"""Quality rules, near-dedup, substring dedup, secret scans and packing, one after another over a corpus."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from chartlake.llm.stages import STAGES
from chartlake.llm.tables import saved

#: Encoding and the searches have no SQL form; tests/llm/test_pipeline.py compares each stage and run() with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
