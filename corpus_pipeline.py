"""Language ID, near-dedup, decontamination, mixing and sharding over all documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tillwise.llm import decontaminate, langid, mixing, sharding, simhash
from tillwise.sources.scratch import materialise

STAGES = [
    ("language", langid.stage),
    ("near_dedup", simhash.stage),
    ("decontaminate", decontaminate.stage),
    ("mix", mixing.stage),
    ("shard", sharding.stage),
]

# fingerprints, learned languages and the drawn blocks have no SQL form; tests/llm compares with brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each reads what the one before wrote."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
