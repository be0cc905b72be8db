"""The corpus pipeline: raw documents to token ids, one operator a stage.

Every stage is written as Parquet to the shared folder and read again by the next one, so a lost executor or a
failed stage costs at most that stage.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from staffhouse.llm import queries as Q
from staffhouse.llm.common import ship, stage, table

STAGES = [
    ("toxicity", Q.drop_toxic),
    ("line_dedup", Q.dedup_lines),
    ("near_dedup", Q.drop_near_duplicates),
    ("decontamination", Q.decontaminate),
    ("byte_bpe", Q.encode),
]

#: The toxicity model is fitted, and BPE is not a query of one statement: tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), f"pipeline_{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
