"""The corpus pipeline: toxic documents go, one of each group of near-duplicates stays, repeated
passages are cut, contaminated documents go, and the rest is sampled to the target mixture.

Each stage takes (spark, docs, sf_dir) and returns documents; it is written as
Parquet in the shared folder and read again as the next one's input, so a lost
executor costs no more than the stage that is running.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from corpusloom.llm import decontamination, mixing, near_dup, suffix_dedup, toxicity
from corpusloom.llm.common import shared_folder, table

STAGES = [
    ("toxicity", toxicity.stage),
    ("minhash_near_dedup", near_dup.stage),
    ("suffix_array_dedup", suffix_dedup.stage),
    ("benchmark_decontamination", decontamination.stage),
    ("source_mixing", mixing.stage),
]

#: Block-max search, suffix sorting and raking have no SQL form; tests/llm/test_pipeline.py holds run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for k, (name, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}-{name}")
        docs = spark.read.parquet(f"{folder}/{k}-{name}")
    return docs
