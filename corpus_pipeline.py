"""Training-data pipeline over ``documents``: quality rules, near copies, secrets, source mix, byte-level BPE.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read
again as the next stage's documents. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from poiweave.llm import byte_bpe, mixing, near_dedup, quality_rules, secrets_crf
from poiweave.storage import materialise

STAGES = [
    ("quality_rules", quality_rules.stage),
    ("near_dedup", near_dedup.stage),
    ("secret_scan", secrets_crf.stage),
    ("source_mix", mixing.stage),
    ("byte_bpe", byte_bpe.stage),
]

#: The fitted label model and the random field have no SQL form; a test holds the rows of run() against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return docs
