"""The corpus pipeline: five stages, each on all that its predecessor kept.

Language identification, line dedup, near-duplicate documents, decontamination, and byte-level BPE of
what is left. Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as
Parquet to the shared folder and read again as the next one's docs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cinderspark.llm import bpe, decontaminate, jaccard_join, langid, line_dedup, shared

STAGES = [
    ("language_id", langid.stage),
    ("line_dedup", line_dedup.stage),
    ("near_duplicates", jaccard_join.stage),
    ("decontamination", decontaminate.stage),
    ("byte_bpe", bpe.stage),
]

#: Support vector machines, minima and token ids have no SQL; tests compare with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = shared.read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = shared.stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
