"""The corpus pipeline: documents to token ids, in five stages.

Each stage works on all that its predecessor kept, written as Parquet and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from veinwork.llm import stages
from veinwork.llm.common import read
from veinwork.session import durable

STAGES = [
    ("quality", stages.quality),
    ("near_duplicates", stages.near_duplicates),
    ("decontamination", stages.decontamination),
    ("personal_data", stages.personal_data),
    ("tokens", stages.tokens),
]

# Scores, similarity groups and token ids are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = durable(stage(spark, docs, sf_dir))
    return docs
