"""The corpus pipeline: classify, near-dedup, mask secrets, mix, pack.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor
kept; all but the last return the columns of documents. ``run`` writes every
stage as Parquet into the shared checkpoint folder and reads it again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerline.llm import mixing, neardup, packing, quality, secrets
from ledgerline.llm.common import materialise, read


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs, read(spark, sf_dir, "labels"))


def keep_one(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return neardup.keep_one(docs)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.take(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES = [
    ("quality classifier", keep_good),
    ("MinHash near-dedup", keep_one),
    ("secret scans", mask_secrets),
    ("mixing sources to target weights", mix_sources),
    ("best-fit packing", pack_sequences),
]

#: Not expressible in SQL: the stages fit a model, hash, decode and pack.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
