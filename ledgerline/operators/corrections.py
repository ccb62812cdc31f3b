"""Status corrections from per-key lookups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.codes import map_correction_status
from ledgerline.schemas import KEY, STATUS_CORRECTION


def valid_corrections(corr: DataFrame) -> DataFrame:
    """Lookups without an error and with a non-empty status."""
    return corr.filter(F.col("error").isNull() & (F.coalesce(F.col("extracted_status"), F.lit("")) != ""))


def mapped_corrections(corr: DataFrame, mapping: dict[str, str] = STATUS_CORRECTION) -> DataFrame:
    """P6 + F5: valid lookups with their registry status (NULL when unmapped)."""
    return valid_corrections(corr).withColumn("status", map_correction_status("extracted_status", mapping))


def usable_corrections(corr: DataFrame, mapping: dict[str, str] = STATUS_CORRECTION) -> DataFrame:
    """Mapped corrections only (unmapped ones go to ``unmapped_corrections``)."""
    return mapped_corrections(corr, mapping).filter(F.col("status").isNotNull())


def unmapped_corrections(corr: DataFrame, mapping: dict[str, str] = STATUS_CORRECTION,
                         key: str = KEY) -> DataFrame:
    """Q3: valid lookups whose status has no mapping, as reject rows."""
    m = mapped_corrections(corr, mapping).filter(F.col("status").isNull())
    return m.select(F.lit("correction").alias("source"), F.lit(None).cast("string").alias("batch_id"),
                    F.col("pos").cast("bigint").alias("pos"), F.col(key).alias("request_number"),
                    F.lit("extracted_status").alias("column"), F.col("extracted_status").alias("raw_value"),
                    F.lit("unmapped status").alias("reason"))


def correction_totals(corr: DataFrame, mapping: dict[str, str] = STATUS_CORRECTION) -> DataFrame:
    """Processed lookups, valid ones, applicable ones."""
    m = corr.withColumn("_ok", F.col("error").isNull() & (F.coalesce(F.col("extracted_status"), F.lit("")) != ""))
    m = m.withColumn("_mapped", F.col("_ok") & map_correction_status("extracted_status", mapping).isNotNull())
    return m.agg(F.count(F.lit(1)).alias("processed"),
                 F.count_if(F.col("_ok")).alias("valid"),
                 F.count_if(F.col("_mapped")).alias("applied"))
