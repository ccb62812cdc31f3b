"""Registry readers.

The registry is any table Spark can scan: a parquet snapshot directory
(default), a catalog table, or JDBC. Projection and the country predicate
reach the scan (``PushedFilters`` / ``ReadSchema``). A key list is never
sent as an IN literal: lookups are semi joins against a key frame.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerline.operators.audit import active_keys, in_country
from ledgerline.operators.diff import touched
from ledgerline.schemas import ACTIVE_STATES, COMPARED, COUNTRY, KEY, REGISTRY_SCHEMA

READ_COLUMNS = [KEY] + COMPARED


def read_registry(spark: SparkSession, path: str, fmt: str = "parquet", **options) -> DataFrame:
    """Load a registry snapshot (all REGISTRY_COLUMNS)."""
    reader = spark.read.format(fmt).options(**options)
    if fmt in ("csv", "json"):
        reader = reader.schema(REGISTRY_SCHEMA)
    return reader.load(path) if fmt != "jdbc" else reader.load()


def latest_snapshot_path(base: str, version: int) -> str:
    return f"{base.rstrip('/')}/snapshot={version}"


def scan_registry(registry: DataFrame, country: str = COUNTRY) -> DataFrame:
    """The 10 compared columns of one country's rows."""
    return registry.filter(in_country(country)).select(*READ_COLUMNS)


def lookup_registry(registry: DataFrame, keys: DataFrame, country: str = COUNTRY) -> DataFrame:
    """S5 restricted to a key frame (semi join); no keys -> no rows."""
    return touched(registry.filter(in_country(country)), keys.select(KEY), [KEY]).select(*READ_COLUMNS)


def scan_active_keys(registry: DataFrame, states=ACTIVE_STATES) -> DataFrame:
    """Distinct keys with an active status, every country (as the source system)."""
    return active_keys(registry, states)

