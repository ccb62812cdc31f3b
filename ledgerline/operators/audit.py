"""Missing-key audit."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.schemas import ACTIVE_STATES, COUNTRY, COUNTRY_COL, KEY


def in_states(col: str = "status", states=ACTIVE_STATES) -> Column:
    """Status membership."""
    return F.col(col).isin(list(states))


def in_country(country: str = COUNTRY, col: str = COUNTRY_COL) -> Column:
    """Country equality."""
    return F.col(col) == F.lit(country)


def active_keys(registry: DataFrame, states=ACTIVE_STATES, scope: Column | None = None,
                key: str = KEY) -> DataFrame:
    """Distinct keys with an active status. No country filter by default
    (as the source system); ``scope`` adds one (D5)."""
    reg = registry.filter(in_states("status", states))
    if scope is not None:
        reg = reg.filter(scope)
    return reg.select(key).distinct()


def missing_keys(active: DataFrame, seen: DataFrame, key: str = KEY,
                 out: str = "missing_request_number") -> DataFrame:
    """Active keys that no landed file contains (exact key match).

    A left anti join: NULL keys on the seen side are harmless, unlike NOT IN.
    The result is unordered; ``sorted_missing`` or the CSV sink orders it.
    """
    return (active.join(seen.select(F.col(key).alias("_seen")),
                        F.col(key) == F.col("_seen"), "left_anti")
            .select(F.col(key).alias(out)))


def sorted_missing(missing: DataFrame, col: str = "missing_request_number") -> DataFrame:
    """O1: code-point order (binary collation)."""
    return missing.orderBy(col)
