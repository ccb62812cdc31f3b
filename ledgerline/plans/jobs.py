"""Composite jobs (C1-C5): operators wired into the registry workflows.

Each job is lazy: it returns DataFrames; the caller (a sink, a test, the
bench) triggers the actions. The classified version frame feeds three
outputs (new registry, report, totals) and is persisted once.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.operators import audit, corrections, diff, normalise, registry as reg_ops
from ledgerline.schemas import (
    ACTIVE_STATES, COUNTRY, DEFAULT_LOGO_PREFIX, KEY, STATUS_CORRECTION, STATUS_RAW,
)
from ledgerline.session import written


@dataclass
class SyncResult:
    registry: DataFrame      # next registry state (REGISTRY_COLUMNS)
    report: DataFrame        # (batch_no, pos, request_number, changed, columns_changed)
    totals: DataFrame        # (change_type, n)
    classified: DataFrame    # every (key, batch) version with change_type / columns_changed
    rejects: DataFrame       # (source, batch_id, pos, request_number, column, raw_value, reason)


def sync_registry(raw: DataFrame, registry: DataFrame, run_ts, country: str = COUNTRY,
                  logo_prefix: str = DEFAULT_LOGO_PREFIX, status_map: dict = STATUS_RAW,
                  bucket_size: int | None = 1024, persist: bool = True,
                  colocate_registry: bool = False) -> SyncResult:
    """Apply landed raw batches to the registry.

    ``raw`` holds RAW_COLUMNS plus ``batch_no`` (processing order) and ``pos``
    (position in the batch); extra columns such as ``batch_id`` pass through.

    The registry is joined twice (comparison base, next state). By default
    AQE decides each join: with a small change side both are broadcasts and
    the registry is never shuffled. When both sides are large,
    ``colocate_registry=True`` hash-partitions the registry by key once and
    both joins reuse that exchange (one registry shuffle instead of two).
    """
    if colocate_registry:
        registry = registry.repartition("badger_country", KEY)
    norm = normalise.normalise(raw, run_ts, country=country, logo_prefix=logo_prefix, status_map=status_map)
    # W1 (first record per key and file) is reduced inside the chain, before its shuffle.
    classified = diff.version_chain(norm, registry, "batch_no", bucket_size=bucket_size, pos_col="pos")
    if persist:
        classified = classified.persist(StorageLevel.MEMORY_AND_DISK)
    rejects = normalise.reject_missing_key(raw).unionByName(normalise.reject_bad_dates(raw))
    return SyncResult(
        registry=reg_ops.upsert(registry, classified, "batch_no"),
        report=diff.change_report(classified, extra=["batch_no", "pos"]),
        totals=diff.change_totals(classified),
        classified=classified,
        rejects=rejects,
    )


def audit_missing(raw_keys: DataFrame, registry: DataFrame, states=ACTIVE_STATES, scope=None) -> DataFrame:
    """Active registry keys that no landed file contains (unordered)."""
    return audit.missing_keys(audit.active_keys(registry, states, scope), raw_keys)


def apply_corrections(corr: DataFrame, registry: DataFrame, run_ts, mapping: dict = STATUS_CORRECTION,
                      country: str | None = COUNTRY) -> tuple[DataFrame, DataFrame]:
    """(next registry, unmapped corrections). ``corr`` has request_number,
    extracted_status, error and a position ``pos`` (later wins)."""
    usable = corrections.usable_corrections(corr, mapping)
    new_reg = reg_ops.apply_status(registry, usable, run_ts, "pos", country=country)
    return new_reg, corrections.unmapped_corrections(corr, mapping)


def verify_and_correct(raw_keys: DataFrame, registry: DataFrame, lookups: DataFrame, run_ts,
                       mapping: dict = STATUS_CORRECTION,
                       read=None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """C4: missing keys -> their looked-up statuses -> corrected registry.

    ``lookups`` stands in for the live per-key lookups: rows of
    (request_number, extracted_status, error, pos), e.g. from
    ``operators.pages.detail_status`` over fetched detail pages. Only
    lookups of missing keys are applied. With ``read``, ``lookups`` are raw
    rows with the key (fetched pages) that are turned into such rows only
    after the semi join, so pages of other keys are never parsed.
    """
    missing = audit_missing(raw_keys, registry)
    wanted = lookups.join(missing.select(F.col("missing_request_number").alias(KEY)), KEY, "left_semi")
    wanted = wanted if read is None else read(wanted)
    new_reg, unmapped = apply_corrections(wanted, registry, run_ts, mapping)
    return missing, new_reg, unmapped


@dataclass
class FullSyncResult:
    sync: SyncResult         # C1 over the landing area
    missing: DataFrame       # C2: active keys no landed file contains
    registry: DataFrame      # registry after C1 and the corrections (C3)
    unmapped: DataFrame      # Q3 rejects of the corrections


def full_sync(spark, landing, registry: DataFrame, lookups: DataFrame, run_ts, glob: str = "*.json",
              recursive: bool = False, **sync_options) -> FullSyncResult:
    """C1 over every file of one landing area (U4: all feeds share it),
    then C2 on the raw keys of the same files, then C3 with the lookups of
    the missing keys (``lookups``: request_number, extracted_status, error, pos).

    The parsed records and the registry after C1 are read by several steps, so both are written once to the
    checkpoint folder: documents are parsed once for C1, and C2 and C3 do not run C1 again.
    """
    from ledgerline.sources import snapshots

    files = snapshots.read_numbered(spark, landing, glob, recursive)
    raw, rejects = snapshots.snapshot_raw(files)
    result = sync_registry(written(raw), registry, run_ts, **sync_options)
    result.registry = written(result.registry)
    result.rejects = (result.rejects.unionByName(rejects)
                      .unionByName(snapshots.empty_files(spark, landing, glob)))
    seen = snapshots.raw_keys(files)
    missing, corrected, unmapped = verify_and_correct(seen, result.registry, lookups, run_ts)
    return FullSyncResult(result, missing, corrected, unmapped)
