"""Command line: run the full sync (C5) over a landing folder with spark-submit.

    spark-submit -m ledgerline sync --landing s3a://bucket/landing \
        --registry s3a://bucket/registry --version 42 --out s3a://bucket/reports/run-42 \
        [--lookups s3a://bucket/lookups] [--run-ts "2026-12-04 00:00:00"]

Reads ``<registry>/snapshot=<version>``, writes ``snapshot=<version + 1>``,
and under ``--out``: ``change_report/`` (CSV), ``missing/`` (CSV) and
``rejects/`` (parquet). Paths are any Hadoop URI.
"""

from __future__ import annotations

import argparse
import datetime as dt

from pyspark.sql import SparkSession

from ledgerline.plans.jobs import full_sync
from ledgerline.session import ensure_checkpoint_dir
from ledgerline.sinks import writers
from ledgerline.sources import registry as reg_src
from ledgerline.sources import snapshots


def main(argv=None, spark: SparkSession | None = None) -> int:
    ap = argparse.ArgumentParser(prog="ledgerline")
    sub = ap.add_subparsers(dest="cmd", required=True)
    s = sub.add_parser("sync", help="apply landed files to the registry, audit and correct")
    s.add_argument("--landing", required=True)
    s.add_argument("--glob", default="*.json")
    s.add_argument("--registry", required=True, help="base folder of snapshot=<n> versions")
    s.add_argument("--version", type=int, required=True, help="current registry version")
    s.add_argument("--out", required=True)
    s.add_argument("--lookups", help="folder of lookup-result JSON arrays (request_number, extracted_status, error)")
    s.add_argument("--run-ts", default=dt.datetime.now().strftime("%Y-%m-%d %H:%M:%S"))
    args = ap.parse_args(argv)

    spark = spark or SparkSession.builder.appName("ledgerline-sync").getOrCreate()
    ensure_checkpoint_dir(spark)
    current = spark.read.parquet(reg_src.latest_snapshot_path(args.registry, args.version))
    if args.lookups:
        lookups = snapshots.read_corrections(spark, args.lookups)
    else:
        lookups = spark.createDataFrame([], "request_number string, extracted_status string, error string, pos bigint")
    result = full_sync(spark, args.landing, current, lookups, args.run_ts, glob=args.glob)
    out = args.out.rstrip("/")
    writers.write_registry_snapshot(result.registry, args.registry, args.version + 1)
    writers.write_change_report(result.sync.report, f"{out}/change_report")
    writers.write_missing(result.missing, f"{out}/missing")
    result.sync.rejects.write.mode("overwrite").parquet(f"{out}/rejects")
    result.unmapped.write.mode("overwrite").parquet(f"{out}/unmapped")
    result.sync.classified.unpersist()
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
