"""Work is done once: steps that several outputs share, and slices that do not make tasks."""

import os
import re

from ledgerline.operators import diff
from ledgerline.plans import derived, jobs
from ledgerline.sinks import store, writers
from ledgerline.sources import snapshots

from conftest import SF
from test_diff import REG_A, _registry
from test_store import RUN, raw


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan")[0]


def test_registry_rows_come_from_one_pass_over_the_orders(spark):
    plan = final_plan(derived.registry_from_orders(spark, SF))
    assert len(re.findall(r"FileScan parquet \[o_orderkey", plan)) == 1


def test_version_chain_joins_nothing_back(spark):
    rows = spark.createDataFrame([(b, k, v) for b in (0, 5, 6, 70) for k, v in (("A", str(b // 6)), ("B", "same"))],
                                 "batch_no long, k string, v string")
    chain = diff.version_chain(rows, None, "batch_no", key_cols=["k"], compared=["v"], bucket_size=4)
    assert "Join" not in chain._jdf.queryExecution().optimizedPlan().toString()
    got = {(r.k, r.batch_no): r.change_type for r in chain.collect()}
    assert got == {("A", 0): "INSERT", ("A", 5): "UNCHANGED", ("A", 6): "UPDATE", ("A", 70): "UPDATE",
                   ("B", 0): "INSERT", ("B", 5): "UNCHANGED", ("B", 6): "UNCHANGED", ("B", 70): "UNCHANGED"}


def test_null_keys_are_not_carried_across_buckets(spark):
    rows = spark.createDataFrame([(b, None, "v") for b in (0, 1, 4, 5)], "batch_no long, k string, v string")
    chain = diff.version_chain(rows, None, "batch_no", key_cols=["k"], compared=["v"], bucket_size=4)
    assert [r.change_type for r in chain.orderBy("batch_no").collect()] == ["INSERT", "UNCHANGED"] * 2


def test_updated_and_inserted_rows_share_one_computation(spark):
    reg = derived.registry_from_orders(spark, SF)
    batch = derived.snapshot_batch(derived.snapshot_from_orders(spark, SF))
    plan = final_plan(jobs.sync_registry(batch, reg, RUN, persist=False).registry)
    assert plan.count("Window [") == 2  # one chain: a window within buckets, one across


def test_commit_computes_the_versions_once(spark, tmp_path):
    base, reg = str(tmp_path / "store"), _registry(spark, [dict(REG_A, id="1", request_number="K1")])
    store.create_store(reg, base, 4)
    classified = jobs.sync_registry(raw(spark, ["K1", "N"]), reg, RUN, persist=False).classified
    seen = spark.sparkContext.accumulator(0)

    def look(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    assert store.commit_changes(classified.mapInArrow(look, classified.schema), base, 0) == 1
    assert seen.value == 2 and store.read_store(spark, base, 1).count() == 2


def test_full_sync_runs_c1_once(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"request_number":"K1","status":"Negada"},{"request_number":"N"}]')
    reg = _registry(spark, [dict(REG_A, id=str(i), request_number=f"K{i}", status="VIGENTE") for i in (1, 2)])
    lookups = spark.createDataFrame([("K2", "Cancelada", None, 0)], "request_number string, extracted_status string, error string, pos long")
    out = jobs.full_sync(spark, str(tmp_path), reg, lookups, RUN, persist=False)
    plan = out.registry._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan and "Aggregate" in plan  # the corrections read C1's registry, they do not make it
    assert {r.request_number: r.status for r in out.registry.collect()} == {"K1": "NEGADA", "K2": "CANCELADA", "N": None}


def test_documents_of_one_slice_are_dealt_over_tasks(spark, tmp_path):
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    old = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        records = spark.range(4000).selectExpr("'one' AS slice_id", "id AS pos", "CAST(id AS STRING) AS request_number")
        planned = spark.createDataFrame([("one",), ("none",)], "slice_id string")
        out = str(tmp_path / "docs")
        writers.write_snapshot_json(records, out, max_records=100, slices=planned)
        tasks = {re.match(r"part-(\d+)", f).group(1) for d, _, names in os.walk(out) if "slice_id=one" in d
                 for f in names if f.endswith(".txt")}
        assert len(tasks) > 1
        batches = snapshots.read_batches(spark, out)
        joins = [x for x in batches._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Join Inner" in x]
        assert "document#" in joins[0] and "batch_id" not in joins[0]  # the texts themselves are never dealt by slice
        assert batches.count() == 40 + 1
    finally:
        spark.conf.set(key, old)
