"""Registry store: a commit rewrites the partitions with a changed key and leaves all other files alone."""

import os

from ledgerline.operators.registry import change_set
from ledgerline.plans import jobs
from ledgerline.sinks import store
from ledgerline.streaming.sync import latest_version, stream_sync

from test_diff import REG_A, _registry

RUN = "2024-06-01 00:00:00"


def files_of(base):
    out = {}
    for folder, _, names in os.walk(os.path.join(base, "data")):
        for name in names:
            if name.endswith(".parquet"):
                path = os.path.join(folder, name)
                out[path] = (os.stat(path).st_mtime_ns, os.path.getsize(path))
    return out


def registry(spark, n=200):
    return _registry(spark, [dict(REG_A, id=str(i), request_number=f"K{i}") for i in range(n)]
                     + [dict(REG_A, id="dup", request_number="K7")])


def raw(spark, keys, batch_no=0):
    from ledgerline.schemas import RAW_COLUMNS
    rows = [(batch_no, i, k, "Negada") for i, k in enumerate(keys)]
    df = spark.createDataFrame(rows, "batch_no long, pos long, request_number string, status string")
    return df.selectExpr("batch_no", "pos", *[c if c in df.columns else f"cast(null as {'array<string>' if c == 'holder' else 'string'}) as {c}"
                                              for c in RAW_COLUMNS])


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_commit_touches_changed_partitions_only(spark, tmp_path):
    base, reg = str(tmp_path / "store"), registry(spark)
    store.create_store(reg, base, 32)
    assert rows(store.read_store(spark, base, 0)) == rows(reg)
    before = files_of(base)
    result = jobs.sync_registry(raw(spark, ["K7", "NEW"]), reg, RUN, persist=False)
    assert store.commit_changes(result.classified, base, 0) == 1
    after = files_of(base)
    assert {k: after[k] for k in before} == before
    new = {p.split("bucket=")[1].split("/")[0] for p in after if "version=1" in p}
    assert 1 <= len(new) <= 2
    assert rows(store.read_store(spark, base, 1)) == rows(result.registry)
    assert rows(store.read_store(spark, base, 0)) == rows(reg)  # the version before stays readable
    # Committing again writes the same version again.
    assert store.commit_changes(result.classified, base, 0) == 1
    assert rows(store.read_store(spark, base, 1)) == rows(result.registry)


def test_commit_without_changes_writes_no_rows(spark, tmp_path):
    base, reg = str(tmp_path / "store"), registry(spark, 5)
    store.create_store(reg, base, 4)
    before = files_of(base)
    result = jobs.sync_registry(raw(spark, []), reg, RUN, persist=False)
    assert store.commit_changes(result.classified, base, 0) == 1
    assert files_of(base) == before and rows(store.read_store(spark, base, 1)) == rows(reg)


def test_empty_store_takes_inserts(spark, tmp_path):
    base, reg = str(tmp_path / "store"), _registry(spark, [])
    store.create_store(reg, base, 4)
    result = jobs.sync_registry(raw(spark, ["A", "B"]), reg, RUN, persist=False)
    assert store.commit_changes(result.classified, base, 0) == 1
    assert {r.request_number for r in store.read_store(spark, base, 1).collect()} == {"A", "B"}


def test_change_set_holds_changed_rows_only(spark):
    reg = registry(spark, 50)
    result = jobs.sync_registry(raw(spark, ["K7", "NEW", "K7"]), reg, RUN, persist=False)
    got = change_set(reg, result.classified).collect()
    assert sorted((r.op, r.request_number, r.id) for r in got if r.op == "UPDATE") == [("UPDATE", "K7", "7"), ("UPDATE", "K7", "dup")]
    assert [r.request_number for r in got if r.op == "INSERT"] == ["NEW"]
    changed = {tuple(r)[1:]: r.op for r in got}
    after, before = {tuple(r) for r in result.registry.collect()}, {tuple(r) for r in reg.collect()}
    assert after - before == set(changed) and len(before - after) == 2


def test_stream_into_a_store(spark, tmp_path):
    landing, base = tmp_path / "landing", str(tmp_path / "store")
    landing.mkdir()
    reg = registry(spark)
    store.create_store(reg, base, 32)
    for i, text in enumerate(['[{"request_number":"K1","status":"Negada"}]', '[{"request_number":"Z"}, 5]',
                              '[{"request_number":"K1","status":"Registrada"}]']):
        (landing / f"f{i}.json").write_text(text)
        os.utime(landing / f"f{i}.json", (1_700_000_000 + i, 1_700_000_000 + i))
    before = files_of(base)
    version = stream_sync(spark, f"{landing}/*.json", base, str(tmp_path / "ckpt"), RUN)
    assert version == 3 == latest_version(spark, base)
    after = files_of(base)
    assert {k: after[k] for k in before} == before
    assert {p.split("version=")[1].split("/")[0] for p in after} == {"0", "1", "2", "3"} and len(after) == len(before) + 3
    from ledgerline.sources import snapshots
    parts, _ = snapshots.snapshot_raw(snapshots.number_batches(snapshots.read_files(spark, str(landing))))
    assert rows(store.read_store(spark, base, version)) == rows(jobs.sync_registry(parts, reg, RUN, persist=False).registry)
