"""Diff, version chain, upsert, audit and corrections (FIXTURES §5)."""

import datetime as dt

from pyspark.sql import functions as F

from ledgerline.operators import diff, registry as reg_ops
from ledgerline.plans import jobs
from ledgerline.schemas import REGISTRY_SCHEMA

TS0 = dt.datetime(2024, 1, 1)


def _registry(spark, rows):
    full = []
    for r in rows:
        base = dict(id=None, request_number=None, registry_number=None, denomination=None, logo_url=None,
                    logo=None, filing_date=None, expiration_date=None, status=None, holder=None,
                    niza_class=None, gazette_number=None, updated_at=TS0, badger_country="COLOMBIA")
        base.update(r)
        full.append(tuple(base[f.name] for f in REGISTRY_SCHEMA.fields))
    return spark.createDataFrame(full, REGISTRY_SCHEMA)


RAW = ("batch_no bigint, pos bigint, request_number string, registry_number string, denomination string, "
       "logo_url string, filing_date string, expiration_date string, status string, holder array<string>, "
       "niza_class string, gazette_number string")


def _raw(spark, rows):
    out = []
    for r in rows:
        base = dict(batch_no=0, pos=0, request_number=None, registry_number="", denomination="", logo_url="",
                    filing_date="", expiration_date="", status=None, holder=[], niza_class="",
                    gazette_number="")
        base.update(r)
        out.append(tuple(base[k] for k in ["batch_no", "pos", "request_number", "registry_number",
                                           "denomination", "logo_url", "filing_date", "expiration_date",
                                           "status", "holder", "niza_class", "gazette_number"]))
    return spark.createDataFrame(out, RAW)


REG_A = dict(id="1", request_number="A", status="VIGENTE", holder="ACME", filing_date=dt.date(2020, 1, 5),
             niza_class="35")
RAW_A = dict(request_number="A", status="Registrada", holder=["acme"], filing_date="5 ene. 2020", niza_class="35",
             registry_number=None, denomination=None, logo_url=None, gazette_number=None)


def _report(spark, new_rows, reg_rows=(REG_A, dict(id="9", request_number="C", status="VIGENTE"))):
    res = jobs.sync_registry(_raw(spark, new_rows), _registry(spark, list(reg_rows)), "2024-06-01 00:00:00",
                             persist=False)
    return {r.request_number: (r.change_type, r.columns_changed) for r in res.classified.collect()}, res


def test_diff_cases(spark):
    cases = [
        (dict(RAW_A), ("UNCHANGED", None)),
        (dict(RAW_A, holder=[" ACME "], registry_number=""), ("UNCHANGED", None)),
        (dict(RAW_A, status="Negada"), ("UPDATE", "status")),
        (dict(RAW_A, niza_class="9", status="Negada", filing_date=""),
         ("UPDATE", "filing_date, status, niza_class")),
    ]
    for raw, expect in cases:
        got, _ = _report(spark, [raw])
        assert got["A"] == expect, (raw, got)
    got, res = _report(spark, [dict(request_number="B")])
    assert got == {"B": ("INSERT", "NEW_RECORD")}
    keys = sorted(r.request_number for r in res.registry.collect())
    assert keys == ["A", "B", "C"]  # C is never deleted


def test_diff_batch_matches_chain(spark):
    raws = [dict(RAW_A, status="Negada", pos=0), dict(request_number="B", pos=1)]
    reg = _registry(spark, [REG_A])
    from ledgerline.operators import normalise
    norm = normalise.normalise(_raw(spark, raws), "2024-06-01 00:00:00")
    one = {r.request_number: (r.change_type, r.columns_changed) for r in diff.diff_batch(norm, reg).collect()}
    got, _ = _report(spark, raws, [REG_A])
    assert one == got


def test_version_chain_and_latest_state(spark):
    vals = ["x", "x ", "y", "y", None]
    rows = [dict(request_number="A", batch_no=b, pos=0, denomination=v) for b, v in enumerate(vals)]
    for bucket in (None, 2, 1024):
        res = jobs.sync_registry(_raw(spark, rows), _registry(spark, []), F.expr("timestamp'2024-06-01'"),
                                 bucket_size=bucket, persist=False)
        rep = sorted((r.batch_no, r.columns_changed) for r in res.report.collect())
        assert rep == [(0, "NEW_RECORD"), (2, "denomination"), (4, "denomination")]
        (row,) = res.registry.collect()
        assert row.denomination is None and row.id is not None and row.logo == ""


def test_duplicate_registry_rows_all_updated(spark):
    reg = _registry(spark, [REG_A, dict(REG_A, id="2", denomination="OLD")])
    res = jobs.sync_registry(_raw(spark, [dict(RAW_A, status="Negada")]), reg, "2024-06-01 00:00:00",
                             persist=False)
    rows = sorted((r.id, r.status, r.denomination) for r in res.registry.collect())
    assert rows == [("1", "NEGADA", None), ("2", "NEGADA", None)]


def test_other_country_untouched(spark):
    reg = _registry(spark, [REG_A, dict(REG_A, id="3", badger_country="PERU")])
    res = jobs.sync_registry(_raw(spark, [dict(RAW_A, status="Negada")]), reg, "2024-06-01 00:00:00",
                             persist=False)
    rows = sorted((r.badger_country, r.status) for r in res.registry.collect())
    assert rows == [("COLOMBIA", "NEGADA"), ("PERU", "VIGENTE")]


def test_audit_missing(spark):
    reg = _registry(spark, [dict(id=str(i), request_number=k, status="VIGENTE") for i, k in enumerate("ABC")]
                    + [dict(id="9", request_number="D", status="NEGADA")])
    seen = spark.createDataFrame([("A",), ("",), (None,)], "request_number string")
    got = [r[0] for r in jobs.audit_missing(seen, reg).orderBy("missing_request_number").collect()]
    assert got == ["B", "C"]


def test_apply_corrections(spark):
    reg = _registry(spark, [dict(id=k, request_number=k, status="VIGENTE") for k in "ABCD"])
    corr = spark.createDataFrame(
        [("A", "Negada", None, 0), ("A", "Cancelada", None, 1), ("B", "Negada", "timeout", 2),
         ("C", "", None, 3), ("D", "Rara", None, 4)],
        "request_number string, extracted_status string, error string, pos bigint")
    new_reg, unmapped = jobs.apply_corrections(corr, reg, "2024-06-01 00:00:00")
    st = {r.request_number: r.status for r in new_reg.collect()}
    assert st == {"A": "CANCELADA", "B": "VIGENTE", "C": "VIGENTE", "D": "VIGENTE"}
    assert [r.request_number for r in unmapped.collect()] == ["D"]
    _ = reg_ops


def test_full_sync_over_landing(spark, tmp_path):
    d = tmp_path / "landing"
    d.mkdir()
    (d / "a.json").write_text('[{"request_number":"A","status":"Negada"},{"request_number":"N"}]')
    reg = _registry(spark, [REG_A, dict(id="2", request_number="M", status="VIGENTE")])
    lookups = spark.createDataFrame([("M", "Cancelada", None, 0)],
                                    "request_number string, extracted_status string, error string, pos bigint")
    out = jobs.full_sync(spark, str(d), reg, lookups, "2024-06-01 00:00:00", persist=False)
    assert [r[0] for r in out.missing.collect()] == ["M"]
    st = {r.request_number: r.status for r in out.registry.collect()}
    assert st == {"A": "NEGADA", "M": "CANCELADA", "N": None}


def test_align_and_common_columns(spark):
    from ledgerline.operators.normalise import align_columns, common_columns
    a = spark.createDataFrame([(1, 2, 3)], "request_number int, x int, y int")
    b = spark.createDataFrame([(1, 2)], "y int, request_number int")
    assert align_columns(a, ["y", "zz", "request_number"]).columns == ["y", "request_number"]
    assert common_columns(a, b) == ["y"]
