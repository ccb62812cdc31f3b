"""Golden cases for the scalar functions (FIXTURES §3)."""

import datetime as dt

from pyspark.sql import functions as F

from ledgerline.functions import (
    compare_key, coalesce_blank, format_dmy, logo_asset, map_correction_status, map_status,
    normalise_holder, normalise_state, parse_dmy, parse_es_date, state_tag, surrogate_id,
)
from ledgerline.functions.dates import bad_date


def _eval(spark, values, fn, typ="string"):
    """Evaluate through the Column path and the SQL-text path (column name); both must agree."""
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {typ}")
    rows = df.orderBy("i").select(fn(F.col("v")).alias("a"), fn("v").alias("b")).collect()
    assert [r.a for r in rows] == [r.b for r in rows]
    return [r.a for r in rows]


def test_parse_es_date(spark):
    cases = {
        "5 ene. 2020": dt.date(2020, 1, 5),
        "15 SEPT. 1999": dt.date(1999, 9, 15),
        "15 sep. 1999": None,
        "1 mayo 2020": None,
        "31 feb. 2020": None,
        "29 feb. 2020": dt.date(2020, 2, 29),
        "5 ene.  2020": None,
        " 5 ene. 2020": None,
        "abc feb. 2020": None,
        "005 ene. 2020": None,
        "20 ene. 19": None,
        "": None,
        None: None,
    }
    assert _eval(spark, list(cases), parse_es_date) == list(cases.values())


def test_bad_date_flags_only_non_empty(spark):
    got = _eval(spark, ["5 ene. 2020", "31 feb. 2020", "", None], bad_date)
    assert got == [False, True, False, False]


def test_normalise_holder(spark):
    cases = [
        (["Acme; Inc"], "ACME, INC"),
        (["Acme; Inc", "  B  C "], "ACME, INC; B C"),
        (["Peña  Hijos"], "PEÑA HIJOS"),
        (["a\u001cb"], "A B"),
        (["", "x"], "; X"),
        (["straße"], "STRASSE"),
        (["[odd"], "[ODD"),
        ([], ""),
        (None, ""),
    ]
    got = _eval(spark, [c[0] for c in cases], normalise_holder, "array<string>")
    assert got == [c[1] for c in cases]


def test_map_status(spark):
    got = _eval(spark, ["Registrada", "CON OPOSICIÓN", "Con oposicion", " registrada", None], map_status)
    assert got == ["VIGENTE", "OPOSICION", "Con oposicion", " registrada", None]


def test_map_correction_status(spark):
    got = _eval(spark, ["vigente", "Con oposicion", "Con oposición", "Registrada"], map_correction_status)
    assert got == ["VIGENTE", "OPOSICION", None, None]


def test_logo_asset(spark):
    df = spark.createDataFrame([("SD2019/0001", "http://x"), ("SD2019/0002", ""), ("SD2019/0003", None)],
                               "k string, u string")
    got = [r[0] for r in df.select(logo_asset("k", "u", "P/")).collect()]
    assert got == ["P/SD2019_0001.jpeg", "", ""]


def test_compare_key(spark):
    vals = [None, "", "  ", " A ", "A", " A", "a", "a  b", "a b"]
    got = _eval(spark, vals, compare_key)
    assert got[0] == got[1] == got[2] == ""
    assert got[3] == got[4] == got[5] == "A"
    assert got[6] != got[4]
    assert got[7] != got[8]


def test_state(spark):
    assert _eval(spark, [" Active ", None, "other"], normalise_state) == ["active", "inactive", "inactive"]
    assert _eval(spark, ["active", "x"], state_tag) == ["ACTIVE", "INACTIVE"]


def test_coalesce_blank(spark):
    df = spark.createDataFrame([("  ", " Negada "), ("Vigente", "x"), ("", None)], "a string, b string")
    got = [r[0] for r in df.select(coalesce_blank("a", "b")).collect()]
    assert got == ["Negada", "Vigente", None]


def test_dmy_round_trip(spark):
    got = _eval(spark, ["02/01/1900", "31/12/2018"], lambda c: format_dmy(parse_dmy(c)))
    assert got == ["02/01/1900", "31/12/2018"]


def test_surrogate_id_is_deterministic_uuid_shape(spark):
    df = spark.createDataFrame([("COLOMBIA", "SD1/1"), ("COLOMBIA", "SD1/1"), ("PERU", "SD1/1")], "c string, k string")
    ids = [r[0] for r in df.select(surrogate_id("c", "k")).collect()]
    assert ids[0] == ids[1] != ids[2]
    assert [len(p) for p in ids[0].split("-")] == [8, 4, 4, 4, 12]


def test_unknown_month_and_odd_blanks(spark):
    from ledgerline.functions.codes import normalise_state
    from ledgerline.functions.dates import sql_parse_es_date

    row = spark.createDataFrame([("05-12 foo 2020", " Active\t")], "d string, s string")
    got = row.select(F.expr(sql_parse_es_date("d")).alias("d"), normalise_state("s").alias("s")).first()
    assert got.d is None and got.s == "active"
