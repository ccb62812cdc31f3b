"""Calendar slicing (FIXTURES §6) and the coverage property."""

import datetime as dt

from pyspark.sql import functions as F

from ledgerline.operators import slices


def _rows(df):
    return [(r.lo, r.hi) for r in df.orderBy("lo").collect()]


D = dt.date


def test_year_month_week_day(spark):
    assert _rows(slices.year_slices(spark, "1900-01-02", "1970-12-31", 71)) == [(D(1900, 1, 2), D(1970, 12, 31))]
    assert _rows(slices.year_slices(spark, "1971-01-01", "1975-12-31", 5)) == [(D(1971, 1, 1), D(1975, 12, 31))]
    assert _rows(slices.month_slices(spark, "2014-10-15", "2014-11-10")) == [
        (D(2014, 10, 1), D(2014, 10, 31)), (D(2014, 11, 1), D(2014, 11, 10))]
    w = _rows(slices.week_slices(spark, "2014-12-01", "2018-12-31"))
    assert len(w) == 214 and w[-1] == (D(2018, 12, 31), D(2018, 12, 31))
    w = _rows(slices.week_slices(spark, "2019-01-01", "2022-12-27"))
    assert len(w) == 209 and w[-1] == (D(2022, 12, 27), D(2022, 12, 27))
    assert len(_rows(slices.day_slices(spark, "2022-12-28", "2022-12-31"))) == 4


def test_year_slices_leap_day(spark):
    got = _rows(slices.year_slices(spark, "2020-02-29", "2025-12-31", 1))
    assert got[0] == (D(2020, 2, 29), D(2021, 2, 27)) and got[1][0] == D(2021, 2, 28)


def test_history_plan_covers_range(spark):
    plan = _rows(slices.history_plan(spark))
    assert len(plan) == 532
    assert plan[0][0] == D(1900, 1, 2) and plan[-1][1] == D(2018, 12, 31)
    for (lo1, hi1), (lo2, _) in zip(plan, plan[1:]):
        assert lo1 <= hi1 and lo2 == hi1 + dt.timedelta(days=1)


def test_slice_names_and_class_plan(spark):
    (r,) = slices.day_slices(spark, "2022-12-28", "2022-12-28", "INACTIVE").collect()
    assert r.slice_id == "28_12_2022_28_12_2022_INACTIVE"
    ids = [r.slice_id for r in slices.class_plan(spark, 44).orderBy(F.col("class_code").cast("int")).collect()]
    assert len(ids) == 44 and ids[0] == "niza_1_1900_1900_ACTIVE" and ids[-1] == "niza_44_1900_1900_ACTIVE"


def test_assign_matches_brute_force(spark):
    plan = slices.full_plan(spark, "2026-12-03", tags=("ACTIVE",))
    days = spark.range(0, 3000).select((F.col("id") * 17).alias("id"),
                                       F.date_add(F.lit(D(1960, 1, 1)), (F.col("id") * 17).cast("int")).alias("d"))
    fast = {(r.id, r.slice_id) for r in slices.assign_slices(days, "d", plan).collect()}
    brute = {(r.id, r.slice_id) for r in
             days.join(plan, F.col("d").between(F.col("lo"), F.col("hi"))).collect()}
    in_plan = days.filter(F.col("d").between(F.lit(D(1960, 1, 1)), F.lit(D(2026, 12, 3)))).count()
    assert fast == brute and len(fast) == in_plan


def test_overflow_is_marked_and_keeps_rows(spark):
    plan = slices.day_slices(spark, "2020-01-01", "2020-01-02")
    rows = spark.range(0, 2000 + 1999).select(
        F.when(F.col("id") < 2000, F.lit(D(2020, 1, 1))).otherwise(F.lit(D(2020, 1, 2))).alias("d"))
    assigned = slices.assign_slices(rows, "d", plan)
    marked = slices.flag_overflow(assigned, 2000)
    assert marked.count() == 3999
    kept = marked.filter("not overflow")
    assert kept.count() == 1999
    other = rows.unionByName(spark.sql("SELECT DATE'1850-01-01' AS d UNION ALL SELECT CAST(NULL AS DATE)"))
    assert sorted(str(r.d) for r in slices.outside_plan(other, "d", plan).collect()) == ["1850-01-01", "None"]
    flags = {r.slice_id: r.overflow for r in slices.slice_overflow(assigned, 2000).collect()}
    assert sorted(flags.values()) == [False, True]
    pending = slices.pending_slices(plan, kept.select("slice_id").distinct()).collect()
    assert [r.slice_id for r in pending] == ["01_01_2020_01_01_2020_ACTIVE"]
