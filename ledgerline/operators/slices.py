"""Calendar slicing.

A plan is a small DataFrame ``(slice_id, lo, hi, tag, kind)`` of inclusive,
contiguous date ranges, generated from parameters (never from data).
Assigning rows to slices is a range join; it is turned into an equi-join
on a month bin: each slice is listed once per month it overlaps (a few
thousand rows for the full plan), each data row carries its own month, and
only the few candidate slices of that month are tested with BETWEEN. The
plan side is broadcast only after its size is checked.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.schemas import SLICE_CAP

BROADCAST_LIMIT = 200_000  # rows; a binned plan above this is shuffled instead

# The slicing calendar of the portal crawl.
HISTORY_YEAR_RANGES = [  # (first day, last day, years per slice)
    ("1900-01-02", "1970-12-31", 71),
    ("1971-01-01", "1975-12-31", 5),
    ("1976-01-01", "1980-12-31", 5),
    ("1981-01-01", "1985-12-31", 5),
    ("1986-01-01", "1986-12-31", 1),
    ("1987-01-01", "1987-12-31", 1),
    ("1988-01-01", "1988-12-31", 1),
]
HISTORY_MONTHS = ("1989-01-01", "2014-11-30")
HISTORY_WEEKS = ("2014-12-01", "2018-12-31")
RECENT_WEEKS = ("2019-01-01", "2022-12-27")
RECENT_DAYS = ("2022-12-28", "2022-12-31")
RECENT_OPEN_WEEKS_FROM = "2023-01-01"
CLASS_COUNT = 45  # documented 1-45; the crawl loop stops at 44 (D9)
CLASS_SENTINEL = "1900-01-01"


def _d(x) -> Column:
    return F.to_date(F.lit(str(x)))


def _date(x) -> str:
    return f"DATE'{dt.date.fromisoformat(str(x)).isoformat()}'"


def slice_name(lo, hi, tag) -> Column:
    """dd_MM_yyyy_dd_MM_yyyy_TAG."""
    return F.concat_ws("_", F.date_format(lo, "dd_MM_yyyy"), F.date_format(hi, "dd_MM_yyyy"), tag)


def _slice_sql(starts: str, hi: str, tag: str, kind: str) -> str:
    """SQL text of a plan part: one row per start date, ``hi`` over column ``lo``."""
    return (f"SELECT concat_ws('_', date_format(lo, 'dd_MM_yyyy'), date_format(hi, 'dd_MM_yyyy'), '{tag}') "
            f"AS slice_id, lo, hi, '{tag}' AS tag, '{kind}' AS kind "
            f"FROM (SELECT lo, {hi} AS hi FROM (SELECT explode({starts}) AS lo))")


def year_sql(lo, hi, years: int, tag: str = "ACTIVE") -> str:
    n = (dt.date.fromisoformat(str(hi)).year - dt.date.fromisoformat(str(lo)).year) // years + 1
    starts = (f"filter(transform(sequence(0, {n - 1}), i -> add_months({_date(lo)}, i * {12 * years})), "
              f"d -> d <= {_date(hi)})")
    return _slice_sql(starts, f"least(date_sub(add_months(lo, {12 * years}), 1), {_date(hi)})", tag, "year")


def month_sql(lo, hi, tag: str = "ACTIVE") -> str:
    starts = f"sequence(trunc({_date(lo)}, 'MM'), {_date(hi)}, INTERVAL 1 MONTH)"
    return _slice_sql(starts, f"least(last_day(lo), {_date(hi)})", tag, "month")


def week_sql(lo, hi, tag: str = "ACTIVE") -> str:
    starts = f"sequence({_date(lo)}, {_date(hi)}, INTERVAL 7 DAYS)"
    return _slice_sql(starts, f"least(date_add(lo, 6), {_date(hi)})", tag, "week")


def day_sql(lo, hi, tag: str = "ACTIVE") -> str:
    return _slice_sql(f"sequence({_date(lo)}, {_date(hi)}, INTERVAL 1 DAY)", "lo", tag, "day")


def year_slices(spark: SparkSession, lo, hi, years: int, tag: str = "ACTIVE") -> DataFrame:
    """G1: blocks of ``years`` years from ``lo``; each ends the day before the
    next anniversary (29 Feb -> 28 Feb in common years), capped at ``hi``.
    Starts are computed from ``lo`` (D15)."""
    return spark.sql(year_sql(lo, hi, years, tag))


def month_slices(spark: SparkSession, lo, hi, tag: str = "ACTIVE") -> DataFrame:
    """Calendar months; the first slice starts on the 1st of ``lo``'s month."""
    return spark.sql(month_sql(lo, hi, tag))


def week_slices(spark: SparkSession, lo, hi, tag: str = "ACTIVE") -> DataFrame:
    """7-day blocks anchored at ``lo`` (not ISO weeks), capped at ``hi``."""
    return spark.sql(week_sql(lo, hi, tag))


def day_slices(spark: SparkSession, lo, hi, tag: str = "ACTIVE") -> DataFrame:
    """One slice per day."""
    return spark.sql(day_sql(lo, hi, tag))


def _history_parts(tag: str) -> list[str]:
    parts = [year_sql(lo, hi, n, tag) for lo, hi, n in HISTORY_YEAR_RANGES]
    return parts + [month_sql(*HISTORY_MONTHS, tag=tag), week_sql(*HISTORY_WEEKS, tag=tag)]


def _recent_parts(today, tag: str) -> list[str]:
    return [week_sql(*RECENT_WEEKS, tag=tag), day_sql(*RECENT_DAYS, tag=tag),
            week_sql(RECENT_OPEN_WEEKS_FROM, today, tag=tag)]


def history_plan(spark: SparkSession, tag: str = "ACTIVE") -> DataFrame:
    """7 year slices, 311 month slices, 214 week slices (532)."""
    return spark.sql(" UNION ALL ".join(_history_parts(tag)))


def recent_plan(spark: SparkSession, today, tag: str = "ACTIVE") -> DataFrame:
    """Weeks 2019..2022-12-27, four days, then weeks from 2023-01-01 to ``today``."""
    return spark.sql(" UNION ALL ".join(_recent_parts(today, tag)))


def full_plan(spark: SparkSession, today, tags=("ACTIVE", "INACTIVE")) -> DataFrame:
    """History then recent, for each state tag."""
    return spark.sql(" UNION ALL ".join(p for t in tags for p in _history_parts(t) + _recent_parts(today, t)))


def class_plan(spark: SparkSession, n: int = CLASS_COUNT) -> DataFrame:
    """One slice per class code 1..n, named niza_{n}_1900_1900_ACTIVE,
    over the sentinel date (P11)."""
    return spark.range(1, n + 1).selectExpr(
        "concat('niza_', CAST(id AS STRING), '_1900_1900_ACTIVE') AS slice_id",
        f"{_date(CLASS_SENTINEL)} AS lo", f"{_date(CLASS_SENTINEL)} AS hi", "'ACTIVE' AS tag", "'class' AS kind",
        "CAST(id AS STRING) AS class_code")


def _bounded(df: DataFrame, limit: int = BROADCAST_LIMIT) -> DataFrame:
    """Broadcast hint only when the (small, generated) frame is proven small; results are the same either way."""
    return F.broadcast(df) if df.count() <= limit else df


def _binned(plan: DataFrame) -> DataFrame:
    """The plan with one row per month a slice covers."""
    return plan.selectExpr("slice_id", "lo AS _lo", "hi AS _hi", "tag AS _tag", "kind",
                           "explode(sequence(year(lo) * 12 + month(lo) - 1, year(hi) * 12 + month(hi) - 1)) AS _pbin")


def _month_bin(date_col: str):
    return F.expr(f"year(`{date_col}`) * 12 + month(`{date_col}`) - 1")


def _in_slice(date_col: str, tag_col: str | None):
    cond = f"_bin = _pbin AND `{date_col}` BETWEEN _lo AND _hi"
    return F.expr(cond if tag_col is None else f"{cond} AND `{tag_col}` = _tag")


def assign_slices(df: DataFrame, date_col: str, plan: DataFrame, tag_col: str | None = None,
                  limit: int = BROADCAST_LIMIT) -> DataFrame:
    """J7 (+ P10): attach ``slice_id``, ``kind`` of the slice holding each row's date.

    With ``tag_col`` the slice must also carry the row's state tag. Rows with
    a NULL date, or outside the plan, fall in no slice: ``outside_plan`` gives them.
    """
    rows = df.withColumn("_bin", _month_bin(date_col))
    plan_side = _bounded(_binned(plan), limit)
    return rows.join(plan_side, _in_slice(date_col, tag_col), "inner").drop("_bin", "_pbin", "_lo", "_hi", "_tag")


def date_range_rows(df: DataFrame, date_col: str, lo, hi, state_col: str | None = None,
                    state: str | None = None) -> DataFrame:
    """P10: rows whose date is in inclusive [lo, hi] (and in the given state); pushed to the scan."""
    out = df.filter(F.col(date_col).between(_d(lo), _d(hi)))
    if state_col is not None:
        out = out.filter(F.col(state_col) == F.lit(state))
    return out


def class_rows(df: DataFrame, class_col: str, code) -> DataFrame:
    """Rows of one class code."""
    return df.filter(F.col(class_col) == F.lit(str(code)))


def slice_counts(assigned: DataFrame, plan: DataFrame) -> DataFrame:
    """A5: rows per slice, zero for empty slices (plan left join counts)."""
    counts = assigned.groupBy("slice_id").agg(F.count(F.lit(1)).alias("n"))
    return (plan.select("slice_id", "kind").join(counts, "slice_id", "left")
            .select("slice_id", "kind", F.coalesce("n", F.lit(0)).alias("n")))


def slice_overflow(assigned: DataFrame, cap: int = SLICE_CAP) -> DataFrame:
    """A4: per non-empty slice its count and whether it reaches the cap (D6: numeric test)."""
    counts = assigned.groupBy("slice_id").agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("overflow", F.col("n") >= F.lit(cap))


def flag_overflow(assigned: DataFrame, cap: int = SLICE_CAP) -> DataFrame:
    """A4: every row with ``overflow``, true where its slice reaches the cap; no row is dropped.

    The counts hold one row per slice; AQE sends them to the rows when they are small.
    """
    return assigned.join(slice_overflow(assigned, cap).select("slice_id", "overflow"), "slice_id")


def outside_plan(df: DataFrame, date_col: str, plan: DataFrame, tag_col: str | None = None) -> DataFrame:
    """The rows ``assign_slices`` gives no slice: NULL date, or no slice of the plan (and tag) holds it."""
    binned = _binned(plan).drop("slice_id", "kind")
    rows = df.withColumn("_bin", _month_bin(date_col))
    return rows.join(_bounded(binned), _in_slice(date_col, tag_col), "left_anti").drop("_bin")


def pending_slices(plan: DataFrame, landed: DataFrame) -> DataFrame:
    """Planned slices with no landed output yet (matched on slice id)."""
    return plan.join(landed.select("slice_id").distinct(), "slice_id", "left_anti")
