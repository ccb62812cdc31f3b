"""Date scalars: Spanish portal dates, strict ISO coercion, dd/MM/yyyy."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerline.schemas import MONTHS_ES
from ledgerline.functions.text import _col
from ledgerline.functions.codes import map_literal

ISO_DATE = r"^\d{4}-\d{2}-\d{2}$"


def es_date_text(c, months: dict[str, str] = MONTHS_ES) -> Column:
    """'d mmm. yyyy' -> 'yyyy-MM-dd' text, NULL when it does not parse.

    Split on a single space must give exactly three parts; the month is
    looked up lower-cased; the day is zero-padded to two characters (longer
    days are kept as they are, like str.zfill).
    """
    c = _col(c)
    parts = F.split(c, " ", -1)
    day = parts.getItem(0)
    month = F.try_element_at(map_literal(months), F.lower(parts.getItem(1)))
    year = parts.getItem(2)
    padded = F.when(F.length(day) < 2, F.lpad(day, 2, "0")).otherwise(day)
    return (F.when(non_falsy(c) & (F.size(parts) == 3) & month.isNotNull(),
                   F.concat_ws("-", year, month, padded)))


def sql_parse_es_date(expr: str, months: dict[str, str] = MONTHS_ES) -> str:
    """SQL text of ``parse_es_date``: exactly three space-separated parts, month
    looked up lower-cased, day zero-padded to two (longer days kept), then a
    strict 'yyyy-MM-dd' calendar date."""
    from ledgerline.functions.codes import sql_map
    parts = f"split({expr}, ' ', -1)"
    day = f"try_element_at({parts}, 1)"
    iso = (f"CASE WHEN size({parts}) = 3 THEN concat(try_element_at({parts}, 3), '-', "
           f"try_element_at({sql_map(months)}, lower(try_element_at({parts}, 2))), '-', "
           f"lpad({day}, greatest(length({day}), 2), '0')) END")
    return f"try_to_date(regexp_extract({iso}, '^([0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}})$', 1), 'yyyy-MM-dd')"


def sql_bad_date(expr: str, months: dict[str, str] = MONTHS_ES) -> str:
    return f"(coalesce({expr}, '') <> '' AND {sql_parse_es_date(expr, months)} IS NULL)"


def non_falsy(c) -> Column:
    return F.coalesce(_col(c), F.lit("")) != ""


def coerce_date(text) -> Column:
    """strict 'yyyy-MM-dd' text -> DATE; anything else (bad calendar day,
    two-digit year, padded day) -> NULL (D1)."""
    t = _col(text)
    return F.when(t.rlike(ISO_DATE), F.try_to_date(t, "yyyy-MM-dd"))


def parse_es_date(c, months: dict[str, str] = MONTHS_ES) -> Column:
    """F1 + F2: portal date text -> DATE."""
    if isinstance(c, str):
        return F.expr(sql_parse_es_date(c, months))
    return coerce_date(es_date_text(c, months))


def bad_date(c, months: dict[str, str] = MONTHS_ES) -> Column:
    """Q2: a non-empty raw value that did not give a date."""
    if isinstance(c, str):
        return F.expr(sql_bad_date(c, months))
    return non_falsy(c) & parse_es_date(c, months).isNull()


def parse_dmy(c) -> Column:
    """F16: 'dd/MM/yyyy' -> DATE."""
    return F.try_to_date(_col(c), "dd/MM/yyyy")


def format_dmy(c, sep: str = "/") -> Column:
    """F16: DATE -> 'dd/MM/yyyy' (or with another separator)."""
    return F.date_format(_col(c), f"dd{sep}MM{sep}yyyy")
