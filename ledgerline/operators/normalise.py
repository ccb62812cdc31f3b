"""Raw record -> normalised record.

Raw input is either typed columns (RAW_COLUMNS as STRING, ``holder`` as
ARRAY<STRING>) or one VARIANT column per record, as produced by
``sources.snapshots``. ``raw_from_variant`` turns the second into the
first, keeping the difference between an absent key ('' for the text
fields) and an explicit JSON null (NULL).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.codes import sql_logo_asset, sql_map_status
from ledgerline.functions.dates import bad_date, sql_parse_es_date
from ledgerline.functions.text import sql_lit, sql_normalise_holder
from ledgerline.schemas import (
    BLANK_WHEN_ABSENT, COUNTRY, DEFAULT_LOGO_PREFIX, KEY, MONTHS_ES, NORMALISED_COLUMNS,
    RAW_COLUMNS, STATUS_RAW,
)


def _vget(rec: Column, field: str, typ: str) -> Column:
    return F.try_variant_get(rec, f"$.{field}", typ)


def _absent(rec: Column, field: str) -> Column:
    # A JSON null is a variant null, not SQL NULL: only a missing key is NULL here.
    return _vget(rec, field, "variant").isNull()


def is_record(rec) -> Column:
    """A JSON object element (anything else is rejected whole, D10)."""
    rec = F.col(rec) if isinstance(rec, str) else rec
    return F.try_variant_get(rec, "$", "struct<>").isNotNull()


def raw_from_variant(df: DataFrame, rec: str = "rec") -> DataFrame:
    """VARIANT record -> typed raw columns, other columns passed through.

    ``holder`` may be a string or an array of strings; both become an array
    (a missing, null or empty holder becomes an empty array).
    """
    r = F.col(rec)
    holder_v = _vget(r, "holder", "variant")
    holder_is_array = F.try_variant_get(holder_v, "$", "array<variant>").isNotNull()
    holder_text = _vget(r, "holder", "string")
    holder = (F.when(holder_is_array, F.coalesce(_vget(r, "holder", "array<string>"),
                                                   F.array().cast("array<string>")))
              .when(F.coalesce(holder_text, F.lit("")) != "", F.array(holder_text))
              .otherwise(F.array().cast("array<string>")))
    cols = []
    for c in RAW_COLUMNS:
        if c == "holder":
            cols.append(holder.alias(c))
        elif c in BLANK_WHEN_ABSENT:
            cols.append(F.when(_absent(r, c), F.lit("")).otherwise(_vget(r, c, "string")).alias(c))
        else:
            cols.append(_vget(r, c, "string").alias(c))
    keep = [c for c in df.columns if c != rec]
    return df.select(*keep, *cols)


def has_key(key: str = KEY) -> Column:
    """The key is present and not empty."""
    return F.coalesce(F.col(key), F.lit("")) != ""


def normalise(raw: DataFrame, run_ts, country: str = COUNTRY, logo_prefix: str = DEFAULT_LOGO_PREFIX,
              months: dict[str, str] = MONTHS_ES, status_map: dict[str, str] = STATUS_RAW,
              key: str = KEY) -> DataFrame:
    """P1 + P2: drop keyless records, build the 13 normalised columns.

    ``run_ts`` is the run's timestamp (literal or column); other columns of
    ``raw`` (batch ids, positions) are passed through in front.
    """
    # Built as SQL text: one expression per column, one call into the JVM each.
    ts = run_ts if isinstance(run_ts, Column) else None
    out = {
        "request_number": f"`{key}`",
        "registry_number": "registry_number",
        "denomination": "denomination",
        "logo_url": "logo_url",
        "logo": sql_logo_asset(f"`{key}`", "logo_url", logo_prefix),
        "filing_date": sql_parse_es_date("filing_date", months),
        "expiration_date": sql_parse_es_date("expiration_date", months),
        "status": sql_map_status("status", status_map),
        "holder": sql_normalise_holder("holder"),
        "niza_class": "niza_class",
        "gazette_number": "gazette_number",
        "updated_at": "NULL" if ts is not None else f"CAST({sql_lit(str(run_ts))} AS TIMESTAMP)",
        "badger_country": sql_lit(country),
    }
    passthrough = [f"`{c}`" for c in raw.columns if c not in RAW_COLUMNS]
    out_df = (raw.filter(f"coalesce(`{key}`, '') <> ''")
              .selectExpr(*passthrough, *[f"{out[c]} AS `{c}`" for c in NORMALISED_COLUMNS]))
    return out_df.withColumn("updated_at", ts) if ts is not None else out_df


def blank_row(cols=RAW_COLUMNS) -> Column:
    """Every extracted field is falsy ('' / NULL / empty array)."""
    parts = []
    for c in cols:
        parts.append(F.when(F.coalesce(F.size(F.col(c)), F.lit(0)) > 0, F.lit("x")) if c == "holder"
                     else F.nullif(F.col(c), F.lit("")))
    return F.coalesce(*parts).isNull()


REJECT_COLUMNS = ["source", "batch_id", "pos", "request_number", "column", "raw_value", "reason"]


def reject_missing_key(raw: DataFrame, source: str = "snapshot", key: str = KEY) -> DataFrame:
    """Q1: records without a key, as reject rows."""
    return (raw.filter(~has_key(key))
            .select(F.lit(source).alias("source"), _opt(raw, "batch_id", "string"), _opt(raw, "pos", "bigint"),
                    F.col(key).alias("request_number"), F.lit(key).alias("column"),
                    F.col(key).alias("raw_value"), F.lit("missing key").alias("reason")))


def reject_bad_dates(raw: DataFrame, source: str = "snapshot", months: dict[str, str] = MONTHS_ES,
                     key: str = KEY) -> DataFrame:
    """Q2: non-empty date text that did not parse (the value becomes NULL, the row is kept)."""
    base = raw.filter(has_key(key))
    parts = []
    for c in ("filing_date", "expiration_date"):
        parts.append(base.filter(bad_date(c, months)).select(
            F.lit(source).alias("source"), _opt(base, "batch_id", "string"), _opt(base, "pos", "bigint"),
            F.col(key).alias("request_number"), F.lit(c).alias("column"), F.col(c).alias("raw_value"),
            F.lit("bad date").alias("reason")))
    return parts[0].unionByName(parts[1])


def _opt(df: DataFrame, name: str, typ: str) -> Column:
    return (F.col(name) if name in df.columns else F.lit(None)).cast(typ).alias(name)


def align_columns(df: DataFrame, cols) -> DataFrame:
    """Keep the listed columns that exist, in list order (schema-only, no data pass)."""
    have = set(df.columns)
    return df.select(*[c for c in cols if c in have])


def common_columns(left: DataFrame, right: DataFrame, exclude=(KEY,)) -> list[str]:
    """Ordered intersection of two schemas (left order), minus ``exclude``."""
    other = set(right.columns)
    return [c for c in left.columns if c in other and c not in exclude]
