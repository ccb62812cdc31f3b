"""Code-table lookups and derived identifiers.

Code tables are a dozen entries, so they become constant-folded map
literals rather than broadcast joins.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerline.schemas import DEFAULT_LOGO_PREFIX, STATUS_CORRECTION, STATUS_RAW


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def map_literal(mapping: dict[str, str]) -> Column:
    items = []
    for k, v in mapping.items():
        items += [F.lit(k), F.lit(v)]
    return F.create_map(*items)


def sql_map(mapping: dict[str, str]) -> str:
    """SQL text of a map literal."""
    from ledgerline.functions.text import sql_lit
    return "map(" + ", ".join(f"{sql_lit(k)}, {sql_lit(v)}" for k, v in mapping.items()) + ")"


def sql_map_status(expr: str, mapping: dict[str, str] = STATUS_RAW) -> str:
    return f"coalesce(try_element_at({sql_map(mapping)}, lower({expr})), {expr})"


def sql_map_correction_status(expr: str, mapping: dict[str, str] = STATUS_CORRECTION) -> str:
    return f"try_element_at({sql_map(mapping)}, upper({expr}))"


def sql_logo_asset(key: str, logo_url: str, prefix: str = DEFAULT_LOGO_PREFIX) -> str:
    from ledgerline.functions.text import sql_lit
    return (f"CASE WHEN coalesce({logo_url}, '') <> '' THEN concat({sql_lit(prefix)}, replace({key}, '/', '_'), "
            f"'.jpeg') ELSE '' END")


def map_status(c, mapping: dict[str, str] = STATUS_RAW) -> Column:
    """lower-cased lookup, the original value when unmapped; no trim."""
    if isinstance(c, str):
        return F.expr(sql_map_status(c, mapping))
    c = _col(c)
    return F.coalesce(F.try_element_at(map_literal(mapping), F.lower(c)), c)


def map_correction_status(c, mapping: dict[str, str] = STATUS_CORRECTION) -> Column:
    """upper-cased lookup; NULL when unmapped (caller drops and reports)."""
    if isinstance(c, str):
        return F.expr(sql_map_correction_status(c, mapping))
    return F.try_element_at(map_literal(mapping), F.upper(_col(c)))


def logo_asset(key, logo_url, prefix: str = DEFAULT_LOGO_PREFIX) -> Column:
    """prefix + key with '/' -> '_' + '.jpeg' when logo_url is non-empty."""
    if isinstance(key, str) and isinstance(logo_url, str):
        return F.expr(sql_logo_asset(key, logo_url, prefix))
    return (F.when(F.coalesce(_col(logo_url), F.lit("")) != "",
                   F.concat(F.lit(prefix), F.replace(_col(key), F.lit("/"), F.lit("_")), F.lit(".jpeg")))
            .otherwise(F.lit("")))


def normalise_state(c) -> Column:
    """'active' (after strip + lower) or 'inactive' for anything else."""
    from ledgerline.functions.text import py_strip

    s = F.lower(py_strip(c))
    return F.when(s == "active", F.lit("active")).otherwise(F.lit("inactive"))


def state_tag(c) -> Column:
    """F12 tag used in slice names."""
    return F.when(normalise_state(c) == "active", F.lit("ACTIVE")).otherwise(F.lit("INACTIVE"))


def state_index(c) -> Column:
    """F12 radio-button index: '0' active, '1' inactive."""
    return F.when(normalise_state(c) == "active", F.lit("0")).otherwise(F.lit("1"))


def sql_surrogate_id(*exprs: str) -> str:
    """SQL text of ``surrogate_id``."""
    parts = ", ".join(f"coalesce(CAST({e} AS STRING), '')" for e in exprs)
    h = f"sha2(concat_ws('\\u0001', {parts}), 256)"
    return (f"concat_ws('-', substring({h}, 1, 8), substring({h}, 9, 4), substring({h}, 13, 4), "
            f"substring({h}, 17, 4), substring({h}, 21, 12))")


def surrogate_id(*cols) -> Column:
    """Deterministic row id from the natural key, so a retried task
    writes the same id. UUID-shaped text from a SHA-256 of the parts."""
    h = F.sha2(F.concat_ws("\u0001", *[F.coalesce(_col(c).cast("string"), F.lit("")) for c in cols]), 256)
    return F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.substring(h, 13, 4),
                       F.substring(h, 17, 4), F.substring(h, 21, 12))
