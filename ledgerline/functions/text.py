"""Text scalars: whitespace handling, holder names, change comparison, HTML cells.

All are JVM expressions; HTML entities are decoded by ``functions/entities.py``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerline.functions.entities import html_unescape

# Whitespace as Python's str.isspace() defines it (str.strip/str.split use
# the same set): derived from the rule, not listed by hand. Java's \s
# misses most of it, and (?U)\s misses U+001C..U+001F.
PY_SPACE = "".join(chr(i) for i in range(0x110000) if chr(i).isspace())
WS_CLASS = "[" + "".join(f"\\x{{{ord(ch):x}}}" for ch in PY_SPACE) + "]"
WS_RUN = WS_CLASS + "+"
SQL_SPACE = "'" + "".join(f"\\u{ord(ch):04x}" for ch in PY_SPACE) + "'"  # SQL literal of the set


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def py_strip(c) -> Column:
    """Python ``str.strip()``: remove leading/trailing whitespace (character-set trim, no regex)."""
    return F.trim(_col(c), F.lit(PY_SPACE))


def sql_lit(s: str) -> str:
    """A SQL string literal holding ``s`` exactly."""
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def sql_normalise_holder(expr: str) -> str:
    """SQL text of ``normalise_holder`` over an ARRAY<STRING> expression."""
    name = f"upper(trim(regexp_replace(replace(n, ';', ','), {sql_lit(WS_RUN)}, ' ')))"
    return f"coalesce(concat_ws('; ', transform({expr}, n -> {name})), '')"


def sql_strip(expr: str) -> str:
    """SQL text of ``py_strip`` over a SQL expression."""
    return f"trim(BOTH {SQL_SPACE} FROM {expr})"


def sql_compare_key(expr: str) -> str:
    """SQL text of ``compare_key``."""
    return sql_strip(f"coalesce(CAST({expr} AS STRING), '')")


def collapse_ws(c) -> Column:
    """Replace every run of Unicode whitespace by one ASCII space."""
    return F.regexp_replace(_col(c), WS_RUN, " ")


def compare_key(c) -> Column:
    """the text a value is compared by: ``str(v or '').strip()``.

    Null and '' are the same; outer whitespace is ignored; case and inner
    whitespace are significant. Non-string columns are cast to text first.
    """
    if isinstance(c, str):
        return F.expr(sql_compare_key(c))
    return py_strip(F.coalesce(c.cast("string"), F.lit("")))


def normalise_name(c) -> Column:
    """One holder name: ';' -> ',', whitespace runs -> ' ', strip, upper."""
    return F.upper(F.trim(collapse_ws(F.replace(_col(c), F.lit(";"), F.lit(",")))))


def normalise_holder(names) -> Column:
    """F3 over an ARRAY<STRING> of names (a scalar holder is a 1-element array).

    A null or empty array gives ''. Null names are skipped (D10).
    """
    if isinstance(names, str):
        return F.expr(sql_normalise_holder(names))
    arr = _col(names)
    return F.coalesce(F.concat_ws("; ", F.transform(arr, normalise_name)), F.lit(""))


def non_blank(c) -> Column:
    """NULL for null or '' (Python falsiness of a string)."""
    return F.nullif(_col(c), F.lit(""))


def coalesce_blank(*cols) -> Column:
    """first value that is non-blank after stripping, itself stripped."""
    return F.coalesce(*[F.nullif(py_strip(_col(c)), F.lit("")) for c in cols])


def strip_tags(c) -> Column:
    """Text content of an HTML fragment: all tags removed."""
    return F.regexp_replace(_col(c), r"(?s)<[^>]*>", "")


def clean_text(c) -> Column:
    """F9 on a cell read as text: tags dropped, entities decoded (by the DOM),
    strip, newline -> space, then decoded once more as the crawler did; '' when
    nothing is left."""
    c = _col(c)
    dom_text = html_unescape(strip_tags(c))
    return F.coalesce(html_unescape(F.replace(py_strip(dom_text), F.lit("\n"), F.lit(" "))), F.lit(""))


def dom_text(c) -> Column:
    """Text content of an element as a browser returns it, stripped:
    tags dropped, entities decoded once."""
    return py_strip(html_unescape(strip_tags(_col(c))))


BR_SPLIT = r"(?i)<br\s*/?>"
