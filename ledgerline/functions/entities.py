"""HTML entity decoding inside the JVM: a text becomes tokens, each is looked up, and they are joined again.

The names come from Python's own HTML5 table. A token is a stretch without
``&``, a reference, or an ``&`` that starts none. Rules, as HTML5 parsers and
``html.unescape`` have them: a name without ``;`` counts if it is one of the
old names or begins with one; control characters 128-159 are read as
Windows-1252; code points that are no characters give nothing or U+FFFD.
"""

from __future__ import annotations

import html
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

REFERENCE = r"&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\t\n\f <&#;]{1,32};?)"
TOKENS = REFERENCE + "|[^&]+|&"
NOT_A_CHARACTER = "�"
#: Control characters end here; the exceptions among them are taken from the rule.
CONTROL_END = 0xA0
BEYOND = 0x110000
_PAIR, _VALUE = "\x01", "\x02"

#: Names that count without ';'. Only these can be the beginning of a longer name.
_OLD = {k: v for k, v in html5.items() if not k.endswith(";")}
#: The old names' own forms first: a lookup goes through the list in order.
_NAMES = _OLD | {k + ";": html5[k + ";"] for k in _OLD} | html5
_BEGIN = "^(?:" + "|".join(sorted(_OLD, key=len, reverse=True)) + ")"
_CONTROLS = {str(n): v for n in range(CONTROL_END) if (v := html.unescape(f"&#{n};")) != chr(n)}


def _table(entries: dict[str, str]) -> Column:
    """A constant map; neither names nor values hold the two delimiters."""
    return F.str_to_map(F.lit(_PAIR.join(k + _VALUE + v for k, v in entries.items())), F.lit(_PAIR), F.lit(_VALUE))


def code_point(n: Column) -> Column:
    """The character of a code point (as UTF-8 bytes; ``char`` stops at 255)."""
    n = n.cast("bigint")
    low = F.lit(0x80) + n.bitwiseAND(F.lit(63))
    mid = F.lit(0x8000) + F.shiftleft(F.shiftright(n, 6).bitwiseAND(F.lit(63)), 8)
    high = F.lit(0x800000) + F.shiftleft(F.shiftright(n, 12).bitwiseAND(F.lit(63)), 16)
    raw = (F.when(n < 0x80, n)
           .when(n < 0x800, F.lit(0xC000) + F.shiftleft(F.shiftright(n, 6), 8) + low)
           .when(n < 0x10000, F.lit(0xE00000) + F.shiftleft(F.shiftright(n, 12), 16) + mid + low)
           .otherwise(F.lit(0xF0000000) + F.shiftleft(F.shiftright(n, 18), 24) + high + mid + low))
    return F.unhex(F.hex(raw)).cast("string")


def _number(digits: Column, base: int, most: int) -> Column:
    """Value of a run of digits; more than ``most`` after leading zeros lie beyond all code points."""
    digits = F.ltrim(digits, F.lit("0"))
    value = F.conv(F.concat(F.lit("0"), digits), base, 10).cast("bigint")
    return F.when(F.length(digits) > most, F.lit(BEYOND)).otherwise(value)


def _by_number(token: Column) -> Column:
    body = F.rtrim(F.substr(token, F.lit(3)), F.lit(";"))
    n = F.when(F.lower(F.left(body, F.lit(1))) == "x", _number(F.substr(body, F.lit(2)), 16, 6)).otherwise(_number(body, 10, 7))
    end = n.bitwiseAND(F.lit(0xFFFE))
    return (F.when(n < CONTROL_END, F.coalesce(F.try_element_at(_table(_CONTROLS), n.cast("string")), code_point(n)))
            .when((n >= BEYOND) | n.between(0xD800, 0xDFFF), F.lit(NOT_A_CHARACTER))
            .when((end == 0xFFFE) | n.between(0xFDD0, 0xFDEF), F.lit(""))
            .otherwise(code_point(n)))


def _by_name(token: Column) -> Column:
    name, names = F.substr(token, F.lit(2)), _table(_NAMES)
    begin = F.regexp_extract(name, _BEGIN, 0)
    return F.coalesce(F.try_element_at(names, name),
                      F.concat(F.try_element_at(names, begin), F.substr(name, F.length(begin) + 1)), token)


def _decoded(token: Column) -> Column:
    return (F.when(~F.startswith(token, F.lit("&")) | (F.length(token) == 1), token)
            .when(F.startswith(token, F.lit("&#")), _by_number(token))
            .otherwise(_by_name(token)))


def _text(c: Column) -> Column:
    return F.array_join(F.transform(F.regexp_extract_all(c, F.lit(TOKENS), F.lit(0)), _decoded), "")


def html_unescape_all(arr: Column | str) -> Column:
    """Entity decoding of every element of an ARRAY<STRING> by the rules of HTML5; null stays null."""
    arr = F.col(arr) if isinstance(arr, str) else arr
    # A text whose every & starts no reference stays as it is; the plain search for & is the cheap test.
    return F.transform(arr, lambda c: F.when(F.contains(c, F.lit("&")) & F.rlike(c, F.lit(REFERENCE)), _text(c)).otherwise(c))


def html_unescape(c: Column | str) -> Column:
    """Entity decoding of one text; as an array's element it is computed once, however often it is looked at."""
    return F.get(html_unescape_all(F.array(c)), F.lit(0))
