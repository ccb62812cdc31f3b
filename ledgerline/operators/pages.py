"""Portal page extraction over a pages table.

The source system read each result grid cell through a browser. Here a
page is a row ``(page_id, html, ...)`` and extraction is a projection:
``regexp_extract_all`` splits rows and cells, ``posexplode`` yields one
row per grid line, and CSS ``nth-child(n)`` becomes ``try_element_at(cells, n)``
(both 1-based). No shuffle: every page is handled where it is read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.entities import html_unescape_all
from ledgerline.functions.text import BR_SPLIT, clean_text, coalesce_blank, dom_text, sql_lit, sql_strip
from ledgerline.operators.normalise import blank_row
from ledgerline.schemas import (
    COUNT_HEADER_ID, DETAIL_PANEL_ID, GRID_ID, HEADER_WITH_FILING, IMAGE_SUFFIX, NO_RESULT_ID,
    NOT_FOUND_ERROR, RAW_COLUMNS, SLICE_CAP, STATUS_LABELS,
)

FIRST_DATA_ROW = 2

GRID_RE = r'(?is)<table\b[^>]*\bid="' + GRID_ID + r'"[^>]*>(.*?)</table>'
PICTURE_RE = r"(?is)(<a\b[^>]*hlnkCasePicture_\d+[^>]*>)"
#: Lower-cased text without which a row has no picture.
PICTURE_MARK = "hlnkcasepicture_"
HREF_RE = r'(?is)\bhref="([^"]*)"'
TAG_RE = r"(?s)<[^>]*>"
#: A table that is not the grid and holds no further table (a pager in a cell).
NESTED_RE = (r'(?is)<table\b(?![^>]*\bid="' + GRID_ID + r'")[^>]*>(?:(?!</?table\b).)*+</table>')
PAGER_RE = r'(?is)<tr\b[^>]*\bclass="[^"]*gridview_pager[^"]*"[^>]*>.*?</tr>'
TABLE_TAG_RE = r"(?i)</?table\b"
TR = r"(?is)<tr\b[^>]*>(.*?)</tr>"
TD = r"(?is)<td\b[^>]*>(.*?)</td>"
TH = r"(?is)<th\b[^>]*>(.*?)</th>"


def _element_text(html: Column, element_id: str) -> Column:
    """Inner HTML of the first element with the given id ('' when absent)."""
    return F.regexp_extract(html, r'(?is)<(\w+)\b[^>]*\bid="' + element_id + r'"[^>]*>(.*?)</\1>', 2)


def _depth(html: str) -> str:
    """SQL: how deep tables nest in the page, by counting its table tags up and down."""
    return (f"aggregate(regexp_extract_all({html}, {sql_lit(TABLE_TAG_RE)}, 0), struct(0 AS now, 0 AS most), "
            "(s, t) -> struct(if(t LIKE '</%', greatest(s.now - 1, 0), s.now + 1) AS now, "
            "greatest(s.most, if(t LIKE '</%', 0, s.now + 1)) AS most), s -> s.most)")


def without_inner_tables(html: str) -> str:
    """SQL: the page without the tables nested in its grid's cells, however deep: innermost ones go first,
    one level a step, as many steps as the page has levels."""
    # As an array's element the depth is computed once, however often it is looked at.
    return (f"element_at(transform(array({_depth(html)}), d -> if(d < 2, {html}, aggregate(sequence(2, greatest(d, 2)), {html}, "
            f"(page, i) -> regexp_replace(page, {sql_lit(NESTED_RE)}, '')))), 1)")


def parse_result_rows(pages: DataFrame, html_col: str = "html", keep=("page_id",)) -> DataFrame:
    """X1 + X2 + P9: one row of RAW_COLUMNS per data line of each page's result grid.

    Data lines are the grid's own rows from the second on that have a second
    cell; a pager row (by class) is none, on top or at the foot, and rows of
    tables nested in its cells are not the grid's. When cell 6 of the first row
    with header cells reads 'Fecha de radicación' cells 6..11 are
    filing, expiration, status, holder, class, gazette; otherwise filing is
    '' and the rest start at cell 6. Fully blank rows are dropped. Pages
    without a grid give no rows. ``row_no`` is the 1-based grid row.

    Text cells are read as a browser's text content (tags dropped, entities
    decoded), then stripped, newline -> space and decoded again, as the
    crawler did; the holder cell is read as inner HTML and split on <br>.
    All cells of a line are decoded together, twice.
    """
    keep = [f"`{k}`" for k in keep]
    flat = without_inner_tables(f"`{html_col}`")
    # A pager row stays as an empty row, so the row numbers are the grid's.
    grid = f"regexp_replace(regexp_extract({flat}, {sql_lit(GRID_RE)}, 1), {sql_lit(PAGER_RE)}, '<tr></tr>')"
    trs = pages.selectExpr(*keep, f"regexp_extract_all({grid}, {sql_lit(TR)}, 1) AS _trs")
    head = f"try_element_at(filter(_trs, r -> r RLIKE {sql_lit(TH)}), 1)"
    th6 = f"try_element_at(regexp_extract_all({head}, {sql_lit(TH)}, 1), 6)"
    has_filing = F.coalesce(clean_text(F.expr(th6)).contains(HEADER_WITH_FILING), F.lit(False))
    # Rows without a second cell (pager, header) are skipped; no row number ends the grid.
    # Page-level values first: in the exploding select they would run per line. The outer form, because
    # the plain one tests the array's size below this select, which splits every page twice.
    # Cells are split inside the page's array, once; a filter on an exploded row would be a second split.
    split = (f"filter(transform(_trs, (r, i) -> struct(i AS _i, r AS _tr, regexp_extract_all(r, {sql_lit(TD)}, 1) AS _tds)), "
             f"x -> x._i + 1 >= {FIRST_DATA_ROW} AND size(x._tds) >= 2)")
    lines = (trs.select(*[F.col(k) for k in keep], "_trs", has_filing.alias("_has_filing"))
             .selectExpr(*keep, "_has_filing", f"inline_outer({split}) AS (_i, _tr, _tds)")
             .filter("_i IS NOT NULL")
             .selectExpr(*keep, "CAST(_i + 1 AS BIGINT) AS row_no", "_has_filing", "_tr", "_tds"))

    def cell(n: int) -> str:
        return f"coalesce(try_element_at(_tds, {n}), '')"

    def pick(with_filing: int, without: int) -> str:
        return f"CASE WHEN _has_filing THEN {cell(with_filing)} ELSE {cell(without)} END"

    # Text cells in output order; slot 3 is the filing date ('' without that column).
    text_cells = [cell(2), cell(3), cell(4), f"CASE WHEN _has_filing THEN {cell(6)} ELSE '' END",
                  pick(7, 6), pick(8, 7), pick(10, 9), pick(11, 10)]
    text_names = ["request_number", "registry_number", "denomination", "filing_date",
                  "expiration_date", "status", "niza_class", "gazette_number"]
    n = len(text_cells)
    anchor = f"if(contains(lower(_tr), {sql_lit(PICTURE_MARK)}), regexp_extract(_tr, {sql_lit(PICTURE_RE)}, 1), '')"
    href = f"regexp_extract({anchor}, {sql_lit(HREF_RE)}, 1)"
    tags = f"transform(array({', '.join(text_cells)}), c -> if(contains(c, '<'), regexp_replace(c, {sql_lit(TAG_RE)}, ''), c))"
    crawler = "replace(" + sql_strip("{x}") + ", '\\n', ' ')"
    # Pass 1: text content as the DOM gives it (and the anchor attribute).
    step = lines.select(*[F.col(k) for k in keep], "row_no",
                        html_unescape_all(F.expr(f"concat({tags}, array({href}))")).alias("_dom"),
                        F.expr(crawler.format(x=pick(9, 8))).alias("_hol"))
    # Pass 2: the crawler's strip / newline / unescape, holder included.
    second = (f"concat(transform(slice(_dom, 1, {n}), x -> {crawler.format(x='x')}), array(_hol))")
    # One element, exploded: the blank-row filter is not pushed below it, which would decode once per column.
    step = step.select(*[F.col(k) for k in keep], "row_no", F.expr(f"_dom[{n}]").alias("_href"),
                       F.explode(F.array(html_unescape_all(F.expr(second)))).alias("_txt"))
    br = sql_lit(BR_SPLIT)
    hol = f"_txt[{n}]"
    holder = (f"CASE WHEN coalesce({hol}, '') = '' THEN CAST(array() AS ARRAY<STRING>) "
              f"WHEN {hol} RLIKE {br} THEN transform(split({hol}, {br}, -1), p -> {sql_strip('p')}) "
              f"ELSE array({hol}) END")
    out = step.selectExpr(
        *keep, "row_no",
        *[f"coalesce(_txt[{i}], '') AS {name}" for i, name in enumerate(text_names)],
        f"CASE WHEN coalesce(_href, '') <> '' THEN concat(_href, {sql_lit(IMAGE_SUFFIX)}) ELSE '' END AS logo_url",
        f"{holder} AS holder")
    return out.select(*[F.col(k) for k in keep], "row_no", *RAW_COLUMNS).filter(~blank_row(RAW_COLUMNS))


def result_count(pages: DataFrame, html_col: str = "html", cap: int = SLICE_CAP) -> DataFrame:
    """The result-count header as a number and the overflow flag (D6: numeric)."""
    text = clean_text(_element_text(F.col(html_col), COUNT_HEADER_ID))
    n = F.nullif(F.regexp_replace(F.regexp_extract(text, r"(\d[\d.,]*)", 1), r"[.,]", ""),
                 F.lit("")).try_cast("bigint")
    return pages.withColumn("result_count", n).withColumn(
        "overflow", F.coalesce(F.col("result_count") >= F.lit(cap), F.lit(False)))


def detail_status(pages: DataFrame, key_col: str = "request_number", html_col: str = "html",
                  labels=STATUS_LABELS, keep=()) -> DataFrame:
    """X4 + F17: (request_number, extracted_status, error) from a detail page.

    The first non-blank status label wins; with none, the status is '' and
    the error says so.
    """
    html = F.col(html_col)
    found = coalesce_blank(*[dom_text(_element_text(html, lab)) for lab in labels])
    read = pages.select(*keep, F.col(key_col).alias("request_number"), F.coalesce(found, F.lit("")).alias("extracted_status"))
    return read.withColumn("error", F.when(F.col("extracted_status") == "", F.lit(NOT_FOUND_ERROR)))


def classify_page(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """Listing / detail / no_result / unknown by the marker element present."""
    html = F.col(html_col)

    def has(element_id: str) -> Column:
        return html.rlike(r'\bid="' + element_id + '"')

    kind = (F.when(has(COUNT_HEADER_ID), F.lit("listing"))
            .when(has(DETAIL_PANEL_ID), F.lit("detail"))
            .when(has(NO_RESULT_ID), F.lit("no_result"))
            .otherwise(F.lit("unknown")))
    return pages.withColumn("kind", kind)


def page_title(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """F9 on the page title element (text content, cleaned)."""
    t = F.regexp_extract(F.col(html_col), r"(?is)<title\b[^>]*>(.*?)</title>", 1)
    return pages.withColumn("title", clean_text(t))
