"""Page extraction cases (FIXTURES §7)."""

from ledgerline.operators import pages

GRID = "MainContent_ctrlTMSearch_ctrlProcList_gvwIPCases"


def _page(header6, rows):
    ths = "".join(f"<th>{h}</th>" for h in ["#", "Exp", "Reg", "Signo", "Logo", header6, "a", "b", "c", "d", "e"])
    trs = "".join("<tr>" + "".join(f"<td>{c}</td>" for c in r) + "</tr>" for r in rows)
    return (f'<html><table id="{GRID}"><tbody><tr>{ths}</tr>{trs}'
            f'<tr class="gridview_pager"><td colspan="11">1</td></tr></tbody></table></html>')


def test_result_rows_both_layouts(spark):
    logo = f'<a id="{GRID}_hlnkCasePicture_0" href="http://i?a=1&amp;b=2">x</a>'
    a = _page("Fecha de radicación", [["1", "SD1", "R1", "X &amp; Y", logo, "5 ene. 2020", "5 ene. 2030",
                                        "Registrada", "A<br>B", "35", "900"],
                                       ["2", "", "", "", "", "", "", "", "", "", ""]])
    b = _page("Fecha de vencimiento", [["1", " SD2\n", "R2", "Z", "", "5 ene. 2030", "Negada", "C", "9", "1"]])
    df = spark.createDataFrame([(1, a), (2, b), (3, "<html>no grid</html>")], "page_id int, html string")
    rows = {r.request_number: r for r in pages.parse_result_rows(df).collect()}
    assert set(rows) == {"SD1", "SD2"}
    r1, r2 = rows["SD1"], rows["SD2"]
    assert (r1.filing_date, r1.denomination, r1.holder, r1.niza_class, r1.gazette_number) == \
        ("5 ene. 2020", "X & Y", ["A", "B"], "35", "900")
    assert r1.logo_url == "http://i?a=1&b=2&fmt=jpeg" and r1.row_no == 2
    assert (r2.filing_date, r2.expiration_date, r2.status, r2.holder, r2.niza_class) == \
        ("", "5 ene. 2030", "Negada", ["C"], "9")


def test_detail_status(spark):
    tm = '<span id="MainContent_ctrlTM_lblCurrentStatus">{}</span>'
    ird = '<span id="MainContent_ctrlIRD_lblCurrentStatus">{}</span>'
    df = spark.createDataFrame([("A", tm.format("  ") + ird.format(" Negada ")), ("B", tm.format("Vigente")),
                                ("C", "<p>none</p>")], "request_number string, html string")
    got = {r.request_number: (r.extracted_status, r.error) for r in pages.detail_status(df).collect()}
    assert got == {"A": ("Negada", None), "B": ("Vigente", None), "C": ("", "Status not found on results page.")}


def test_classify_and_count(spark):
    df = spark.createDataFrame([
        (1, '<span id="MainContent_ctrlTMSearch_ctrlProcList_hdrNbItems">12000 resultados</span>'),
        (2, '<div id="MainContent_ctrlTM_panelCaseData"></div>'),
        (3, '<div id="MainContent_ctrlTMSearch_divHelp"></div>'),
        (4, "<p>x</p>")], "page_id int, html string")
    out = {r.page_id: (r.kind, r.result_count, r.overflow)
           for r in pages.result_count(pages.classify_page(df)).collect()}
    assert out == {1: ("listing", 12000, True), 2: ("detail", None, False), 3: ("no_result", None, False),
                   4: ("unknown", None, False)}


def test_nested_pager_and_long_grid(spark):
    pager = ('<tr class="gridview_pager"><td colspan="11"><table><tr><td><span>1</span></td><td><a href="#">2</a></td>'
             '<td><a href="#">3</a></td></tr></table></td></tr>')
    cells = [[str(i), f"SD{i}", "R", "Z", "", "5 ene. 2030", "Negada", "C", "9", "1"] for i in range(300)]
    page = _page("Fecha de vencimiento", cells)
    top = page.replace("<tbody>", "<tbody>" + pager)
    foot = page.replace("</tbody>", pager + "</tbody>")
    layout = "<table><tr><td>menu</td><td>x</td></tr><tr><td>" + foot + "</td></tr></table>"
    df = spark.createDataFrame([("top", top), ("foot", foot), ("layout", layout)], "page_id string, html string")
    got = pages.parse_result_rows(df).select("page_id", "request_number").collect()
    for p in ("top", "foot", "layout"):
        assert sorted(r[1] for r in got if r[0] == p) == sorted(f"SD{i}" for i in range(300))


def test_tables_nested_to_any_depth(spark):
    """Rows of tables in cells are not the grid's, at whatever depth, in text cells and pagers alike."""
    from ledgerline.operators.pages import GRID_ID, parse_result_rows, without_inner_tables

    def nested(depth):
        return "<table><tr><td>x</td><td>y</td></tr><tr><td>a</td><td>" * depth + "<table id='n'></table>" + "</td></tr></table>" * depth

    for depth in (0, 1, 3, 5, 12):
        grid = (f'<table id="{GRID_ID}"><tr><th>h</th></tr><tr><td>1</td><td>K1{nested(depth)}</td></tr>'
                f'<tr class="gridview_pager"><td>{nested(depth)}</td></tr><tr><td>2</td><td>K2</td></tr></table>')
        page = f"<html><table><tr><td><TABLE class='l'><tr><td>{grid}</td></tr></TABLE></td></tr></table><table><tr><td>after</td></tr></table></html>"
        rows = parse_result_rows(spark.createDataFrame([("p", page)], "page_id string, html string")).collect()
        assert [(r.row_no, r.request_number) for r in sorted(rows, key=lambda r: r.row_no)] == [(2, "K1"), (4, "K2")], depth
    odd = [("",), (None,), ("</table></table><table>",), ("no tables",)]
    got = spark.createDataFrame(odd, "h string").selectExpr(f"{without_inner_tables('h')} AS v").collect()
    assert [r.v for r in got] == ["", None, "</table></table><table>", "no tables"]


def test_cells_are_split_once(spark):
    """a line's cells are split in one place of the plan, and a page is only searched for tables' depth once."""
    from ledgerline.operators.pages import TABLE_TAG_RE, TD, parse_result_rows

    plan = parse_result_rows(spark.createDataFrame([("p", "x")], "page_id string, html string"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count(TD) == 1 and plan.count(TABLE_TAG_RE) == 1
