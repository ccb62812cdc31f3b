"""Registry-shaped inputs derived from the driver tables.

The driver tables are TPC-H-like, so the registry workloads run on data
derived from them by Spark, growing with them:

* ``registry_from_orders`` (R): one registry row per order (orders joined to
  customer), country COLOMBIA, except priority 1-URGENT orders (those arrive
  as new keys); priority 2-HIGH orders get a second row in ECUADOR (D4),
  priority 3-MEDIUM finished orders a duplicate row (W4).
* ``snapshot_from_orders`` (N): the portal view of every order except
  priority 5-LOW (registry-only keys), as raw text: Spanish dates, raw status
  words, holder arrays with padding and case noise, a few real changes.
* ``versions_from_events`` (V): per user and day a version of two columns.

The DuckDB oracle in ``plans.oracle`` restates these rules in SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.functions.codes import sql_logo_asset
from ledgerline.schemas import DEFAULT_LOGO_PREFIX, MONTHS_ES, RAW_COLUMNS
from ledgerline.session import table_path

MONTH_WORDS = list(MONTHS_ES)  # ene. .. dic. in calendar order
REGISTRY_TS = "2024-01-01 00:00:00"
RUN_TS = "2024-06-30 12:00:00"
TODAY = "2026-12-03"
IMG_PREFIX = "https://img.invalid/"


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


_SPLITS: dict[str, int] = {}


def load_spread(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    """Scan with pruned columns, spread over the cores when the file has too few splits.

    The split count of a table file is looked up once per session and path
    (it only steers parallelism)."""
    df = load(spark, sf_dir, name)
    df = df.select(*cols) if cols else df
    path = table_path(sf_dir, name)
    if path not in _SPLITS:
        _SPLITS[path] = df.rdd.getNumPartitions()
    cores = spark.sparkContext.defaultParallelism
    return df.repartition(cores) if _SPLITS[path] < cores else df


def order_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders joined to customer with the request key and filing date.

    customer is a dimension of orders; the join is left to the optimizer
    (AQE broadcasts it at small scale and sort-merges it at large scale).
    """
    o = load_spread(spark, sf_dir, "orders",
                    "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")
    c = load(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal", "c_mktsegment")
    return (o.join(c, o.o_custkey == c.c_custkey)
            .selectExpr("*", "to_date(o_orderdate) AS fdate")
            .selectExpr("*", "concat('SD', CAST(year(fdate) AS STRING), '/', "
                             "lpad(CAST(o_orderkey AS STRING), 7, '0')) AS request_number"))


MONTH_ARRAY = "array(" + ", ".join(f"'{w}'" for w in MONTH_WORDS) + ")"


def sql_es_date(d: str) -> str:
    """SQL text: DATE -> portal text 'd mmm. yyyy' (day not padded)."""
    return (f"concat_ws(' ', CAST(dayofmonth({d}) AS STRING), element_at({MONTH_ARRAY}, month({d})), "
            f"CAST(year({d}) AS STRING))")


def es_date(d: Column) -> Column:
    """DATE -> portal text 'd mmm. yyyy' (day not padded)."""
    words = F.array(*[F.lit(w) for w in MONTH_WORDS])
    return F.concat_ws(" ", F.dayofmonth(d).cast("string"), F.element_at(words, F.month(d)),
                       F.year(d).cast("string"))


LOGO_URL = f"CASE WHEN o_totalprice >= 250000 THEN concat('{IMG_PREFIX}', CAST(o_orderkey AS STRING)) ELSE '' END"
DENOMINATION = "concat_ws(' ', c_mktsegment, o_orderpriority)"
NIZA = "CAST(o_orderkey % 45 + 1 AS STRING)"
GAZETTE = "CAST(year(fdate) * 100 + month(fdate) AS STRING)"
RAW_WORD = "CASE o_orderstatus WHEN 'F' THEN 'Registrada' WHEN 'O' THEN 'Bajo examen de fondo' ELSE 'Negada' END"


def registry_from_orders(spark: SparkSession, sf_dir: str, prefix: str = DEFAULT_LOGO_PREFIX) -> DataFrame:
    """R: the stored registry (REGISTRY_COLUMNS)."""
    b = order_base(spark, sf_dir).filter("o_orderpriority <> '1-URGENT'")
    base = b.selectExpr(
        "concat('reg-', CAST(o_orderkey AS STRING)) AS id",
        "request_number",
        "concat('R', CAST(o_custkey AS STRING)) AS registry_number",
        f"{DENOMINATION} AS denomination",
        f"{LOGO_URL} AS logo_url",
        f"{sql_logo_asset('request_number', LOGO_URL, prefix)} AS logo",
        "fdate AS filing_date",
        "add_months(fdate, 120) AS expiration_date",
        "CASE o_orderstatus WHEN 'F' THEN 'VIGENTE' WHEN 'O' THEN 'EXAMEN_DE_FONDO' ELSE 'NEGADA' END AS status",
        "upper(c_name) AS holder",
        f"{NIZA} AS niza_class",
        f"{GAZETTE} AS gazette_number",
        f"CAST('{REGISTRY_TS}' AS TIMESTAMP) AS updated_at",
        "'COLOMBIA' AS badger_country",
        "o_orderpriority", "o_orderstatus", "o_orderkey")
    cols = [c for c in base.columns if c not in ("o_orderpriority", "o_orderstatus", "o_orderkey")]
    # All stored rows of an order come from one pass over the joined orders.
    own = ("id", "denomination", "status", "badger_country")

    def stored(**other: str) -> str:
        return "named_struct(" + ", ".join(f"'{c}', {other.get(c, c)}" for c in own) + ")"

    copies = (f"array({stored()}, "
              "IF(o_orderpriority = '2-HIGH', "
              + stored(id="concat('ec-', CAST(o_orderkey AS STRING))", status="'VIGENTE'", badger_country="'ECUADOR'") + ", NULL), "
              "IF(o_orderpriority = '3-MEDIUM' AND o_orderstatus = 'F', "
              + stored(id="concat('reg-dup-', CAST(o_orderkey AS STRING))", denomination="concat('OLD ', denomination)") + ", NULL))")
    rest = [c for c in cols if c not in own]
    return base.selectExpr(*rest, f"inline(filter({copies}, c -> c IS NOT NULL))").select(*cols)


def raw_status_word(status_col: str = "o_orderstatus") -> Column:
    return (F.when(F.col(status_col) == "F", "Registrada")
            .when(F.col(status_col) == "O", "Bajo examen de fondo").otherwise("Negada"))


def snapshot_from_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """N: one raw portal record per order (RAW_COLUMNS + o_orderkey, o_custkey, fdate)."""
    b = order_base(spark, sf_dir).filter("o_orderpriority <> '5-LOW'")
    es = sql_es_date("fdate")
    return b.selectExpr(
        "request_number",
        "CASE WHEN o_orderstatus = 'O' THEN concat(' R', CAST(o_custkey AS STRING), ' ') "
        "ELSE concat('R', CAST(o_custkey AS STRING)) END AS registry_number",
        f"CASE WHEN o_totalprice > 400000 THEN concat({DENOMINATION}, ' PLUS') ELSE {DENOMINATION} END AS denomination",
        f"{LOGO_URL} AS logo_url",
        f"CASE WHEN o_orderkey % 11 = 0 THEN upper({es}) ELSE {es} END AS filing_date",
        f"CASE WHEN o_orderkey % 13 = 0 THEN CAST(NULL AS STRING) ELSE {sql_es_date('add_months(fdate, 120)')} END"
        " AS expiration_date",
        f"CASE WHEN o_orderkey % 7 = 0 THEN 'Cancelada' ELSE {RAW_WORD} END AS status",
        "CASE WHEN c_acctbal < 0 THEN array(c_name, 'Socio; Dos') "
        "ELSE array(concat('  ', lower(c_name), ' ')) END AS holder",
        f"{NIZA} AS niza_class",
        f"{GAZETTE} AS gazette_number",
        "o_orderkey", "o_custkey", "o_orderstatus", "fdate")


def snapshot_batch(snap: DataFrame, batch_no: int = 0) -> DataFrame:
    """N as one landed batch: batch number, file position = order key."""
    return snap.select(F.lit(batch_no).cast("bigint").alias("batch_no"),
                       F.col("o_orderkey").cast("bigint").alias("pos"), *RAW_COLUMNS)


FEED_MONTH_BASE = 100  # month-feed batch numbers start here, after the class feed (1..45)
FEED_MONTH_EPOCH = 1990
MAX_FEED_BATCH = FEED_MONTH_BASE + (int(TODAY[:4]) - FEED_MONTH_EPOCH + 1) * 12


def feeds_from_snapshot(snap: DataFrame) -> DataFrame:
    """U4: the same records landed twice, by class then by month.

    Class feed: batch = class number (1..45). Month feed: batch =
    100 + months since 1990-01 (1-based), with status 'Publicada' for order
    keys divisible by 5. Batch numbers stay below MAX_FEED_BATCH.
    """
    cols = [c for c in RAW_COLUMNS if c != "status"]
    by_class = snap.selectExpr("CAST(niza_class AS BIGINT) AS batch_no", "CAST(o_orderkey AS BIGINT) AS pos",
                               *RAW_COLUMNS)
    by_month = snap.selectExpr(
        f"CAST({FEED_MONTH_BASE} + (year(fdate) - {FEED_MONTH_EPOCH}) * 12 + month(fdate) AS BIGINT) AS batch_no",
        "CAST(o_orderkey AS BIGINT) AS pos", *cols,
        "CASE WHEN o_orderkey % 5 = 0 THEN 'Publicada' ELSE status END AS status").select(
        "batch_no", "pos", *RAW_COLUMNS)
    return by_class.unionByName(by_month)


def versions_from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V: events as versions: key user_id, batch = epoch day, position = event_id,
    compared columns event_type and band (HIGH when value >= 35)."""
    e = load_spread(spark, sf_dir, "events", "event_id", "ts", "user_id", "event_type", "value")
    return e.select(
        F.col("user_id").cast("string").alias("user_key"),
        F.unix_date(F.to_date("ts")).cast("bigint").alias("batch_no"),
        F.col("event_id").cast("bigint").alias("pos"),
        "event_type",
        F.when(F.col("value") >= 35, F.lit("HIGH")).otherwise(F.lit("LOW")).alias("band"))


# --- portal pages rendered from orders -------------------------------------------

GRID = "MainContent_ctrlTMSearch_ctrlProcList_gvwIPCases"
PAGE_ROWS = 200
LISTING_ROWS = 2000


def listing_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Result-grid pages: a listing per 2000 consecutive order keys, pages of
    200 keys (so a page never exceeds 200 rows), rows in key order. Even
    listings show the filing-date column ('Fecha de radicación' in header
    cell 6), odd listings do not. Orders whose key is divisible by 97
    render as blank rows. Cells carry padding, newlines, entities, <br>
    separated holders and picture anchors."""
    b = order_base(spark, sf_dir)
    row = (
        "struct(o_orderkey AS k, o_orderkey % 97 = 0 AS blank, request_number AS rn, "
        "concat(' R', CAST(o_custkey AS STRING), '\\n') AS reg, "
        "concat_ws(' ', c_mktsegment, '&amp; CO', o_orderpriority) AS den, "
        f"CASE WHEN o_totalprice >= 250000 THEN concat('{IMG_PREFIX}', CAST(o_orderkey AS STRING), '?a=1&amp;b=2') END "
        f"AS href, {sql_es_date('fdate')} AS fil, {sql_es_date('add_months(fdate, 120)')} AS exp, "
        f"{RAW_WORD} AS st, "
        "CASE WHEN c_acctbal < 0 THEN concat(c_name, '<br>Socio &amp; Hijos') ELSE concat('\\n  ', c_name, ' ') END "
        f"AS hol, {NIZA} AS cls, {GAZETTE} AS gaz)")
    pages = (b.groupBy(F.expr(f"CAST(o_orderkey DIV {LISTING_ROWS} AS BIGINT)").alias("listing_id"),
                       F.expr(f"CAST((o_orderkey DIV {PAGE_ROWS}) % {LISTING_ROWS // PAGE_ROWS} AS BIGINT)")
                       .alias("page_no"))
             .agg(F.expr(f"array_sort(collect_list({row}))").alias("rows"))
             .withColumn("with_filing", F.expr("listing_id % 2 = 0")))

    def td(x: str) -> str:
        return f"'<td>', {x}, '</td>'"

    anchor = (f"CASE WHEN r.href IS NOT NULL THEN concat('<a id=\"{GRID}_hlnkCasePicture_', CAST(i AS STRING), "
              "'\" href=\"', r.href, '\"><img src=\"x.png\"></a>') ELSE '' END")
    full = ("concat(" + ", ".join([td("CAST(i + 1 AS STRING)"), td("r.rn"), td("r.reg"), td("r.den"), td(anchor)])
            + ", CASE WHEN with_filing THEN concat(" + td("r.fil") + ") ELSE '' END, "
            + ", ".join([td("r.exp"), td("r.st"), td("r.hol"), td("r.cls"), td("r.gaz")]) + ")")
    empty = "'" + "<td></td>" * 11 + "'"
    render = f"concat('<tr class=\"row\">', CASE WHEN r.blank THEN {empty} ELSE {full} END, '</tr>')"
    header = ("concat('<tr><th>#</th><th>Expediente</th><th>Registro</th><th>Signo</th><th>Logo</th><th>', "
              "CASE WHEN with_filing THEN 'Fecha de radicación' ELSE 'Fecha de vencimiento' END, "
              "'</th><th>Estado</th><th>Titular</th><th>Clase</th><th>Gaceta</th></tr>')")
    html = ("concat('<html><body><span id=\"MainContent_ctrlTMSearch_ctrlProcList_hdrNbItems\">Resultados: ', "
            f"CAST(size(rows) AS STRING), '</span><table id=\"{GRID}\" class=\"grid\"><tbody>', {header}, "
            f"array_join(transform(rows, (r, i) -> {render}), ''), "
            "'<tr class=\"gridview_pager\"><td colspan=\"11\">', "
            # The pager of page n lies in n % 6 tables, one in the other.
            "repeat('<table><tbody><tr><td>', page_no % 6), '<table><tbody><tr><td><span>1</span></td>"
            "<td><a href=\"#2\">2</a></td><td><a href=\"#3\">3</a></td></tr></tbody></table>', "
            "repeat('</td></tr></tbody></table>', page_no % 6), '</td></tr></tbody></table></body></html>')")
    return pages.selectExpr(
        "concat('L', CAST(listing_id AS STRING), '-', CAST(page_no AS STRING)) AS page_id",
        "listing_id", "page_no", f"{html} AS html")


def detail_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One detail page per order: finished orders show the status in the
    first status label, open orders in the second label (first one blank),
    pending orders show no label."""
    b = order_base(spark, sf_dir)
    word = raw_status_word()
    st = F.col("o_orderstatus")
    inner = (F.when(st == "F", F.concat(F.lit('<span id="MainContent_ctrlTM_lblCurrentStatus"> '), word,
                                        F.lit(" </span>")))
             .when(st == "O", F.concat(F.lit('<span id="MainContent_ctrlTM_lblCurrentStatus">  </span>'
                                             '<span id="MainContent_ctrlIRD_lblCurrentStatus">\n'), word,
                                       F.lit("\n</span>")))
             .otherwise(F.lit("<p>Sin estado</p>")))
    html = F.concat(F.lit('<html><body><div id="MainContent_ctrlTM_panelCaseData">'), inner,
                    F.lit("</div></body></html>"))
    return b.select(F.concat(F.lit("D"), F.col("o_orderkey").cast("string")).alias("page_id"),
                    "request_number", html.alias("html"))


def no_result_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A 'no results' page per customer with a negative balance."""
    c = load(spark, sf_dir, "customer").filter(F.col("c_acctbal") < 0)
    return c.select(F.concat(F.lit("N"), F.col("c_custkey").cast("string")).alias("page_id"),
                    F.lit('<html><body><div id="MainContent_ctrlTMSearch_divHelp">Sin resultados</div>'
                          '</body></html>').alias("html"))


def driver_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load_spread(spark, sf_dir, "pages", "page_id", "html").select(
        F.concat(F.lit("P"), F.col("page_id").cast("string")).alias("page_id"), "html")
