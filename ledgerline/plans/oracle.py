"""DuckDB oracle SQL for the registered queries.

Written from the rules (plans.derived docstrings, SURVEY semantics), not by
transcribing the Spark expressions: normalised snapshot values are stated
directly (the Spanish date text must parse back to the order date, the
holder noise must vanish), the version chain is a plain LAG, and so on.
Test text is ASCII, so DuckDB's trim() matches the Unicode-aware strip.
"""

from __future__ import annotations

from ledgerline.plans.derived import IMG_PREFIX, REGISTRY_TS, RUN_TS
from ledgerline.plans.derived import TODAY as derived_today
from ledgerline.schemas import DEFAULT_LOGO_PREFIX

OB = """
ob AS (
  SELECT o.o_orderkey, o.o_custkey, o.o_orderstatus, o.o_totalprice, o.o_orderpriority,
         c.c_name, c.c_acctbal, c.c_mktsegment,
         CAST(o.o_orderdate AS DATE) AS fdate,
         'SD' || CAST(year(o.o_orderdate) AS VARCHAR) || '/' || lpad(CAST(o.o_orderkey AS VARCHAR), 7, '0')
           AS request_number
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey)"""

REG = f"""
reg_base AS (
  SELECT 'reg-' || CAST(o_orderkey AS VARCHAR) AS id, request_number,
         'R' || CAST(o_custkey AS VARCHAR) AS registry_number,
         c_mktsegment || ' ' || o_orderpriority AS denomination,
         CASE WHEN o_totalprice >= 250000 THEN '{IMG_PREFIX}' || CAST(o_orderkey AS VARCHAR) ELSE '' END AS logo_url,
         CASE WHEN o_totalprice >= 250000 THEN '{DEFAULT_LOGO_PREFIX}' || replace(request_number, '/', '_') || '.jpeg'
              ELSE '' END AS logo,
         fdate AS filing_date,
         CAST(fdate + INTERVAL 10 YEAR AS DATE) AS expiration_date,
         CASE o_orderstatus WHEN 'F' THEN 'VIGENTE' WHEN 'O' THEN 'EXAMEN_DE_FONDO' ELSE 'NEGADA' END AS status,
         upper(c_name) AS holder,
         CAST(o_orderkey % 45 + 1 AS VARCHAR) AS niza_class,
         CAST(year(fdate) * 100 + month(fdate) AS VARCHAR) AS gazette_number,
         TIMESTAMP '{REGISTRY_TS}' AS updated_at,
         'COLOMBIA' AS badger_country,
         o_orderpriority, o_orderstatus, o_orderkey
  FROM ob WHERE o_orderpriority <> '1-URGENT'),
reg AS (
  SELECT id, request_number, registry_number, denomination, logo_url, logo, filing_date, expiration_date,
         status, holder, niza_class, gazette_number, updated_at, badger_country FROM reg_base
  UNION ALL
  SELECT 'ec-' || CAST(o_orderkey AS VARCHAR), request_number, registry_number, denomination, logo_url, logo,
         filing_date, expiration_date, 'VIGENTE', holder, niza_class, gazette_number, updated_at, 'ECUADOR'
  FROM reg_base WHERE o_orderpriority = '2-HIGH'
  UNION ALL
  SELECT 'reg-dup-' || CAST(o_orderkey AS VARCHAR), request_number, registry_number, 'OLD ' || denomination,
         logo_url, logo, filing_date, expiration_date, status, holder, niza_class, gazette_number, updated_at,
         badger_country
  FROM reg_base WHERE o_orderpriority = '3-MEDIUM' AND o_orderstatus = 'F'),
regd AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY badger_country, request_number ORDER BY id) AS rn
                 FROM reg) WHERE rn = 1)"""

# The snapshot N after normalisation, stated from the generating rules.
SNAP = f"""
snap AS (
  SELECT request_number,
         CASE WHEN o_orderstatus = 'O' THEN ' R' || CAST(o_custkey AS VARCHAR) || ' '
              ELSE 'R' || CAST(o_custkey AS VARCHAR) END AS registry_number,
         c_mktsegment || ' ' || o_orderpriority || CASE WHEN o_totalprice > 400000 THEN ' PLUS' ELSE '' END
           AS denomination,
         CASE WHEN o_totalprice >= 250000 THEN '{IMG_PREFIX}' || CAST(o_orderkey AS VARCHAR) ELSE '' END AS logo_url,
         CASE WHEN o_totalprice >= 250000 THEN '{DEFAULT_LOGO_PREFIX}' || replace(request_number, '/', '_') || '.jpeg'
              ELSE '' END AS logo,
         fdate AS filing_date,
         CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE CAST(fdate + INTERVAL 10 YEAR AS DATE) END AS expiration_date,
         CASE WHEN o_orderkey % 7 = 0 THEN 'CANCELADA'
              WHEN o_orderstatus = 'F' THEN 'VIGENTE'
              WHEN o_orderstatus = 'O' THEN 'EXAMEN_DE_FONDO' ELSE 'NEGADA' END AS status,
         CASE WHEN c_acctbal < 0 THEN upper(c_name) || '; SOCIO, DOS' ELSE upper(c_name) END AS holder,
         CAST(o_orderkey % 45 + 1 AS VARCHAR) AS niza_class,
         CAST(year(fdate) * 100 + month(fdate) AS VARCHAR) AS gazette_number,
         TIMESTAMP '{RUN_TS}' AS updated_at,
         'COLOMBIA' AS badger_country,
         o_orderkey, o_orderstatus, o_orderpriority, fdate AS odate
  FROM ob WHERE o_orderpriority <> '5-LOW')"""

CMP = ["registry_number", "denomination", "logo_url", "filing_date", "expiration_date",
       "status", "holder", "niza_class", "gazette_number"]


def _t(alias: str, c: str) -> str:
    return f"trim(coalesce(CAST({alias}.{c} AS VARCHAR), ''))"


def _changed_list(a: str, b: str, cols=CMP) -> str:
    parts = ", ".join(f"CASE WHEN {_t(a, c)} <> {_t(b, c)} THEN '{c}' END" for c in cols)
    return f"nullif(concat_ws(', ', {parts}), '')"


DIFF = f"""
diffed AS (
  SELECT s.*, r.request_number IS NOT NULL AS in_reg,
         CASE WHEN r.request_number IS NULL THEN 'NEW_RECORD' ELSE {_changed_list('s', 'r')} END AS columns_changed
  FROM snap s LEFT JOIN regd r ON r.badger_country = s.badger_country AND r.request_number = s.request_number)"""


def _with(*ctes: str) -> str:
    return "WITH " + ",".join(ctes)


def _uuid(expr: str) -> str:
    h = f"sha256({expr})"
    return (f"substr({h},1,8) || '-' || substr({h},9,4) || '-' || substr({h},13,4) || '-' || "
            f"substr({h},17,4) || '-' || substr({h},21,12)")


REG_OUT = ("id, request_number, registry_number, denomination, logo_url, logo, "
           "CAST(filing_date AS VARCHAR) AS filing_date, CAST(expiration_date AS VARCHAR) AS expiration_date, "
           "status, holder, niza_class, gazette_number, CAST(updated_at AS VARCHAR) AS updated_at, badger_country")

V = """
v AS (
  SELECT CAST(user_id AS VARCHAR) AS user_key, CAST(CAST(ts AS DATE) - DATE '1970-01-01' AS BIGINT) AS batch_no,
         event_id AS pos, event_type, CASE WHEN value >= 35 THEN 'HIGH' ELSE 'LOW' END AS band
  FROM events),
v1 AS (
  SELECT user_key, batch_no, pos, event_type, band FROM (
    SELECT *, row_number() OVER (PARTITION BY user_key, batch_no ORDER BY pos) AS rn FROM v) WHERE rn = 1),
vch AS (
  SELECT *,
    CASE WHEN p_exists IS NULL THEN 'INSERT'
         WHEN event_type <> p_type OR band <> p_band THEN 'UPDATE' ELSE 'UNCHANGED' END AS change_type,
    CASE WHEN p_exists IS NULL THEN 'NEW_RECORD'
         ELSE nullif(concat_ws(', ', CASE WHEN event_type <> p_type THEN 'event_type' END,
                                     CASE WHEN band <> p_band THEN 'band' END), '') END AS columns_changed
  FROM (SELECT *, lag(1) OVER w AS p_exists, lag(event_type) OVER w AS p_type, lag(band) OVER w AS p_band
        FROM v1 WINDOW w AS (PARTITION BY user_key ORDER BY batch_no)))"""

ACTIVE = ("'EXAMEN_DE_FORMA', 'SUSPENDIDA', 'EN_GACETA', 'EXAMEN_DE_FONDO', 'OPOSICION', "
          "'CERTIFICADA_Y_ENVIADA', 'IRREGULAR', 'VIGENTE', 'PROTEGIDA'")

CORR = """
corr AS (
  SELECT request_number,
         CASE o_orderstatus WHEN 'F' THEN 'Negada' WHEN 'O' THEN 'Con oposicion' ELSE 'Registrada' END
           AS extracted_status,
         CAST(NULL AS VARCHAR) AS error, o_orderkey * 2 AS pos
  FROM ob WHERE o_orderpriority = '3-MEDIUM'
  UNION ALL
  SELECT request_number, 'Cancelada', NULL, o_orderkey * 2 + 1
  FROM ob WHERE o_orderpriority = '3-MEDIUM' AND o_orderstatus = 'F'
  UNION ALL
  SELECT request_number, CASE WHEN o_orderstatus = 'F' THEN '' ELSE 'Negada' END,
         CASE WHEN o_orderstatus = 'O' THEN 'timeout' END, o_orderkey * 2
  FROM ob WHERE o_orderpriority = '4-NOT SPECIFIED'),
corr_ok AS (
  SELECT *, CASE upper(extracted_status)
              WHEN 'VIGENTE' THEN 'VIGENTE' WHEN 'CANCELADA' THEN 'CANCELADA'
              WHEN 'ANULADO CONSEJO DE ESTADO' THEN 'ANULADA' WHEN 'CADUCADO' THEN 'VENCIDA'
              WHEN 'RENUNCIA TOTAL' THEN 'RENUNCIA_TOTAL' WHEN 'NEGADA' THEN 'NEGADA'
              WHEN 'DESISTIDA' THEN 'DESISTIDA' WHEN 'ABANDONADA' THEN 'ABANDONADA'
              WHEN 'BAJO EXAMEN DE FONDO' THEN 'EXAMEN_DE_FONDO' WHEN 'BAJO EXAMEN FORMAL' THEN 'EXAMEN_DE_FORMA'
              WHEN 'PUBLICADA' THEN 'EN_GACETA' WHEN 'CON OPOSICION' THEN 'OPOSICION' END AS mapped
  FROM corr WHERE error IS NULL AND coalesce(extracted_status, '') <> ''),
corr_last AS (
  SELECT request_number, arg_max(mapped, pos) AS new_status FROM corr_ok WHERE mapped IS NOT NULL
  GROUP BY request_number)"""

ORACLE: dict[str, str] = {}

ORACLE["sync_report"] = _with(OB, REG, SNAP, DIFF) + """
SELECT request_number, true AS changed, columns_changed FROM diffed WHERE columns_changed IS NOT NULL"""

ORACLE["diff_batch"] = _with(OB, REG, SNAP, DIFF) + """
SELECT request_number, badger_country,
       CASE WHEN NOT in_reg THEN 'INSERT' WHEN columns_changed IS NOT NULL THEN 'UPDATE' ELSE 'UNCHANGED' END
         AS change_type,
       columns_changed
FROM diffed"""

ORACLE["change_totals"] = _with(OB, REG, SNAP, DIFF) + """
SELECT change_type, count(*) AS n FROM (
  SELECT CASE WHEN NOT in_reg THEN 'INSERT' WHEN columns_changed IS NOT NULL THEN 'UPDATE' ELSE 'UNCHANGED' END
    AS change_type FROM diffed) GROUP BY change_type"""

ORACLE["upsert_registry"] = _with(OB, REG, SNAP, DIFF) + f"""
, upd AS (SELECT * FROM diffed WHERE in_reg AND columns_changed IS NOT NULL)
SELECT {REG_OUT} FROM (
  SELECT r.id, r.request_number,
         CASE WHEN u.request_number IS NULL THEN r.registry_number ELSE u.registry_number END AS registry_number,
         CASE WHEN u.request_number IS NULL THEN r.denomination ELSE u.denomination END AS denomination,
         CASE WHEN u.request_number IS NULL THEN r.logo_url ELSE u.logo_url END AS logo_url,
         r.logo,
         CASE WHEN u.request_number IS NULL THEN r.filing_date ELSE u.filing_date END AS filing_date,
         CASE WHEN u.request_number IS NULL THEN r.expiration_date ELSE u.expiration_date END AS expiration_date,
         CASE WHEN u.request_number IS NULL THEN r.status ELSE u.status END AS status,
         CASE WHEN u.request_number IS NULL THEN r.holder ELSE u.holder END AS holder,
         CASE WHEN u.request_number IS NULL THEN r.niza_class ELSE u.niza_class END AS niza_class,
         CASE WHEN u.request_number IS NULL THEN r.gazette_number ELSE u.gazette_number END AS gazette_number,
         CASE WHEN u.request_number IS NULL THEN r.updated_at ELSE u.updated_at END AS updated_at,
         r.badger_country
  FROM reg r LEFT JOIN upd u ON u.request_number = r.request_number AND u.badger_country = r.badger_country
  UNION ALL
  SELECT {_uuid("badger_country || chr(1) || request_number")}, request_number, registry_number, denomination,
         logo_url, logo, filing_date, expiration_date, status, holder, niza_class, gazette_number, updated_at,
         badger_country
  FROM diffed WHERE NOT in_reg)"""

ORACLE["store_commit"] = ORACLE["upsert_registry"]

ORACLE["registry_changes"] = _with(OB, REG, SNAP, DIFF) + f"""
SELECT op, {REG_OUT} FROM (
  SELECT 'UPDATE' AS op, r.id, r.request_number, u.registry_number, u.denomination, u.logo_url, r.logo, u.filing_date,
         u.expiration_date, u.status, u.holder, u.niza_class, u.gazette_number, u.updated_at, r.badger_country
  FROM reg r JOIN diffed u ON u.request_number = r.request_number AND u.badger_country = r.badger_country
  WHERE u.columns_changed IS NOT NULL
  UNION ALL
  SELECT 'INSERT', {_uuid("badger_country || chr(1) || request_number")}, request_number, registry_number, denomination,
         logo_url, logo, filing_date, expiration_date, status, holder, niza_class, gazette_number, updated_at,
         badger_country
  FROM diffed WHERE NOT in_reg)"""

ORACLE["normalise_snapshot"] = _with(OB, SNAP) + """
SELECT request_number, registry_number, denomination, logo_url, logo,
       CAST(filing_date AS VARCHAR) AS filing_date, CAST(expiration_date AS VARCHAR) AS expiration_date,
       status, holder, niza_class, gazette_number, CAST(updated_at AS VARCHAR) AS updated_at, badger_country
FROM snap"""

ORACLE["first_per_key"] = _with(V) + """
SELECT user_key, batch_no, pos, event_type, band FROM v1"""

ORACLE["version_chain"] = _with(V) + """
SELECT user_key, batch_no, pos, event_type, band, change_type, columns_changed FROM vch"""

ORACLE["batch_totals"] = _with(V) + """
SELECT batch_no, change_type, count(*) AS n FROM vch GROUP BY batch_no, change_type"""

ORACLE["latest_state"] = _with(V) + """
SELECT user_key,
       min(batch_no) FILTER (WHERE change_type = 'INSERT') AS inserted_in,
       max(batch_no) AS changed_in,
       arg_max(event_type, batch_no) AS event_type,
       arg_max(band, batch_no) AS band
FROM vch WHERE change_type IN ('INSERT', 'UPDATE') GROUP BY user_key"""

ORACLE["missing_keys"] = _with(OB, REG, SNAP) + f"""
SELECT DISTINCT request_number AS missing_request_number FROM reg
WHERE status IN ({ACTIVE})
  AND request_number NOT IN (SELECT request_number FROM snap WHERE request_number IS NOT NULL)"""

ORACLE["orders_without_lines"] = """
SELECT CAST(o_orderkey AS VARCHAR) AS missing_request_number FROM orders o
WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey)"""

ORACLE["apply_corrections"] = _with(OB, REG, CORR) + f"""
SELECT r.id, r.request_number, r.badger_country,
       CASE WHEN c.new_status IS NOT NULL AND r.badger_country = 'COLOMBIA' THEN c.new_status ELSE r.status END
         AS status,
       CAST(CASE WHEN c.new_status IS NOT NULL AND r.badger_country = 'COLOMBIA' THEN TIMESTAMP '{RUN_TS}'
                 ELSE r.updated_at END AS VARCHAR) AS updated_at
FROM reg r LEFT JOIN corr_last c ON c.request_number = r.request_number"""

ORACLE["unmapped_corrections"] = _with(OB, CORR) + """
SELECT request_number, extracted_status AS raw_value, 'unmapped status' AS reason
FROM corr_ok WHERE mapped IS NULL"""

ORACLE["correction_totals"] = _with(OB, CORR) + """
SELECT count(*) AS processed,
       count(*) FILTER (WHERE error IS NULL AND coalesce(extracted_status, '') <> '') AS valid,
       (SELECT count(*) FROM corr_ok WHERE mapped IS NOT NULL) AS applied
FROM corr"""

TAGGED = f"""
tagged AS (
  SELECT *, CASE WHEN status IN ({ACTIVE}) THEN 'ACTIVE' ELSE 'INACTIVE' END AS tag FROM reg),
months AS (
  SELECT CAST(m AS DATE) AS lo, CAST(last_day(m) AS DATE) AS hi, t AS tag,
         strftime(m, '%d_%m_%Y') || '_' || strftime(last_day(m), '%d_%m_%Y') || '_' || t AS slice_id
  FROM generate_series(DATE '1989-01-01', DATE '2014-11-01', INTERVAL 1 MONTH) g(m),
       (VALUES ('ACTIVE'), ('INACTIVE')) tg(t)),
mon_assigned AS (
  SELECT t.id, m.slice_id FROM tagged t JOIN months m
    ON t.tag = m.tag AND t.filing_date BETWEEN m.lo AND m.hi)"""

# Filing dates of the test data all fall in the month part of the history plan.
ORACLE["assign_slices"] = _with(OB, REG, TAGGED) + """
SELECT id, strftime(date_trunc('month', filing_date), '%d_%m_%Y') || '_' || strftime(last_day(filing_date), '%d_%m_%Y')
         || '_' || tag AS slice_id, 'month' AS kind
FROM tagged WHERE filing_date BETWEEN DATE '1989-01-01' AND DATE '2014-11-30'"""

# Event days fall in the open-ended weekly part of the recent plan, anchored at 2023-01-01.
ORACLE["assign_event_slices"] = f"""
WITH e AS (SELECT event_id, CAST(ts AS DATE) AS d FROM events),
w AS (SELECT event_id, CAST(DATE '2023-01-01' + INTERVAL (7 * ((d - DATE '2023-01-01') // 7)) DAY AS DATE) AS lo
      FROM e WHERE d >= DATE '2023-01-01' AND d <= DATE '{derived_today}')
SELECT event_id, strftime(lo, '%d_%m_%Y') || '_' ||
       strftime(least(CAST(lo + INTERVAL 6 DAY AS DATE), DATE '{derived_today}'), '%d_%m_%Y') || '_ACTIVE' AS slice_id,
       'week' AS kind
FROM w"""

ORACLE["slice_counts"] = _with(OB, REG, TAGGED) + """
SELECT m.slice_id, 'month' AS kind, count(a.id) AS n
FROM months m LEFT JOIN mon_assigned a ON a.slice_id = m.slice_id GROUP BY m.slice_id"""

ORACLE["slice_overflow"] = _with(OB, REG, TAGGED) + """
SELECT slice_id, count(*) AS n, count(*) >= 200 AS overflow FROM mon_assigned GROUP BY slice_id"""

ORACLE["slice_kept_rows"] = _with(OB, REG, TAGGED) + """
SELECT id, slice_id, count(*) OVER (PARTITION BY slice_id) >= 200 AS overflow FROM mon_assigned"""

ORACLE["pending_slices"] = _with(OB, REG, TAGGED) + """
SELECT slice_id, tag FROM months WHERE slice_id NOT IN (SELECT slice_id FROM mon_assigned)"""

ORACLE["class_slices"] = _with(OB, REG, TAGGED) + """
SELECT 'niza_' || CAST(c AS VARCHAR) || '_1900_1900_ACTIVE' AS slice_id,
       (SELECT count(*) FROM tagged t WHERE t.tag = 'ACTIVE' AND t.niza_class = CAST(c AS VARCHAR)) AS n
FROM range(1, 46) r(c)"""

ES_MONTHS = "['ene.', 'feb.', 'mar.', 'abr.', 'may.', 'jun.', 'jul.', 'ago.', 'sept.', 'oct.', 'nov.', 'dic.']"


def _es(d: str) -> str:
    return f"CAST(day({d}) AS VARCHAR) || ' ' || ({ES_MONTHS})[month({d})] || ' ' || CAST(year({d}) AS VARCHAR)"


# What a reader of the rendered grids must get back: decoded, stripped text.
ORACLE["parse_result_pages"] = _with(OB) + f"""
, pos AS (
  SELECT *, o_orderkey // 2000 AS listing_id, (o_orderkey // 200) % 10 AS page_no,
         1 + row_number() OVER (PARTITION BY o_orderkey // 200 ORDER BY o_orderkey) AS row_no
  FROM ob)
SELECT 'L' || CAST(listing_id AS VARCHAR) || '-' || CAST(page_no AS VARCHAR) AS page_id, row_no,
       request_number, 'R' || CAST(o_custkey AS VARCHAR) AS registry_number,
       c_mktsegment || ' & CO ' || o_orderpriority AS denomination,
       CASE WHEN o_totalprice >= 250000 THEN '{IMG_PREFIX}' || CAST(o_orderkey AS VARCHAR) || '?a=1&b=2&fmt=jpeg'
            ELSE '' END AS logo_url,
       CASE WHEN (o_orderkey // 2000) % 2 = 0 THEN {_es('fdate')} ELSE '' END AS filing_date,
       {_es('CAST(fdate + INTERVAL 10 YEAR AS DATE)')} AS expiration_date,
       CASE o_orderstatus WHEN 'F' THEN 'Registrada' WHEN 'O' THEN 'Bajo examen de fondo' ELSE 'Negada' END AS status,
       CASE WHEN c_acctbal < 0 THEN c_name || ' | Socio & Hijos' ELSE c_name END AS holder,
       CAST(o_orderkey % 45 + 1 AS VARCHAR) AS niza_class,
       CAST(year(fdate) * 100 + month(fdate) AS VARCHAR) AS gazette_number
FROM pos WHERE o_orderkey % 97 <> 0"""

ORACLE["detail_status"] = _with(OB) + f"""
SELECT request_number,
       CASE o_orderstatus WHEN 'F' THEN 'Registrada' WHEN 'O' THEN 'Bajo examen de fondo' ELSE '' END
         AS extracted_status,
       CASE WHEN o_orderstatus IN ('F', 'O') THEN NULL ELSE 'Status not found on results page.' END AS error
FROM ob"""

ORACLE["classify_pages"] = _with(OB) + """
SELECT 'L' || CAST(o_orderkey // 2000 AS VARCHAR) || '-' || CAST((o_orderkey // 200) % 10 AS VARCHAR)
         AS page_id, 'listing' AS kind, count(*) AS result_count, count(*) >= 150 AS overflow
FROM ob GROUP BY o_orderkey // 2000, (o_orderkey // 200) % 10
UNION ALL
SELECT 'D' || CAST(o_orderkey AS VARCHAR), 'detail', NULL, false FROM ob
UNION ALL
SELECT 'N' || CAST(c_custkey AS VARCHAR), 'no_result', NULL, false FROM customer WHERE c_acctbal < 0
UNION ALL
SELECT 'P' || CAST(page_id AS VARCHAR), 'unknown', NULL, false FROM pages"""


def _decode(x: str) -> str:
    # One HTML5 decoding pass for the entities present; these are legacy
    # entities, so the trailing semicolon is optional. &amp goes last so its
    # output cannot start a new entity within the same pass.
    return (f"regexp_replace(regexp_replace(regexp_replace(regexp_replace({x}, '&quot;?', '\"', 'g'), "
            f"'&copy;?', '\u00a9', 'g'), '&middot;?', '\u00b7', 'g'), '&amp;?', '&', 'g')")


# Titles hold only these four entities; text content decodes once, the reader once more.
ORACLE["page_titles"] = f"""
SELECT 'P' || CAST(page_id AS VARCHAR) AS page_id,
       {_decode(_decode("trim(regexp_extract(html, '(?s)<title[^>]*>(.*?)</title>', 1), ' \t\n\r')"))} AS title
FROM pages"""

ORACLE["json_roundtrip"] = ORACLE["normalise_snapshot"]

ORACLE["json_batches"] = ORACLE["normalise_snapshot"]

ORACLE["json_records"] = """
SELECT event_id, CAST(p AS BIGINT) AS pos, json_extract_string(props, '$.k') AS k
FROM events, (SELECT unnest([0, 1]) AS p) ps
WHERE (event_type = 'click') OR (event_type <> 'error' AND p = 0)"""

ORACLE["json_rejects"] = """
SELECT event_id, 'invalid json' AS reason FROM events WHERE event_type = 'error'"""

CHAIN_COLS = CMP


def _lagged_changes() -> str:
    parts = ", ".join(f"CASE WHEN trim(coalesce(CAST({c} AS VARCHAR), '')) <> "
                      f"trim(coalesce(CAST(p_{c} AS VARCHAR), '')) THEN '{c}' END" for c in CHAIN_COLS)
    return f"nullif(concat_ws(', ', {parts}), '')"


FEEDS = """
feeds AS (
  SELECT CAST(niza_class AS BIGINT) AS batch_no, o_orderkey AS pos, request_number, registry_number, denomination,
         logo_url, logo, filing_date, expiration_date, status, holder, niza_class, gazette_number, updated_at,
         badger_country
  FROM snap
  UNION ALL
  SELECT 100 + (year(odate) - 1990) * 12 + month(odate), o_orderkey, request_number, registry_number, denomination,
         logo_url, logo, filing_date, expiration_date,
         CASE WHEN o_orderkey % 5 = 0 THEN 'EN_GACETA' ELSE status END, holder, niza_class, gazette_number,
         updated_at, badger_country
  FROM snap),
chain_in AS (
  SELECT batch_no, request_number, badger_country, registry_number, denomination, logo_url, filing_date,
         expiration_date, status, holder, niza_class, gazette_number, false AS is_base FROM feeds
  UNION ALL
  SELECT -1, request_number, badger_country, registry_number, denomination, logo_url, filing_date,
         expiration_date, status, holder, niza_class, gazette_number, true
  FROM regd WHERE request_number IN (SELECT request_number FROM feeds) AND badger_country = 'COLOMBIA'),
chained AS (
  SELECT * , CASE WHEN p_exists IS NULL THEN 'NEW_RECORD' ELSE """ + _lagged_changes() + """ END AS cc
  FROM (SELECT *, lag(1) OVER w AS p_exists, """ + ", ".join(f"lag({c}) OVER w AS p_{c}" for c in CHAIN_COLS) + """
        FROM chain_in WINDOW w AS (PARTITION BY badger_country, request_number ORDER BY batch_no))),
versions AS (
  SELECT batch_no, request_number, badger_country,
         CASE WHEN p_exists IS NULL THEN 'INSERT' WHEN cc IS NOT NULL THEN 'UPDATE' ELSE 'UNCHANGED' END
           AS change_type, cc AS columns_changed
  FROM chained WHERE NOT is_base)"""

ORACLE["union_feeds"] = _with(OB, REG, SNAP, FEEDS) + """
SELECT batch_no, request_number, change_type, columns_changed FROM versions"""

ORACLE["feeds_registry"] = _with(OB, REG, SNAP, FEEDS) + f"""
, last_change AS (
  SELECT v.request_number, v.badger_country, max(v.batch_no) AS b,
         bool_or(v.change_type = 'INSERT') AS is_new
  FROM versions v WHERE v.change_type IN ('INSERT', 'UPDATE') GROUP BY v.request_number, v.badger_country),
last_vals AS (
  SELECT f.*, l.is_new FROM last_change l JOIN feeds f
    ON f.request_number = l.request_number AND f.badger_country = l.badger_country AND f.batch_no = l.b),
ins_vals AS (
  SELECT f.* FROM versions v JOIN feeds f
    ON f.request_number = v.request_number AND f.batch_no = v.batch_no WHERE v.change_type = 'INSERT')
SELECT {REG_OUT} FROM (
  SELECT r.id, r.request_number,
         CASE WHEN u.request_number IS NULL THEN r.registry_number ELSE u.registry_number END AS registry_number,
         CASE WHEN u.request_number IS NULL THEN r.denomination ELSE u.denomination END AS denomination,
         CASE WHEN u.request_number IS NULL THEN r.logo_url ELSE u.logo_url END AS logo_url,
         r.logo,
         CASE WHEN u.request_number IS NULL THEN r.filing_date ELSE u.filing_date END AS filing_date,
         CASE WHEN u.request_number IS NULL THEN r.expiration_date ELSE u.expiration_date END AS expiration_date,
         CASE WHEN u.request_number IS NULL THEN r.status ELSE u.status END AS status,
         CASE WHEN u.request_number IS NULL THEN r.holder ELSE u.holder END AS holder,
         CASE WHEN u.request_number IS NULL THEN r.niza_class ELSE u.niza_class END AS niza_class,
         CASE WHEN u.request_number IS NULL THEN r.gazette_number ELSE u.gazette_number END AS gazette_number,
         CASE WHEN u.request_number IS NULL THEN r.updated_at ELSE u.updated_at END AS updated_at,
         r.badger_country
  FROM reg r LEFT JOIN (SELECT * FROM last_vals WHERE NOT is_new) u
    ON u.request_number = r.request_number AND u.badger_country = r.badger_country
  UNION ALL
  SELECT {_uuid("i.badger_country || chr(1) || i.request_number")}, i.request_number, l.registry_number,
         l.denomination, l.logo_url, i.logo, l.filing_date, l.expiration_date, l.status, l.holder, l.niza_class,
         l.gazette_number, l.updated_at, i.badger_country
  FROM ins_vals i JOIN last_vals l ON l.request_number = i.request_number AND l.badger_country = i.badger_country)"""

ORACLE["date_parsing"] = f"""
WITH o AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d, o_orderkey % 8 AS v FROM orders),
t AS (
  SELECT o_orderkey, d, v,
         CASE v WHEN 0 THEN {_es('d')} WHEN 1 THEN upper({_es('d')})
                WHEN 2 THEN replace({_es('d')}, 'sept.', 'sep.')
                WHEN 3 THEN replace({_es('d')}, ' ', '  ')
                WHEN 4 THEN ' ' || {_es('d')}
                WHEN 5 THEN CAST(day(d) AS VARCHAR) || ' ' || ({ES_MONTHS})[month(d)] || ' '
                            || substr(CAST(year(d) AS VARCHAR), 3, 2)
                WHEN 6 THEN '31 ' || ({ES_MONTHS})[month(d)] || ' ' || CAST(year(d) AS VARCHAR)
                ELSE '' END AS raw,
         CASE WHEN v IN (0, 1) THEN d
              WHEN v = 2 AND month(d) <> 9 THEN d
              WHEN v = 6 THEN try_cast(printf('%04d-%02d-31', year(d), month(d)) AS DATE)
              END AS expect
  FROM o)
SELECT o_orderkey, raw, CAST(expect AS VARCHAR) AS parsed, (raw <> '' AND expect IS NULL) AS bad FROM t"""

ORACLE["holder_normalise"] = """
SELECT c_custkey,
       CASE c_custkey % 5 WHEN 0 THEN upper(c_name) WHEN 1 THEN upper(c_name) || ' X'
                          WHEN 2 THEN upper(c_name) || ',CO; B C' WHEN 3 THEN ''
                          ELSE '; ' || upper(c_name) END AS holder
FROM customer"""

ORACLE["status_mapping"] = """
WITH t AS (SELECT o_orderkey, o_orderstatus AS s, o_orderkey % 6 AS v FROM orders),
w AS (SELECT *, CASE s WHEN 'F' THEN 'Registrada' WHEN 'O' THEN 'Bajo examen de fondo' ELSE 'Negada' END AS word,
                CASE s WHEN 'F' THEN 'VIGENTE' WHEN 'O' THEN 'EXAMEN_DE_FONDO' ELSE 'NEGADA' END AS code FROM t)
SELECT o_orderkey,
       CASE v WHEN 0 THEN word WHEN 1 THEN upper(word) WHEN 2 THEN ' ' || word
              WHEN 3 THEN 'Con oposición' WHEN 4 THEN 'Con oposicion' ELSE 'Publicada' END AS raw,
       CASE v WHEN 0 THEN code WHEN 1 THEN code WHEN 2 THEN ' ' || word
              WHEN 3 THEN 'OPOSICION' WHEN 4 THEN 'Con oposicion' ELSE 'EN_GACETA' END AS mapped,
       CASE WHEN v IN (0, 1) AND s <> 'F' THEN code WHEN v = 4 THEN 'OPOSICION' WHEN v = 5 THEN 'EN_GACETA'
            END AS corrected
FROM w"""

# Streaming over the landed feeds must end where the batch job ends.
ORACLE["stream_sync"] = ORACLE["feeds_registry"]

ORACLE["registry_scan"] = _with(OB, REG) + """
SELECT request_number, registry_number, denomination, logo_url, CAST(filing_date AS VARCHAR) AS filing_date,
       CAST(expiration_date AS VARCHAR) AS expiration_date, status, holder, niza_class, gazette_number
FROM reg WHERE badger_country = 'COLOMBIA'"""

ORACLE["registry_lookup"] = _with(OB, REG, SNAP) + """
SELECT request_number, registry_number, denomination, logo_url, CAST(filing_date AS VARCHAR) AS filing_date,
       CAST(expiration_date AS VARCHAR) AS expiration_date, status, holder, niza_class, gazette_number
FROM reg WHERE badger_country = 'COLOMBIA' AND request_number IN (SELECT request_number FROM snap)"""

ORACLE["active_keys"] = _with(OB, REG) + f"""
SELECT DISTINCT request_number FROM reg WHERE status IN ({ACTIVE})"""

ORACLE["landed_raw_keys"] = _with(OB, SNAP) + """
SELECT DISTINCT request_number FROM snap"""

ORACLE["missing_roundtrip"] = ORACLE["missing_keys"]

ORACLE["report_roundtrip"] = ORACLE["sync_report"]

ORACLE["corrections_roundtrip"] = ORACLE["apply_corrections"]

# Detail pages: finished orders read 'Registrada' (no correction mapping), open
# ones 'Bajo examen de fondo' (EXAMEN_DE_FONDO), pending ones have no label.
ORACLE["verify_and_correct"] = _with(OB, REG, SNAP) + f"""
, missing AS (
  SELECT DISTINCT request_number FROM reg
  WHERE status IN ({ACTIVE}) AND request_number NOT IN (SELECT request_number FROM snap)),
fix AS (
  SELECT m.request_number FROM missing m JOIN ob ON ob.request_number = m.request_number
  WHERE ob.o_orderstatus = 'O')
SELECT r.id, r.request_number, r.badger_country,
       CASE WHEN f.request_number IS NOT NULL AND r.badger_country = 'COLOMBIA' THEN 'EXAMEN_DE_FONDO'
            ELSE r.status END AS status,
       CAST(CASE WHEN f.request_number IS NOT NULL AND r.badger_country = 'COLOMBIA' THEN TIMESTAMP '{RUN_TS}'
                 ELSE r.updated_at END AS VARCHAR) AS updated_at
FROM reg r LEFT JOIN fix f ON f.request_number = r.request_number"""

ORACLE["full_sync"] = _with(OB, SNAP) + f"""
, next AS ({ORACLE["upsert_registry"]}),
fix AS (
  SELECT DISTINCT n.request_number FROM next n JOIN ob ON ob.request_number = n.request_number
  WHERE n.status IN ({ACTIVE}) AND ob.o_orderstatus = 'O' AND n.request_number NOT IN (SELECT request_number FROM snap))
SELECT n.id, n.request_number, n.badger_country,
       CASE WHEN f.request_number IS NOT NULL AND n.badger_country = 'COLOMBIA' THEN 'EXAMEN_DE_FONDO' ELSE n.status END AS status,
       CASE WHEN f.request_number IS NOT NULL AND n.badger_country = 'COLOMBIA' THEN '{RUN_TS}' ELSE n.updated_at END AS updated_at
FROM next n LEFT JOIN fix f ON f.request_number = n.request_number"""

SHIFTED = """
shifted AS (
  SELECT o_orderkey, CASE WHEN o_orderkey % 31 <> 0 THEN
           CAST(CAST(o_orderdate AS DATE) + INTERVAL ((o_orderkey % 211 - 170) * 210) DAY AS DATE) END AS d,
         CASE WHEN o_orderstatus = 'F' THEN 'ACTIVE' ELSE 'INACTIVE' END AS tag
  FROM orders)"""

_NAME = "strftime(lo, '%d_%m_%Y') || '_' || strftime(hi, '%d_%m_%Y')"


def _weeks(lo: str, hi: str) -> str:
    return (f"SELECT CAST(m AS DATE) AS lo, CAST(least(m + INTERVAL 6 DAY, DATE '{hi}') AS DATE) AS hi, 'week' AS kind "
            f"FROM generate_series(DATE '{lo}', DATE '{hi}', INTERVAL 7 DAY) g(m)")


HISTORY = f"""
history AS (
  SELECT CAST(lo AS DATE) AS lo, CAST(hi AS DATE) AS hi, 'year' AS kind FROM (VALUES
    ('1900-01-02', '1970-12-31'), ('1971-01-01', '1975-12-31'), ('1976-01-01', '1980-12-31'), ('1981-01-01', '1985-12-31'),
    ('1986-01-01', '1986-12-31'), ('1987-01-01', '1987-12-31'), ('1988-01-01', '1988-12-31')) y(lo, hi)
  UNION ALL
  SELECT CAST(m AS DATE), last_day(m), 'month' FROM generate_series(DATE '1989-01-01', DATE '2014-11-01', INTERVAL 1 MONTH) g(m)
  UNION ALL {_weeks('2014-12-01', '2018-12-31')})"""

ORACLE["full_plan_slices"] = _with(SHIFTED, HISTORY) + f"""
, plan AS (
  SELECT * FROM history
  UNION ALL {_weeks('2019-01-01', '2022-12-27')}
  UNION ALL SELECT CAST(m AS DATE), CAST(m AS DATE), 'day' FROM generate_series(DATE '2022-12-28', DATE '2022-12-31', INTERVAL 1 DAY) g(m)
  UNION ALL {_weeks('2023-01-01', derived_today)})
SELECT o_orderkey, {_NAME} || '_' || tag AS slice_id, kind FROM shifted JOIN plan ON d BETWEEN lo AND hi"""

ORACLE["outside_plan"] = _with(SHIFTED, HISTORY) + """
SELECT o_orderkey, CAST(d AS VARCHAR) AS d, tag FROM shifted
WHERE d IS NULL OR tag <> 'ACTIVE' OR NOT EXISTS (SELECT 1 FROM history WHERE d BETWEEN lo AND hi)"""

ORACLE["year_block_counts"] = _with(SHIFTED) + f"""
, plan AS (
  SELECT CAST(m AS DATE) AS lo, CAST(least(m + INTERVAL 5 YEAR - INTERVAL 1 DAY, DATE '1998-12-31') AS DATE) AS hi
  FROM generate_series(DATE '1900-01-02', DATE '1998-12-31', INTERVAL 5 YEAR) g(m))
SELECT {_NAME} || '_ACTIVE' AS slice_id, 'year' AS kind, count(o_orderkey) AS n
FROM plan LEFT JOIN shifted ON d BETWEEN lo AND hi GROUP BY ALL"""

ORACLE["day_slice_counts"] = f"""
WITH plan AS (
  SELECT CAST(m AS DATE) AS lo, CAST(m AS DATE) AS hi FROM generate_series(DATE '2024-01-01', DATE '2024-03-31', INTERVAL 1 DAY) g(m))
SELECT {_NAME} || '_ACTIVE' AS slice_id, 'day' AS kind, count(event_id) AS n
FROM plan LEFT JOIN events ON CAST(ts AS DATE) = lo GROUP BY ALL"""

ORACLE["date_range"] = _with(OB, REG, TAGGED) + """
SELECT id, CAST(filing_date AS VARCHAR) AS filing_date, tag FROM tagged
WHERE tag = 'ACTIVE' AND filing_date >= DATE '1994-02-28' AND filing_date <= DATE '1996-02-29'"""

ORACLE["class_filter"] = _with(OB, REG) + """
SELECT id, niza_class FROM reg WHERE niza_class = '35'"""

ORACLE["state_tags"] = """
SELECT o_orderkey, CASE WHEN o_orderkey % 7 IN (0, 1, 3) THEN 'active' ELSE 'inactive' END AS state,
       CASE WHEN o_orderkey % 7 IN (0, 1, 3) THEN 'ACTIVE' ELSE 'INACTIVE' END AS tag,
       CASE WHEN o_orderkey % 7 IN (0, 1, 3) THEN '0' ELSE '1' END AS form_index
FROM orders"""

ORACLE["dmy_dates"] = """
SELECT o_orderkey,
       CASE o_orderkey % 5 WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d') WHEN 1 THEN '31/02/' || strftime(o_orderdate, '%Y')
         ELSE strftime(o_orderdate, '%d/%m/%Y') END AS text,
       CASE WHEN o_orderkey % 5 > 1 THEN CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS parsed,
       strftime(o_orderdate, '%d_%m_%Y') AS written
FROM orders"""

ORACLE["missing_key_rejects"] = _with(OB, SNAP) + """
SELECT 'snapshot' AS source, o_orderkey AS pos, CASE WHEN o_orderkey % 9 = 1 THEN '' END AS request_number,
       'request_number' AS "column", 'missing key' AS reason
FROM snap WHERE o_orderkey % 9 < 2"""

ORACLE["common_columns"] = """
SELECT c_name AS name, c_nationkey AS nation, c_acctbal AS balance FROM customer
UNION ALL SELECT s_name, s_nationkey, s_acctbal FROM supplier"""
