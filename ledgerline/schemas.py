"""Column lists, schemas and the fixed code tables of the registry model.

Everything here is data, not logic. Operators take these as default
parameters so a caller can swap any of them.
"""

from __future__ import annotations

from pyspark.sql import types as T

KEY = "request_number"
COUNTRY_COL = "badger_country"

# ---------------------------------------------------------------------------
# These must equal the source system's values for right results.
# ---------------------------------------------------------------------------

# Spanish month abbreviations as printed by the portal (trailing dot required).
MONTHS_ES = {
    "ene.": "01", "feb.": "02", "mar.": "03", "abr.": "04", "may.": "05", "jun.": "06",
    "jul.": "07", "ago.": "08", "sept.": "09", "oct.": "10", "nov.": "11", "dic.": "12",
}

# Raw portal status text (looked up lower-cased) -> registry status code.
STATUS_RAW = {
    "registrada": "VIGENTE", "cancelada": "CANCELADA", "anulado consejo de estado": "ANULADA",
    "caducado": "VENCIDA", "renuncia total": "RENUNCIA_TOTAL", "negada": "NEGADA",
    "desistida": "DESISTIDA", "abandonada": "ABANDONADA", "bajo examen de fondo": "EXAMEN_DE_FONDO",
    "bajo examen formal": "EXAMEN_DE_FORMA", "publicada": "EN_GACETA", "con oposición": "OPOSICION",
}

# Detail-page status text (looked up upper-cased) -> registry status code.
STATUS_CORRECTION = {
    "VIGENTE": "VIGENTE", "CANCELADA": "CANCELADA", "ANULADO CONSEJO DE ESTADO": "ANULADA",
    "CADUCADO": "VENCIDA", "RENUNCIA TOTAL": "RENUNCIA_TOTAL", "NEGADA": "NEGADA",
    "DESISTIDA": "DESISTIDA", "ABANDONADA": "ABANDONADA", "BAJO EXAMEN DE FONDO": "EXAMEN_DE_FONDO",
    "BAJO EXAMEN FORMAL": "EXAMEN_DE_FORMA", "PUBLICADA": "EN_GACETA", "CON OPOSICION": "OPOSICION",
}

# Registry statuses that count as live.
ACTIVE_STATES = (
    "EXAMEN_DE_FORMA", "SUSPENDIDA", "EN_GACETA", "EXAMEN_DE_FONDO",
    "OPOSICION", "CERTIFICADA_Y_ENVIADA", "IRREGULAR", "VIGENTE", "PROTEGIDA",
)

COUNTRY = "COLOMBIA"
NEW_RECORD = "NEW_RECORD"
SLICE_CAP = 2000
NOT_FOUND_ERROR = "Status not found on results page."
HEADER_WITH_FILING = "Fecha de radicación"
STATUS_LABELS = ("MainContent_ctrlTM_lblCurrentStatus", "MainContent_ctrlIRD_lblCurrentStatus")
GRID_ID = "MainContent_ctrlTMSearch_ctrlProcList_gvwIPCases"
COUNT_HEADER_ID = "MainContent_ctrlTMSearch_ctrlProcList_hdrNbItems"
DETAIL_PANEL_ID = "MainContent_ctrlTM_panelCaseData"
NO_RESULT_ID = "MainContent_ctrlTMSearch_divHelp"
IMAGE_SUFFIX = "&fmt=jpeg"

# Deployment setting, not a fixed value: where logo copies are served from.
DEFAULT_LOGO_PREFIX = "https://assets.invalid/logos/"

# ---------------------------------------------------------------------------
# Column lists
# ---------------------------------------------------------------------------

RAW_COLUMNS = [
    "request_number", "registry_number", "denomination", "logo_url", "filing_date",
    "expiration_date", "status", "holder", "niza_class", "gazette_number",
]

# Text fields that become "" when their key is absent from a raw record.
BLANK_WHEN_ABSENT = ["registry_number", "denomination", "logo_url", "niza_class", "gazette_number"]

NORMALISED_COLUMNS = [
    "request_number", "registry_number", "denomination", "logo_url", "logo", "filing_date",
    "expiration_date", "status", "holder", "niza_class", "gazette_number", "updated_at",
    "badger_country",
]

REGISTRY_COLUMNS = ["id"] + NORMALISED_COLUMNS

COMPARED = [
    "registry_number", "denomination", "logo_url", "filing_date", "expiration_date",
    "status", "holder", "niza_class", "gazette_number",
]

UPDATED = COMPARED + ["updated_at"]

# Columns an insert writes but an update never touches.
INSERT_ONLY = ["id", "logo", "badger_country"]

REPORT_COLUMNS = ["request_number", "changed", "columns_changed"]

REGISTRY_SCHEMA = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("request_number", T.StringType()),
    T.StructField("registry_number", T.StringType()),
    T.StructField("denomination", T.StringType()),
    T.StructField("logo_url", T.StringType()),
    T.StructField("logo", T.StringType()),
    T.StructField("filing_date", T.DateType()),
    T.StructField("expiration_date", T.DateType()),
    T.StructField("status", T.StringType()),
    T.StructField("holder", T.StringType()),
    T.StructField("niza_class", T.StringType()),
    T.StructField("gazette_number", T.StringType()),
    T.StructField("updated_at", T.TimestampType()),
    T.StructField("badger_country", T.StringType()),
])

CORRECTION_SCHEMA = T.StructType([
    T.StructField("request_number", T.StringType()),
    T.StructField("extracted_status", T.StringType()),
    T.StructField("error", T.StringType()),
])

SLICE_SCHEMA = T.StructType([
    T.StructField("slice_id", T.StringType()),
    T.StructField("lo", T.DateType()),
    T.StructField("hi", T.DateType()),
    T.StructField("tag", T.StringType()),
    T.StructField("kind", T.StringType()),
])
