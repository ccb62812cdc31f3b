"""Scalar column expressions."""

from ledgerline.functions.codes import (  # noqa: F401
    logo_asset, map_correction_status, map_literal, map_status, normalise_state,
    state_index, state_tag, surrogate_id,
)
from ledgerline.functions.dates import (  # noqa: F401
    bad_date, coerce_date, es_date_text, format_dmy, parse_dmy, parse_es_date,
)
from ledgerline.functions.text import (  # noqa: F401
    clean_text, dom_text, coalesce_blank, collapse_ws, compare_key,
    non_blank, normalise_holder, normalise_name, py_strip, strip_tags,
)
