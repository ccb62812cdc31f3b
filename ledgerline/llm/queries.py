"""The registered queries of this subpackage and their DuckDB SQL where SQL can express them."""

from __future__ import annotations

from ledgerline.llm.ann import op9_approximate_nearest_neighbours
from ledgerline.llm.collocations import op13_phrase_collocation_mining
from ledgerline.llm.decontam import op12_benchmark_decontamination
from ledgerline.llm.gridjoin import op6_embedding_near_dedup
from ledgerline.llm.lm import op8_lm_scoring
from ledgerline.llm.mixing import op4_mixing_sources
from ledgerline.llm.neardup import op10_minhash_near_dedup
from ledgerline.llm.oracle import ORACLE  # noqa: F401
from ledgerline.llm.packing import op3_best_fit_packing
from ledgerline.llm.pii import op7_pii_surrogates
from ledgerline.llm.quality import op1_quality_classifier
from ledgerline.llm.secrets import op5_secret_scans
from ledgerline.llm.spelling import op11_spelling_variant_grouping
from ledgerline.llm.substrings import op2_suffix_array_dedup

QUERIES = {f.__name__: f for f in (
    op1_quality_classifier, op3_best_fit_packing, op4_mixing_sources, op5_secret_scans,
    op10_minhash_near_dedup, op2_suffix_array_dedup,
    op6_embedding_near_dedup, op9_approximate_nearest_neighbours,
    op7_pii_surrogates, op8_lm_scoring,
    op11_spelling_variant_grouping, op12_benchmark_decontamination, op13_phrase_collocation_mining)}
