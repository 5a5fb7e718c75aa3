"""Registered queries of this subpackage (``QUERIES``) and their DuckDB SQL (``ORACLE``)."""

from lakecraft.llm.fingerprint import op7_document_fingerprints
from lakecraft.llm.infill import OP13_SQL, op13_infill
from lakecraft.llm.language import op1_language_id
from lakecraft.llm.licenses import op10_license_scan
from lakecraft.llm.minhash import OP6_SQL, op6_minhash_near_dedup
from lakecraft.llm.mixing import op2_source_mixing
from lakecraft.llm.nearest import op8_nearest_neighbours
from lakecraft.llm.negatives import OP11_SQL, op11_hard_negatives
from lakecraft.llm.packing import op3_best_fit_packing
from lakecraft.llm.sharding import op5_sharding
from lakecraft.llm.substring import OP9_SQL, op9_substring_dedup
from lakecraft.llm.toxicity import op4_toxicity
from lakecraft.llm.urls import OP12_SQL, op12_url_filter

QUERIES = {
    "op1_language_id": op1_language_id,
    "op2_source_mixing": op2_source_mixing,
    "op3_best_fit_packing": op3_best_fit_packing,
    "op4_toxicity": op4_toxicity,
    "op5_sharding": op5_sharding,
    "op6_minhash_near_dedup": op6_minhash_near_dedup,
    "op7_document_fingerprints": op7_document_fingerprints,
    "op8_nearest_neighbours": op8_nearest_neighbours,
    "op9_substring_dedup": op9_substring_dedup,
    "op10_license_scan": op10_license_scan,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_url_filter": op12_url_filter,
    "op13_infill": op13_infill,
}

ORACLE: dict[str, str] = {
    "op6_minhash_near_dedup": OP6_SQL,
    "op9_substring_dedup": OP9_SQL,
    "op11_hard_negatives": OP11_SQL,
    "op12_url_filter": OP12_SQL,
    "op13_infill": OP13_SQL,
}
