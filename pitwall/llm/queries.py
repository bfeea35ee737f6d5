"""Registered queries of this subpackage, and DuckDB SQL where SQL expresses the result."""

from __future__ import annotations

from .decontam import OP5_SQL, op5_decontaminate
from .embed import OP6_SQL, op6_embedding_dedup
from .importance import OP13_SQL, op13_importance_resampling
from .langid import op4_language_id
from .license import op2_license_scan
from .mixing import OP9_SQL, op9_mix_sources
from .negatives import OP11_SQL, op11_hard_negatives
from .partenum import OP1_SQL, op1_partenum_join
from .substring import OP8_SQL, op8_substring_dedup
from .suffix_tree import op10_lm_scores
from .tokens import op3_token_counts
from .toxicity import op12_toxicity
from .warc import op7_warc

QUERIES = {
    "op1_partenum_join": op1_partenum_join,
    "op2_license_scan": op2_license_scan,
    "op3_token_counts": op3_token_counts,
    "op4_language_id": op4_language_id,
    "op5_decontaminate": op5_decontaminate,
    "op6_embedding_dedup": op6_embedding_dedup,
    "op7_warc": op7_warc,
    "op8_substring_dedup": op8_substring_dedup,
    "op9_mix_sources": op9_mix_sources,
    "op10_lm_scores": op10_lm_scores,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_toxicity": op12_toxicity,
    "op13_importance_resampling": op13_importance_resampling,
}

ORACLE = {
    "op1_partenum_join": OP1_SQL,
    "op5_decontaminate": OP5_SQL,
    "op6_embedding_dedup": OP6_SQL,
    "op8_substring_dedup": OP8_SQL,
    "op9_mix_sources": OP9_SQL,
    "op11_hard_negatives": OP11_SQL,
    "op13_importance_resampling": OP13_SQL,
}
