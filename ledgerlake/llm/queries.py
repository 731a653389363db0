"""The queries of this subpackage and the SQL of those that SQL can express."""

from __future__ import annotations

from .decontamination import op9_decontamination
from .exact_dedup import OP3_SQL, op3_exact_dedup
from .filter_audit import OP11_SQL, op11_filter_audit
from .licenses import op10_licenses
from .line_dedup import op8_line_dedup
from .ngram_join import OP1_SQL, op1_ngram_jaccard
from .packing import op13_packing
from .personal_data import op7_personal_data
from .piece_bpe import op4_piece_bpe
from .quality import op5_quality
from .substring_dedup import OP6_SQL, op6_substring_dedup
from .target_sampling import OP12_SQL, op12_target_sampling
from .toxicity import op2_toxicity

QUERIES = {
    "op1_ngram_jaccard": op1_ngram_jaccard,
    "op2_toxicity": op2_toxicity,
    "op3_exact_dedup": op3_exact_dedup,
    "op4_piece_bpe": op4_piece_bpe,
    "op5_quality": op5_quality,
    "op6_substring_dedup": op6_substring_dedup,
    "op7_personal_data": op7_personal_data,
    "op8_line_dedup": op8_line_dedup,
    "op9_decontamination": op9_decontamination,
    "op10_licenses": op10_licenses,
    "op11_filter_audit": op11_filter_audit,
    "op12_target_sampling": op12_target_sampling,
    "op13_packing": op13_packing,
}

ORACLE_SQL = {
    "op1_ngram_jaccard": OP1_SQL,
    "op3_exact_dedup": OP3_SQL,
    "op6_substring_dedup": OP6_SQL,
    "op11_filter_audit": OP11_SQL,
    "op12_target_sampling": OP12_SQL,
}
