"""The registered queries of this subpackage and their DuckDB statements."""

from __future__ import annotations

from riskhouse.llm.bpe import op7_byte_bpe
from riskhouse.llm.crosstok import op11_token_alignment
from riskhouse.llm.decontaminate import ORACLE_OP4, op4_decontaminate
from riskhouse.llm.jaccard import op10_jaccard_join
from riskhouse.llm.kdtree import ORACLE_OP2, op2_exact_topk
from riskhouse.llm.langid import op3_language_id
from riskhouse.llm.lines import ORACLE_OP5, op5_line_dedup
from riskhouse.llm.passages import op1_substring_dedup
from riskhouse.llm.pii import op9_pii
from riskhouse.llm.quality import op13_quality
from riskhouse.llm.search import ORACLE_OP12, op12_lexical_search
from riskhouse.llm.toxicity import op6_toxicity
from riskhouse.llm.urls import ORACLE_OP8, op8_url_filter

QUERIES = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_exact_topk": op2_exact_topk,
    "op3_language_id": op3_language_id,
    "op4_decontaminate": op4_decontaminate,
    "op5_line_dedup": op5_line_dedup,
    "op6_toxicity": op6_toxicity,
    "op7_byte_bpe": op7_byte_bpe,
    "op8_url_filter": op8_url_filter,
    "op9_pii": op9_pii,
    "op10_jaccard_join": op10_jaccard_join,
    "op11_token_alignment": op11_token_alignment,
    "op12_lexical_search": op12_lexical_search,
    "op13_quality": op13_quality,
}

ORACLE: dict[str, str] = {
    "op2_exact_topk": ORACLE_OP2,
    "op4_decontaminate": ORACLE_OP4,
    "op5_line_dedup": ORACLE_OP5,
    "op8_url_filter": ORACLE_OP8,
    "op12_lexical_search": ORACLE_OP12,
}
