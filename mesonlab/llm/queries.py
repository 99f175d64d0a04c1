"""The registered queries of this subpackage and the DuckDB SQL of those that
SQL can express."""

from __future__ import annotations

from mesonlab.llm.alignment import op12_alignment
from mesonlab.llm.decontaminate import ORACLE_OP2, op2_decontamination
from mesonlab.llm.embeddings import op8_embeddings
from mesonlab.llm.html import op9_html
from mesonlab.llm.language import op10_language
from mesonlab.llm.lexical import ORACLE_OP13, op13_lexical_search
from mesonlab.llm.lines import op6_lines
from mesonlab.llm.minhash import op4_near_duplicates
from mesonlab.llm.neighbours import op11_neighbours
from mesonlab.llm.packing import op3_packing
from mesonlab.llm.pii import op1_pii
from mesonlab.llm.quality import op5_quality
from mesonlab.llm.suffixtree import op7_lm_score

QUERIES = {"op1_pii": op1_pii, "op2_decontamination": op2_decontamination, "op3_packing": op3_packing, "op4_near_duplicates": op4_near_duplicates,
           "op5_quality": op5_quality, "op6_lines": op6_lines, "op7_lm_score": op7_lm_score,
           "op8_embeddings": op8_embeddings, "op9_html": op9_html, "op10_language": op10_language,
           "op11_neighbours": op11_neighbours, "op12_alignment": op12_alignment, "op13_lexical_search": op13_lexical_search}
ORACLE_SQL = {"op2_decontamination": ORACLE_OP2, "op13_lexical_search": ORACLE_OP13}
