"""Queries of the subpackage, each over its whole table."""

from __future__ import annotations

from patronage.llm.alignment import op12_alignment
from patronage.llm.bpe import op2_bpe
from patronage.llm.exact_dedup import OP8_SQL, op8_exact_dedup
from patronage.llm.language_id import op3_language_id
from patronage.llm.lm_score import op9_lm_score
from patronage.llm.mixing import op13_mixing
from patronage.llm.nn_descent import op4_nn_descent
from patronage.llm.packing import op1_packing
from patronage.llm.quality import op5_quality
from patronage.llm.resampling import op11_resampling
from patronage.llm.simhash import op7_simhash
from patronage.llm.substring import op10_substring
from patronage.llm.warc import op6_warc

QUERIES = {
    "op1_packing": op1_packing,
    "op2_bpe": op2_bpe,
    "op3_language_id": op3_language_id,
    "op4_nn_descent": op4_nn_descent,
    "op5_quality": op5_quality,
    "op6_warc": op6_warc,
    "op7_simhash": op7_simhash,
    "op8_exact_dedup": op8_exact_dedup,
    "op9_lm_score": op9_lm_score,
    "op10_substring": op10_substring,
    "op11_resampling": op11_resampling,
    "op12_alignment": op12_alignment,
    "op13_mixing": op13_mixing,
}

ORACLE_SQL = {
    "op8_exact_dedup": OP8_SQL,
}
