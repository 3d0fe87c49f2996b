"""Registered queries of this package and the SQL of those that SQL can express."""

from __future__ import annotations

from ledgerloom.llm.bit_files import op8_bit_files
from ledgerloom.llm.decontaminate import ORACLE_OP13, op13_decontaminate
from ledgerloom.llm.jaccard_join import op2_jaccard_join
from ledgerloom.llm.neighbours import op7_block_neighbours
from ledgerloom.llm.packing import op1_best_fit_packing
from ledgerloom.llm.phrases import ORACLE_OP11, op11_collocations
from ledgerloom.llm.sentence_pieces import op6_sentence_pieces
from ledgerloom.llm.suffix_dedup import op9_suffix_dedup
from ledgerloom.llm.token_counts import op3_token_counts
from ledgerloom.llm.toxicity import op4_toxicity
from ledgerloom.llm.vector_codes import ORACLE_OP12, op12_vector_codes
from ledgerloom.llm.vector_dedup import op5_vector_dedup
from ledgerloom.llm.warc import ORACLE_OP10, op10_warc

QUERIES = {
    "op1_best_fit_packing": op1_best_fit_packing,
    "op2_jaccard_join": op2_jaccard_join,
    "op3_token_counts": op3_token_counts,
    "op4_toxicity": op4_toxicity,
    "op5_vector_dedup": op5_vector_dedup,
    "op6_sentence_pieces": op6_sentence_pieces,
    "op7_block_neighbours": op7_block_neighbours,
    "op8_bit_files": op8_bit_files,
    "op9_suffix_dedup": op9_suffix_dedup,
    "op10_warc": op10_warc,
    "op11_collocations": op11_collocations,
    "op12_vector_codes": op12_vector_codes,
    "op13_decontaminate": op13_decontaminate,
}

ORACLES: dict[str, str] = {
    "op10_warc": ORACLE_OP10,
    "op11_collocations": ORACLE_OP11,
    "op12_vector_codes": ORACLE_OP12,
    "op13_decontaminate": ORACLE_OP13,
}
