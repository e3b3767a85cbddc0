"""All queries of the subpackage, and the SQL of those that SQL can express."""

from __future__ import annotations

from gridyield.llm.queries_collocations import OP13_SQL, op13_collocations
from gridyield.llm.queries_license import op2_license_scan
from gridyield.llm.queries_language import op7_language_id
from gridyield.llm.queries_negatives import OP11_SQL, op11_hard_negatives
from gridyield.llm.queries_ngram import op6_ngram_join
from gridyield.llm.queries_pieces import op3_sentence_pieces
from gridyield.llm.queries_suffix import op10_suffix_dedup
from gridyield.llm.queries_superkmer import OP12_SQL, op12_superkmer_dedup
from gridyield.llm.queries_tokens import op8_token_files, op9_best_fit_packing
from gridyield.llm.queries_url import OP5_SQL, op5_url_filter
from gridyield.llm.queries_vectors import op1_embedding_dedup, op4_nearest_neighbours

QUERIES = {
    "op1_embedding_dedup": op1_embedding_dedup,
    "op2_license_scan": op2_license_scan,
    "op3_sentence_pieces": op3_sentence_pieces,
    "op4_nearest_neighbours": op4_nearest_neighbours,
    "op6_ngram_join": op6_ngram_join,
    "op8_token_files": op8_token_files,
    "op9_best_fit_packing": op9_best_fit_packing,
    "op7_language_id": op7_language_id,
    "op5_url_filter": op5_url_filter,
    "op10_suffix_dedup": op10_suffix_dedup,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_superkmer_dedup": op12_superkmer_dedup,
    "op13_collocations": op13_collocations,
}
ORACLES = {
    "op5_url_filter": OP5_SQL,
    "op11_hard_negatives": OP11_SQL,
    "op12_superkmer_dedup": OP12_SQL,
    "op13_collocations": OP13_SQL,
}
