"""Queries of the corpus operators and their SQL, by name."""

from __future__ import annotations

from .compression import op12_compression_quality
from .hmm import op4_hmm_scores
from .jaccard import OP2_SQL, op2_count_tree_join
from .packing import op8_best_fit_packing
from .pieces import op9_piece_codec
from .quality import op1_perplexity_rules
from .ranked import OP13_SQL, op13_block_max_search
from .sharding import op7_feistel_sharding
from .syncmers import op10_closed_syncmers
from .toxicity import op3_nb_toxicity
from .urls import op5_link_trust
from .vectors import OP11_SQL, op11_gnat_codes
from .warc import OP6_SQL, op6_merkle_fixity

QUERIES = {f.__name__: f for f in (op1_perplexity_rules, op2_count_tree_join, op3_nb_toxicity, op4_hmm_scores, op5_link_trust, op6_merkle_fixity, op7_feistel_sharding, op8_best_fit_packing,
                                   op9_piece_codec, op10_closed_syncmers, op11_gnat_codes, op12_compression_quality, op13_block_max_search)}
ORACLE_SQL: dict[str, str] = {op2_count_tree_join.__name__: OP2_SQL, op6_merkle_fixity.__name__: OP6_SQL, op11_gnat_codes.__name__: OP11_SQL,
                              op13_block_max_search.__name__: OP13_SQL}
