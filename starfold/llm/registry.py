"""The registered queries of this subpackage and their SQL twins."""

from __future__ import annotations

import corpus_pipeline

from .chunk_dedup import OP9_SQL, op9_exact_dedup
from .chunk_middle import OP13_SQL, op13_chunk_middle
from .host_reputation import OP3_SQL, op3_host_reputation
from .jaccard_join import op4_jaccard_join
from .label_sharding import op1_label_sharding
from .neighbour_vote import op11_neighbour_vote
from .pivot_codes import OP12_SQL, op12_pivot_codes
from .pseudo_likelihood import op6_pseudo_likelihood
from .quality_forest import op10_quality_forest
from .source_mix import OP8_SQL, op8_source_mix
from .suffix_dedup import op2_suffix_dedup
from .token_counts import op5_token_counts
from .window_packing import op7_window_packing

QUERIES = {
    "op1_label_sharding": op1_label_sharding,
    "op2_suffix_dedup": op2_suffix_dedup,
    "op3_host_reputation": op3_host_reputation,
    "op4_jaccard_join": op4_jaccard_join,
    "op5_token_counts": op5_token_counts,
    "op6_pseudo_likelihood": op6_pseudo_likelihood,
    "op7_window_packing": op7_window_packing,
    "op8_source_mix": op8_source_mix,
    "op9_exact_dedup": op9_exact_dedup,
    "op10_quality_forest": op10_quality_forest,
    "op11_neighbour_vote": op11_neighbour_vote,
    "op12_pivot_codes": op12_pivot_codes,
    "op13_chunk_middle": op13_chunk_middle,
    "pipeline": corpus_pipeline.run,
}

# Twins that DuckDB can run; the other queries are tested against brute force.
ORACLE: dict[str, str] = {
    "op3_host_reputation": OP3_SQL,
    "op8_source_mix": OP8_SQL,
    "op9_exact_dedup": OP9_SQL,
    "op12_pivot_codes": OP12_SQL,
    "op13_chunk_middle": OP13_SQL,
}
if corpus_pipeline.ORACLE_SQL is not None:
    ORACLE["pipeline"] = corpus_pipeline.ORACLE_SQL
