"""Queries of this folder, and DuckDB SQL where it can express them."""

from .cotraining import op4_cotraining
from .hidden_markov import op2_hidden_markov
from .jaccard_join import op1_jaccard_join
from .license_scan import op5_license_scan
from .media_columns import op10_media_columns
from .packing import op9_best_fit_packing
from .piece_transducer import op6_piece_transducer
from .quality_rules import op3_quality_rules
from .sharding import op8_sharding
from .suffix_dedup import op7_suffix_dedup

QUERIES = {
    "op1_jaccard_join": op1_jaccard_join,
    "op2_hidden_markov": op2_hidden_markov,
    "op3_quality_rules": op3_quality_rules,
    "op4_cotraining": op4_cotraining,
    "op5_license_scan": op5_license_scan,
    "op6_piece_transducer": op6_piece_transducer,
    "op7_suffix_dedup": op7_suffix_dedup,
    "op8_sharding": op8_sharding,
    "op9_best_fit_packing": op9_best_fit_packing,
    "op10_media_columns": op10_media_columns,
}

ORACLES: dict[str, str] = {}
