"""Importing this module registers every query of the subpackage."""

from sitrec.llm import (  # noqa: F401
    q_exact_dedup,
    q_fertility,
    q_language,
    q_mixing,
    q_packing,
    q_piece_counts,
    q_quality_fm,
    q_set_sketch,
    q_simhash,
    q_spelling,
    q_suffix_dedup,
    q_token_files,
    q_whitening,
)
from sitrec.llm.registry import QUERIES, SQL  # noqa: F401
