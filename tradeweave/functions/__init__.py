from tradeweave.functions.columns import (
    like_pattern,
    matches_like,
    matches_regex,
    price_similarity,
    price_to_number,
)
from tradeweave.functions.similarity import indel_ratio, jaro_winkler, register_similarity

__all__ = [
    "indel_ratio",
    "jaro_winkler",
    "like_pattern",
    "matches_like",
    "matches_regex",
    "price_similarity",
    "price_to_number",
    "register_similarity",
]
