from quarry.functions.text import TOKEN_PATTERN, analyse, tokens
from quarry.functions.distance import (
    edit_distance, edit_distance_to_literal, prefix_distance_to_literal,
)

__all__ = [
    "TOKEN_PATTERN", "analyse", "tokens",
    "edit_distance", "edit_distance_to_literal", "prefix_distance_to_literal",
]
