"""Column expressions: all JVM-side, no Python in the rows' path."""

from recordlens.functions.records import epoch_span, repair_shifted, valid_code, whole_number
from recordlens.functions.text import (
    STOP_WORDS,
    folded,
    java_split_words,
    joined_text,
    split_words,
    term_counts,
    tokens,
    without_stop_words,
)

__all__ = [
    "STOP_WORDS",
    "epoch_span",
    "folded",
    "java_split_words",
    "joined_text",
    "repair_shifted",
    "split_words",
    "term_counts",
    "tokens",
    "valid_code",
    "whole_number",
    "without_stop_words",
]
