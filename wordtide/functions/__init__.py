"""Column functions: every one is a composition of built-in JVM expressions."""

from wordtide.functions.figures import (
    average,
    floor_at_one,
    floor_quotient,
    hundredths,
    two_decimals,
    whole_quotient,
)
from wordtide.functions.text import (
    has_words,
    is_long,
    is_long_negative,
    is_long_positive,
    is_positive,
    is_short,
    strip_punctuation,
    word_array,
)

__all__ = [
    "average",
    "floor_at_one",
    "floor_quotient",
    "has_words",
    "hundredths",
    "is_long",
    "is_long_negative",
    "is_long_positive",
    "is_positive",
    "is_short",
    "strip_punctuation",
    "two_decimals",
    "whole_quotient",
    "word_array",
]
