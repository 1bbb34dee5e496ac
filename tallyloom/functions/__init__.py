"""Column helpers built from native Spark expressions."""

from tallyloom.functions.numbers import (
    bilinear,
    dot,
    fixed_text,
    half_up_ratio,
    hit_rate,
    integer_quotient,
    logistic,
    outer_product,
    sign,
    squared_distance,
)
from tallyloom.functions.text import WORD_BREAK, first_char, words

__all__ = [
    "WORD_BREAK",
    "bilinear",
    "dot",
    "first_char",
    "fixed_text",
    "half_up_ratio",
    "hit_rate",
    "integer_quotient",
    "logistic",
    "outer_product",
    "sign",
    "squared_distance",
    "words",
]
