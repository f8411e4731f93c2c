"""Column expressions shared by the operators (all built-in Spark SQL functions)."""

from hitlens.functions.text import (
    blank_if_null,
    label,
    length_gap,
    normalise_artist,
    parsed,
    split_words,
    strip_commas,
    text_equals,
)

__all__ = [
    "blank_if_null",
    "label",
    "length_gap",
    "normalise_artist",
    "parsed",
    "split_words",
    "strip_commas",
    "text_equals",
]
