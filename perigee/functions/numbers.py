"""Strict reading of numbers out of text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The number alone, between blanks; anything else gives the empty text, which casts to NULL.
_DECIMAL = r"(?U)^[\s\x1c-\x1f]*([+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?)[\s\x1c-\x1f]*$"
_INTEGER = r"(?U)^[\s\x1c-\x1f]*([+-]?[0-9]+)[\s\x1c-\x1f]*$"


def to_double(text: Column) -> Column:
    """A finite double, or NULL, of any length. Type suffixes, digit separators, NaN and infinities are
    malformed, and so is a number too large for a double."""
    value = F.array(F.regexp_extract(text, _DECIMAL, 1).try_cast("double"))
    # Infinities leave the list, so the text is read once; a comparison would hold the expression twice.
    return F.get(F.array_remove(F.array_remove(value, float("inf")), float("-inf")), 0)


def to_bigint(text: Column) -> Column:
    """A whole number, or NULL; `3.7` is malformed, not rounded."""
    return F.regexp_extract(text, _INTEGER, 1).try_cast("bigint")


def above(value: Column, minimum: float) -> Column:
    return F.when(value > minimum, value)


def nan_to_null(value: Column) -> Column:
    return F.when(~F.isnan(value), value)
