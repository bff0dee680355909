"""Tolerant numeric parsing and ratio arithmetic."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from monthline.functions.text import strip_commas


def to_amount(col: Column) -> Column:
    """decimal(15,2) from text with optional thousands commas; NULL if it is no number."""
    return strip_commas(col).try_cast("decimal(15,2)")


def to_whole(col: Column) -> Column:
    """Integer from text, fractions rounded; NULL if it is no number."""
    return col.try_cast("decimal(38,0)").try_cast("int")


def percent_of(part: Column, whole: Column) -> Column:
    """part / whole * 100; NULL for a zero whole."""
    return F.try_divide(part.cast("double"), whole.cast("double")) * F.lit(100.0)


def percent_below(reference: Column, value: Column) -> Column:
    """How far value lies below reference, in percent of reference."""
    return percent_of(reference - value, reference)
