"""Text clean-up and text predicates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from monthline.functions import fixed


def upper_trim(col: Column) -> Column:
    return F.upper(F.trim(col))


def part(col: Column, index: int, separator: str = "-") -> Column:
    """The index-th piece (from 1); '' when there are fewer pieces.

    The first two pieces, which every sales row needs several times, are cut out
    directly: ``split_part`` builds the array of all pieces, which costs about
    ten times as much.
    """
    if index == 1:
        return F.substring_index(col, separator, 1)
    if index == 2:
        second = F.substring_index(F.substring_index(col, separator, 2), separator, -1)
        return F.when(F.contains(col, F.lit(separator)), second).when(col.isNotNull(), F.lit(""))
    return F.split_part(col, F.lit(separator), F.lit(index))


def strip_commas(col: Column) -> Column:
    return F.replace(col, F.lit(","), F.lit(""))


def null_if_token(col: Column, tokens: Sequence[str] = fixed.NULL_TOKENS) -> Column:
    return F.when(col.isin(*tokens), F.lit(None)).otherwise(col)


def is_number_text(col: Column) -> Column:
    """True when the text without commas reads as a floating-point number; never NULL."""
    return F.coalesce(strip_commas(col).rlike(fixed.NUMBER_PATTERN), F.lit(False))


def is_month_text(col: Column) -> Column:
    return F.coalesce(F.upper(col).rlike(fixed.MONTH_PATTERN), F.lit(False))


def is_fiscal_year_text(col: Column) -> Column:
    return F.coalesce(col.rlike(fixed.FISCAL_YEAR_PATTERN), F.lit(False))


def fixed2_text(col: Column) -> Column:
    """Two decimals, no exponent, no grouping; a number that is too large for that is written as it is."""
    return F.coalesce(col.try_cast("decimal(38,2)").cast("string"), col.cast("string"))


def grouped_text(col: Column, decimals: int = 0) -> Column:
    """Thousands separators, for report text."""
    return F.format_number(col, decimals)
