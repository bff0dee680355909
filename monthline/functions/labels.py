"""Numbers to status labels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F


def label_below(value: Column, limits: Sequence[tuple[float, str]], otherwise: str) -> Column:
    """Label of the first limit that ``value`` lies below; NULL values get ``otherwise``."""
    label = F.lit(otherwise)
    for limit, name in reversed(limits):
        label = F.when(value < limit, F.lit(name)).otherwise(label)
    return label


def label_above(value: Column, limits: Sequence[tuple[float, str]], otherwise: str) -> Column:
    """Label of the first limit that ``value`` exceeds; list the largest limit first."""
    label = F.lit(otherwise)
    for limit, name in reversed(limits):
        label = F.when(value > limit, F.lit(name)).otherwise(label)
    return label
