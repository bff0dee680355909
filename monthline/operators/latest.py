"""Newest rows: top-n overall and newest row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def latest(df: DataFrame, order_col: str, n: int = 10, tie: str = "id") -> DataFrame:
    """The n newest rows, newest first; rows of equal time by larger ``tie``."""
    order = [F.col(order_col).desc_nulls_last()]
    if tie in df.columns:
        order.append(F.col(tie).desc_nulls_last())
    return df.orderBy(*order).limit(n)


def newest(value: Column, when_true: Column | None, *order: str) -> Column:
    """Aggregate: ``value`` of the newest row for which ``when_true`` holds.

    Map-side combinable, so a key that owns a large share of the rows costs one
    partial result per task.
    """
    rank = F.struct(*order)
    return F.max_by(value, rank if when_true is None else F.when(when_true, rank))


def newest_per_key(df: DataFrame, keys: Sequence[str], *order: str) -> DataFrame:
    """The newest whole row of every key."""
    row = F.struct(*df.columns)
    return df.groupBy(*keys).agg(newest(row, None, *order).alias("_row")).select("_row.*")


def latest_with_status(
    registry: DataFrame, status: str, keys: Sequence[str] = ("model_name",)
) -> DataFrame:
    """Newest registry row with ``status`` per key; equal dates by larger model_id."""
    return newest_per_key(
        registry.filter(F.col("status") == status), keys, "training_date", "model_id"
    )
