"""Lags and rolling means within ordered series."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from monthline.operators.row_id import nulls_last, with_row_id

CHUNK_ROWS = 4_096


def with_history(
    df: DataFrame, keys: Sequence[str], order_cols: Sequence[str], value: str, depth: int = 3
) -> DataFrame:
    """Add ``lag_1..lag_depth`` and ``rolling_avg_<depth>`` (current row excluded).

    All columns share one window, hence one shuffle and one sort. For keys with a
    bounded number of rows; ``with_history_chunked`` is for any.
    """
    window = Window.partitionBy(*keys).orderBy(*nulls_last(order_cols))
    columns = {f"lag_{k}": F.lag(value, k).over(window) for k in range(1, depth + 1)}
    columns[f"rolling_avg_{depth}"] = F.avg(value).over(window.rowsBetween(-depth, -1))
    return df.withColumns(columns)


def with_history_chunked(
    df: DataFrame,
    keys: Sequence[str],
    order_cols: Sequence[str],
    value: str,
    depth: int = 3,
    chunk_rows: int = CHUNK_ROWS,
    position: str | None = None,
) -> DataFrame:
    """``with_history`` for series of any length, with equal results.

    ``position`` names a column for the place of each row in the (keys, order) sequence, counted from 0.

    Rows get their position in the global (keys, order) sequence, which is cut
    into chunks of fixed size. The last ``depth`` rows of a chunk are repeated at
    the head of the next, so every row finds its predecessors in its own chunk
    and no task depends on the length of a series.
    """
    placed = with_row_id(df, [*keys, *order_cols], "_pos").withColumn("_pos", F.col("_pos") - 1)
    home = F.floor(F.col("_pos") / chunk_rows)
    near_end = F.col("_pos") % chunk_rows >= chunk_rows - depth
    spread = placed.withColumn("_home", home).withColumn(
        "_chunk",
        F.explode(
            F.when(near_end, F.array("_home", F.col("_home") + 1)).otherwise(F.array("_home"))
        ),
    )
    window = Window.partitionBy("_chunk").orderBy("_pos")
    lags: dict[str, Column] = {}
    for k in range(1, depth + 1):
        same = reduce(
            lambda left, right: left & right,
            [F.lag(key, k).over(window).eqNullSafe(F.col(key)) for key in keys],
            F.lag("_pos", k).over(window).isNotNull(),
        )
        lags[f"lag_{k}"] = F.when(same, F.lag(value, k).over(window))
    oldest_first = [F.col(f"lag_{k}") for k in range(depth, 0, -1)]
    total = reduce(lambda a, b: a + b, [F.coalesce(c, F.lit(0.0)) for c in oldest_first])
    present = reduce(lambda a, b: a + b, [c.isNotNull().cast("int") for c in oldest_first])
    return (
        spread.withColumns(lags)
        .filter(F.col("_chunk") == F.col("_home"))
        .withColumn(f"rolling_avg_{depth}", F.try_divide(total, present))
        .withColumnsRenamed({"_pos": position} if position else {})
        .drop("_pos", "_home", "_chunk")
    )
