"""Dense ids in a global order without a single-task sort."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from monthline.session import freeze

# monotonically_increasing_id keeps the row's place within its task in the low 33 bits.
_PLACE_BITS = 33


def nulls_last(columns: Sequence[str]) -> list[Column]:
    return [F.col(name).asc_nulls_last() for name in columns]


def _hashable(df: DataFrame) -> list[str]:
    """Columns that have a hash: all but maps and variants, also nested ones."""
    kinds = {field.name: field.dataType.simpleString() for field in df.schema}
    return [name for name, kind in kinds.items() if "map<" not in kind and "variant" not in kind]


def with_row_id(
    df: DataFrame,
    order_cols: Sequence[str],
    name: str = "feature_id",
    partitions: int | None = None,
) -> DataFrame:
    """Number all rows 1..n by ``order_cols`` (NULLs last).

    Rows are range-partitioned and sorted inside each partition, and the place of
    a row within its partition is frozen with the data: the sampled range bounds
    may differ when a partition is computed again. Only one count per partition
    is then summed up and broadcast, so its size is the number of partitions.

    Rows that agree in ``order_cols`` are told apart by their other columns, and
    full copies by the task they come from. A value or a copy that makes up a
    large part of the rows is therefore spread over many partitions, and a retried
    task sends each row where it went before.
    """
    order = [*nulls_last(order_cols), F.col("_tie"), F.col("_origin")]
    tied = df.withColumns({"_tie": F.xxhash64(*_hashable(df)), "_origin": F.spark_partition_id()})
    spread = tied.repartitionByRange(partitions, *order) if partitions else tied.repartitionByRange(*order)
    placed = freeze(
        spread.sortWithinPartitions(*order)
        .drop("_tie", "_origin")
        .withColumn("_slot", F.monotonically_increasing_id())
    )
    bucket = F.shiftright("_slot", _PLACE_BITS).alias("_bucket")
    earlier = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        placed.groupBy(bucket)
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select("_bucket", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"))
    )
    place = F.col("_slot").bitwiseAND(F.lit((1 << _PLACE_BITS) - 1))
    return (
        placed.withColumn("_bucket", bucket)
        .join(F.broadcast(starts), "_bucket")
        .select((F.col("_before") + place + 1).alias(name), *[F.col(c) for c in df.columns if c != name])
    )


def running_total(df: DataFrame, order_cols: Sequence[str], value: str, name: str) -> DataFrame:
    """Add the sum of ``value`` over all earlier rows in the order of ``order_cols`` (NULLs last), which are unique.

    Rows are range-partitioned and summed up inside each partition; only one sum per
    partition is added up over all of them.
    """
    order = nulls_last(order_cols)
    placed = freeze(df.repartitionByRange(*order).withColumn("_bucket", F.spark_partition_id()))
    inside = Window.partitionBy("_bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    earlier = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        placed.groupBy("_bucket")
        .agg(F.sum(value).alias("_sum"))
        .select("_bucket", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_before_bucket"))
    )
    return (
        placed.withColumn("_inside", F.coalesce(F.sum(value).over(inside), F.lit(0)))
        .join(F.broadcast(starts), "_bucket")
        .withColumn(name, F.col("_before_bucket") + F.col("_inside"))
        .drop("_bucket", "_inside", "_before_bucket")
    )
