"""Monthly totals kept as sums of parts: one part per batch, negative ones for replaced files.

A part is never changed. Files that a later version replaces are taken back by a part
with their negative totals, which names the batch and the file version it takes back.
Many parts are merged into a table of current totals, a new version under a pointer; it
also lists the batches and the file versions that its sums hold, so a merged part
whose folder is still there, or comes again, is not counted twice.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from monthline import schemas
from monthline.operators.features import SERIES, agg_sales, clean_sales, combine_agg
from monthline.plans.layout import Layout
from monthline.plans.load import landed_files, landed_rows, superseded_files
from monthline.sources.file_list import FILE, FILE_FIELDS
from monthline.sources.tables import BATCH, batch_folders, read_log, read_replaced, replace_partitions, replace_table, remove_batches

#: So many parts may lie side by side before they are merged.
MAX_PARTS = 32

_TAKEN_BATCH = "taken_batch"
_UNIT = [_TAKEN_BATCH, *FILE]
_UNIT_FIELDS = [T.StructField(_TAKEN_BATCH, T.StringType()), *FILE_FIELDS]
_PART = T.StructType(schemas.AGG_SALES.fields + _UNIT_FIELDS)
_WITH_BATCH = T.StructType(_PART.fields + [T.StructField(BATCH, T.StringType())])
_SUMS, _ONE_BATCH, _ONE_UNIT = "sums", "batch", "unit"
_KIND, _BUCKET = "kind", "bucket"
_MERGED = T.StructType(_WITH_BATCH.fields + [T.StructField(_KIND, T.StringType()), T.StructField(_BUCKET, T.IntegerType())])
#: Series are dealt to so many buckets by a hash.
BUCKETS = 64


def _merged(spark: SparkSession, layout: Layout) -> DataFrame:
    return read_replaced(spark, layout.agg_merged, _MERGED, missing_ok=True)


def merged_batches(spark: SparkSession, layout: Layout) -> DataFrame:
    return _merged(spark, layout).filter(F.col(_KIND) == _ONE_BATCH).select(BATCH)


def _open_parts(spark: SparkSession, layout: Layout) -> DataFrame:
    """Parts that are not merged yet."""
    return read_log(spark, layout.agg_parts, _PART).join(merged_batches(spark, layout), BATCH, "left_anti")


def open_parts_of(spark: SparkSession, layout: Layout) -> DataFrame:
    """The batches whose parts are not merged yet."""
    return _open_parts(spark, layout).select(BATCH).distinct()


def open_part_series(spark: SparkSession, layout: Layout, batches: DataFrame) -> DataFrame:
    """The series that the open parts of some batches touch."""
    rows = _open_parts(spark, layout).filter("transaction_count != 0")
    return rows.join(batches, BATCH, "left_semi").select(*SERIES).distinct()


def bucket_of() -> Column:
    """The bucket of a row's series."""
    return F.pmod(F.xxhash64(*SERIES), F.lit(BUCKETS)).cast("int")


def part_sums(spark: SparkSession, layout: Layout, buckets: Sequence[int] | None = None) -> DataFrame:
    """The merged sums and all open parts; of the series in some buckets, if asked.

    The merged sums lie in a folder per bucket, so the others are not read.
    """
    merged, parts = _merged(spark, layout).filter(F.col(_KIND) == _SUMS), _open_parts(spark, layout)
    if buckets is not None:
        merged, parts = merged.filter(F.col(_BUCKET).isin(list(buckets))), parts.filter(bucket_of().isin(list(buckets)))
    return merged.select(*schemas.AGG_SALES.names).unionByName(parts.select(*schemas.AGG_SALES.names))


def monthly_totals(spark: SparkSession, layout: Layout) -> DataFrame:
    """Monthly totals of all current files."""
    return combine_agg(part_sums(spark, layout))


def _taken_back(spark: SparkSession, layout: Layout) -> DataFrame:
    """(batch, file version) of the replaced files whose totals have been taken back."""
    open_units = _open_parts(spark, layout).filter(F.col(_TAKEN_BATCH).isNotNull()).select(*_UNIT)
    merged_units = _merged(spark, layout).filter(F.col(_KIND) == _ONE_UNIT).select(*_UNIT)
    return open_units.unionByName(merged_units).distinct()


def aggregate_pending(spark: SparkSession, layout: Layout, again: str | None = None) -> None:
    """Store the totals of every landed batch that has none yet, and take back replaced files, in one write.

    ``again`` names a batch whose part is made anew, as a replay does. Batches are read
    in one scan, however many are pending; each gets a part, also without a row.
    """
    rows = landed_rows(spark, layout)
    landed = landed_files(spark, layout).select(BATCH).distinct()
    done = read_log(spark, layout.agg_parts, _PART).select(BATCH).distinct().unionByName(merged_batches(spark, layout))
    if again is not None:
        done = done.filter(F.col(BATCH) != again).unionByName(merged_batches(spark, layout).filter(F.col(BATCH) == again))
    pending = landed.join(done, BATCH, "left_anti")
    units = superseded_files(spark, layout).withColumnRenamed(BATCH, _TAKEN_BATCH)
    replaced = units.join(_taken_back(spark, layout), _UNIT, "left_anti")
    # Names of batches go to the driver, which lists their folders: no other folder is read.
    taken = [row[_TAKEN_BATCH] for row in replaced.select(_TAKEN_BATCH).distinct().collect()]
    names = sorted(row[BATCH] for row in pending.collect())
    if not taken and not names:
        return
    parts = _own_parts(rows, names)
    if taken:
        parts = parts.unionByName(_negative_parts(rows.filter(F.col(BATCH).isin(taken)), replaced))
    replace_partitions(parts, layout.agg_parts, BATCH)


def _empty_totals() -> dict:
    kinds = {f.name: f.dataType for f in schemas.AGG_SALES}
    return {name: F.lit(0 if name in ("total_sales", "transaction_count") else None).cast(kind) for name, kind in kinds.items()}


def _own_parts(rows: DataFrame, names: Sequence[str]) -> DataFrame:
    totals = agg_by(rows.filter(F.col(BATCH).isin(list(names))), [BATCH])
    listed = F.array(*[F.lit(name) for name in names]).cast("array<string>")
    marks = rows.sparkSession.range(1).select(F.explode(listed).alias(BATCH)).withColumns(_empty_totals())
    units = {f.name: F.lit(None).cast(f.dataType) for f in _UNIT_FIELDS}
    return totals.unionByName(marks).withColumns(units).select(*_WITH_BATCH.names)


def _negative_parts(rows: DataFrame, replaced: DataFrame) -> DataFrame:
    of_files = rows.withColumnRenamed(BATCH, _TAKEN_BATCH).join(F.broadcast(replaced), _UNIT, "left_semi")
    totals = agg_by(of_files, _UNIT)
    negative = totals.withColumns({name: -F.col(name) for name in ("total_sales", "transaction_count")})
    marks = replaced.withColumns(_empty_totals())
    name = f"replaced-{uuid.uuid4().hex}"
    return negative.unionByName(marks).withColumn(BATCH, F.lit(name)).select(*_WITH_BATCH.names)


def agg_by(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``agg_sales`` of the cleaned rows, for each value of ``keys`` by itself."""
    return agg_sales(clean_sales(rows, keys), keys)


def merge_parts(spark: SparkSession, layout: Layout, max_parts: int = MAX_PARTS) -> bool:
    """Merge the parts when there are more than ``max_parts``; True if it did.

    The new version is whole before the pointer names it, and the folders go only
    after that. Where this ends half-way, either the folders or the list of merged
    batches tell what is counted.
    """
    folders = batch_folders(spark, layout.agg_parts)
    if len(folders) <= max_parts:
        return False
    nothing = {f.name: F.lit(None).cast(f.dataType) for f in _MERGED}

    def of_kind(rows: DataFrame, kind: str) -> DataFrame:
        return rows.withColumns({n: c for n, c in nothing.items() if n not in rows.columns} | {_KIND: F.lit(kind)}).select(*_MERGED.names)

    batches = merged_batches(spark, layout).unionByName(_open_parts(spark, layout).select(BATCH).distinct())
    whole = (
        of_kind(monthly_totals(spark, layout).withColumn(_BUCKET, bucket_of()), _SUMS)
        .unionByName(of_kind(batches, _ONE_BATCH))
        .unionByName(of_kind(_taken_back(spark, layout), _ONE_UNIT))
    )
    replace_table(whole.repartition(_KIND, _BUCKET), layout.agg_merged, [_KIND, _BUCKET])
    remove_batches(spark, layout.agg_parts, folders)
    return True
