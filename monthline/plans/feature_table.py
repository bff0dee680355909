"""The feature table, kept up to date by series.

Series are dealt to buckets by a hash. A refresh finds the series that new parts of
the totals touch, builds the features of those alone from their stored totals, and
writes the buckets they lie in anew; the folders of all other buckets stay as they are.
A state table, replaced as a whole, names the current folder of each bucket and the
parts that its rows hold. Rows carry their place in their series; ids over the whole
table are made when they are asked for, from one count per series.
"""

from __future__ import annotations

import time
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from monthline import schemas
from monthline.functions import dates
from monthline.operators.features import SERIES, combine_agg, feature_rows
from monthline.operators.forecast import join_on_keys
from monthline.operators.row_id import running_total
from monthline.plans.layout import Layout
from monthline.plans.totals import BUCKETS, bucket_of, merged_batches, open_part_series, open_parts_of, part_sums
from monthline.session import freeze
from monthline.sources.tables import BATCH, folder_names, read_replaced, remove_folders, replace_table

_BUCKET, _VERSION, _PLACE = "bucket", "version", "place"
_STATE = T.StructType(
    [T.StructField(_BUCKET, T.IntegerType()), T.StructField(_VERSION, T.StringType()), T.StructField(BATCH, T.StringType()), T.StructField("buckets", T.IntegerType())]
)
_ROWS = T.StructType([f for f in schemas.FEATURE_STORE.fields if f.name != "feature_id"] + [T.StructField(_PLACE, T.LongType())])
_STORED = T.StructType(_ROWS.fields + [T.StructField(_BUCKET, T.IntegerType())])


def _state(spark: SparkSession, layout: Layout) -> DataFrame:
    return read_replaced(spark, layout.feature_state, _STATE, missing_ok=True)


def _folders(state: DataFrame) -> dict[int, str]:
    """Bucket -> version; as many rows as there are buckets."""
    return {row[_BUCKET]: row[_VERSION] for row in state.filter(F.col(_BUCKET).isNotNull()).select(_BUCKET, _VERSION).collect()}


def _read(spark: SparkSession, layout: Layout, folders: dict[int, str]) -> DataFrame:
    if not folders:
        return spark.createDataFrame([], _ROWS)
    paths = [f"{layout.feature_rows}/{_VERSION}={version}/{_BUCKET}={bucket}" for bucket, version in sorted(folders.items())]
    return spark.read.schema(_ROWS).parquet(*paths)


def stored_features(spark: SparkSession, layout: Layout) -> DataFrame:
    """The current feature rows, without ids over the whole table."""
    return _read(spark, layout, _folders(_state(spark, layout)))


def numbered_features(spark: SparkSession, layout: Layout) -> DataFrame:
    """The feature table with its dense id in brand, state, date order.

    A row's id is its place in its series after all rows of earlier series.
    """
    rows = stored_features(spark, layout)
    counts = rows.groupBy(*SERIES).agg(F.count(F.lit(1)).alias("_n"))
    offsets = running_total(counts, SERIES, "_n", "_before")
    numbered = join_on_keys(rows, offsets.select(*SERIES, "_before"), SERIES)
    return numbered.withColumn("feature_id", F.col("_before") + F.col(_PLACE)).select(*schemas.FEATURE_STORE.names)


def _features(totals: DataFrame, now: datetime | None) -> DataFrame:
    """Feature rows with their place in the series and the bucket of the series."""
    rows = feature_rows(totals, place=_PLACE)
    return rows.withColumn("created_at", dates.moment(now)).withColumn(_BUCKET, bucket_of()).select(*_STORED.names)


def refresh(spark: SparkSession, layout: Layout, now: datetime | None = None) -> list[int]:
    """Bring the feature table up to the parts there are; returns the buckets that were written."""
    state = freeze(_state(spark, layout))
    before = _folders(state)
    held = state.filter(F.col(BATCH).isNotNull()).select(BATCH)
    merged_unseen = merged_batches(spark, layout).join(held, BATCH, "left_anti")
    first = state.select("buckets").first()
    whole = first is None or first[0] != BUCKETS or not merged_unseen.isEmpty()
    if whole:
        # Nothing tells which series the merged parts touched, so all of them are built.
        made = _features(combine_agg(part_sums(spark, layout)), now)
        kept, buckets = {}, None
        new_parts = merged_batches(spark, layout).unionByName(open_parts_of(spark, layout))
        seen = new_parts
    else:
        new_parts = open_parts_of(spark, layout).join(held, BATCH, "left_anti")
        changed = freeze(open_part_series(spark, layout, new_parts).withColumn(_BUCKET, bucket_of()))
        buckets = sorted(row[_BUCKET] for row in changed.select(_BUCKET).distinct().collect())
        seen = held.unionByName(new_parts)
        kept = {b: v for b, v in before.items() if b not in set(buckets)}
        touched = changed.drop(_BUCKET)
        totals = combine_agg(join_on_keys(part_sums(spark, layout, buckets), touched, SERIES, "left_semi"))
        old = _read(spark, layout, {b: v for b, v in before.items() if b in set(buckets)})
        made = _features(totals, now).unionByName(
            join_on_keys(old, touched, SERIES, "left_anti").withColumn(_BUCKET, bucket_of()).select(*_STORED.names)
        )
    version = f"{time.time_ns():020d}"
    if buckets is None or buckets:
        made.repartition(F.col(_BUCKET)).write.partitionBy(_BUCKET).parquet(f"{layout.feature_rows}/{_VERSION}={version}")
    written = _written(spark, f"{layout.feature_rows}/{_VERSION}={version}")
    after = kept | dict.fromkeys(written, version)
    rows = [(bucket, folder, None, BUCKETS) for bucket, folder in sorted(after.items())]
    named = spark.createDataFrame([*rows, (None, None, None, BUCKETS)], _STATE)
    parts = freeze(seen.distinct()).select(
        F.lit(None).cast("int").alias(_BUCKET), F.lit(None).cast("string").alias(_VERSION), BATCH, F.lit(BUCKETS).alias("buckets")
    )
    replace_table(named.unionByName(parts), layout.feature_state)
    # Readers of the state before this one still find their folders.
    remove_folders(spark, layout.feature_rows, keep={f"{_VERSION}={v}" for v in {*after.values(), *before.values(), version}})
    return written


def _written(spark: SparkSession, path: str) -> list[int]:
    return sorted(int(name.split("=", 1)[1]) for name in folder_names(spark, path) if name.startswith(f"{_BUCKET}="))
