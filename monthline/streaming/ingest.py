"""New sales files to landed rows, monthly totals and, if wanted, a full run."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from monthline.plans.layout import Layout
from monthline.plans.load import land_files, raw_sales
from monthline.plans.totals import aggregate_pending
from monthline.plans.train import run_pipeline
from monthline.functions.dates import moment
from monthline.sources.file_list import stream_files
from monthline.sources.tables import append_log

FILES_TRIGGER = "NEW_FILES"


def trigger_rows(spark: SparkSession, new_rows: int, now: datetime | None, kind: str = FILES_TRIGGER) -> DataFrame:
    return spark.range(1).select(
        moment(now).alias("run_time"),
        F.lit(new_rows).cast("long").alias("new_rows"),
        F.lit(kind).alias("trigger_type"),
    )


def batch_handler(
    out_root: str,
    clock: Callable[[], datetime] | None = None,
    train: bool = True,
    name: str | None = None,
) -> Callable[[DataFrame, int], None]:
    """Work for one micro-batch of listed files. Everything it writes is filed under ``name``, or the query's id, and the batch id.

    The query's id lasts as long as its checkpoint; landing refuses a name that other files have used. A replayed micro-batch overwrites
    its own folders, so each row counts once; another stream into the same
    folder, or one whose checkpoint was reset, cannot touch them. Without loaded rows nothing runs downstream and no trigger is logged.
    """
    layout = Layout(out_root)
    clock = clock or (lambda: datetime.now().replace(microsecond=0))

    def handle(files: DataFrame, batch_id: int) -> None:
        spark = files.sparkSession
        stream = name or spark.sparkContext.getLocalProperty("sql.streaming.queryId")
        if not stream:
            raise ValueError("a stream without a query id needs a name")
        now, batch = clock(), f"{stream}-{batch_id}"
        land_files(files, layout, batch, now)
        new_rows = raw_sales(spark, layout, batch).count()
        if new_rows == 0:
            return
        append_log(trigger_rows(spark, new_rows, now), layout.trigger_log, batch)
        aggregate_pending(spark, layout, batch)
        if train:
            run_pipeline(spark, out_root, now, batch)

    return handle


def run_stream(
    spark: SparkSession,
    in_dir: str,
    out_root: str,
    checkpoint: str,
    available_now: bool = True,
    *,
    interval: str = "5 minutes",
    clock: Callable[[], datetime] | None = None,
    train: bool = True,
    max_files: int | None = None,
    name: str | None = None,
) -> StreamingQuery:
    """Pick up each new file once: all that are there now, or one batch per interval.

    The stream carries the files' names only; a file is opened when its batch is landed. It
    sees each path once: corrected files are for ``validate_and_load``.
    """
    writer = (
        stream_files(spark, in_dir, max_files)
        .writeStream.foreachBatch(batch_handler(out_root, clock, train, name))
        .option("checkpointLocation", checkpoint)
    )
    trigger = {"availableNow": True} if available_now else {"processingTime": interval}
    query = writer.trigger(**trigger).start()
    if available_now:
        query.awaitTermination()
    return query
