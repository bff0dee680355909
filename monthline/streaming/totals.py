"""Monthly totals in Spark's state store: each micro-batch adds its rows to the totals kept so far.

The state holds one sum per brand, state and month, and lasts as long as the query's
checkpoint. The sink writes the totals a micro-batch has changed, whole and not
as differences, under the number of the batch: a replayed batch writes the same
rows into the same folder, and the newest batch of a month is its total.

Months have no end after which sales cannot come any more, so no watermark drops
state; it grows with the number of totals, not of rows. On a cluster set
``spark.sql.streaming.stateStore.providerClass`` to the RocksDB provider.

The files are read as they come, each path once: quoted line breaks and corrected files
are for ``monthline.streaming.ingest``, which lands by listing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from monthline import schemas
from monthline.operators.features import MONTHLY, agg_sales, clean_sales
from monthline.plans.layout import Layout
from monthline.sources.sales_csv import accepted, stream_lines
from monthline.sources.tables import BATCH, append_log, batch_folders, read_log, replace_log

#: So many micro-batches may lie side by side before all but the newest rows go.
MAX_BATCHES = 64


def _number(batch_id: int) -> str:
    return f"{batch_id:012d}"


def newest_totals(log: DataFrame) -> DataFrame:
    """The newest row of each month, with its batch."""
    values = F.struct(*[F.col(n) for n in schemas.AGG_SALES.names if n not in MONTHLY], BATCH)
    return log.groupBy(*MONTHLY).agg(F.max_by(values, BATCH).alias("_newest")).select(*MONTHLY, "_newest.*")


def stream_totals_table(spark: SparkSession, out_root: str) -> DataFrame:
    """The totals as of the last micro-batch."""
    log = read_log(spark, Layout(out_root).stream_totals, schemas.AGG_SALES)
    return newest_totals(log).select(*schemas.AGG_SALES.names)


def totals_sink(out_root: str, max_batches: int = MAX_BATCHES):
    """Writes the changed totals of a micro-batch; old rows go when many batches lie there."""
    path = Layout(out_root).stream_totals

    def write(changed: DataFrame, batch_id: int) -> None:
        spark = changed.sparkSession
        kinds = {f.name: f.dataType for f in schemas.AGG_SALES}
        append_log(changed.select(*[F.col(n).cast(k).alias(n) for n, k in kinds.items()]), path, _number(batch_id))
        if len(batch_folders(spark, path)) > max_batches:
            replace_log(newest_totals(read_log(spark, path, T.StructType(schemas.AGG_SALES.fields))), path)

    return write


def run_totals_stream(
    spark: SparkSession,
    in_dir: str,
    out_root: str,
    checkpoint: str,
    available_now: bool = True,
    *,
    interval: str = "5 minutes",
    max_files: int | None = None,
    max_batches: int = MAX_BATCHES,
) -> StreamingQuery:
    """Keep the totals up to the files there are, or go on with one micro-batch per interval."""
    totals = agg_sales(clean_sales(accepted(stream_lines(spark, in_dir, max_files))))
    writer = totals.writeStream.outputMode("update").foreachBatch(totals_sink(out_root, max_batches)).option("checkpointLocation", checkpoint)
    query = writer.trigger(**({"availableNow": True} if available_now else {"processingTime": interval})).start()
    if available_now:
        query.awaitTermination()
    return query
