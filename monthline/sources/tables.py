"""Parquet tables: scans, replaced tables and replay-safe append logs.

An append goes to its own ``batch=<id>`` folder, which a repeated attempt for
the same batch overwrites. A job that is retried after a lost executor or a
replayed micro-batch therefore never adds its rows twice.

The folders of many batches are merged into one table, a new version under a pointer,
in which each row keeps its batch. A folder stands for its batch, whatever the merged
table says of it: one that is left over, or written again by a replay, counts once.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from monthline import schemas
from monthline.functions import fixed
from monthline.operators.row_id import nulls_last, with_row_id

BATCH = "batch"


def read_table(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    base: str | None = None,
    missing_ok: bool = False,
) -> DataFrame:
    """Scan a table; with ``missing_ok`` and a schema, one that nobody wrote yet reads as empty.

    ``base`` names the table when ``path`` is one of its partition folders: only
    that folder is listed, however many others there are.
    """
    if schema is None:
        return spark.read.parquet(path)
    reader = spark.read.schema(schema)
    if base:
        reader = reader.option("basePath", base)
    try:
        return reader.parquet(path)
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND" or not missing_ok:
            raise
        return spark.createDataFrame([], schema)


def read_log(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Scan an append log together with the batch each row came from."""
    with_batch = T.StructType(schema.fields + [T.StructField(BATCH, T.StringType())])
    rows = read_table(spark, path, with_batch, missing_ok=True)
    if not _exists(spark, f"{path}/{_MERGED}"):
        return rows
    merged = read_replaced(spark, f"{path}/{_MERGED}", with_batch)
    return merged.filter(~F.col(BATCH).isin(batch_folders(spark, path))).unionByName(rows)


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies in a folder; none if there is no such folder."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    return sorted(status.getPath().getName() for status in files.listStatus(folder)) if files.exists(folder) else []


def remove_folders(spark: SparkSession, path: str, keep: set[str]) -> None:
    """Remove all folders in ``path`` but those to keep."""
    for name in set(folder_names(spark, path)) - keep:
        folder = spark._jvm.org.apache.hadoop.fs.Path(path, name)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def _batch_of(folder: str) -> str | None:
    return unquote(folder.removeprefix(f"{BATCH}=")) if folder.startswith(f"{BATCH}=") else None


def batch_folders(spark: SparkSession, path: str) -> list[str]:
    """The batches that have a folder of their own."""
    return sorted(b for b in map(_batch_of, folder_names(spark, path)) if b is not None)


def remove_batches(spark: SparkSession, path: str, batches: Sequence[str]) -> None:
    gone = set(batches)
    remove_folders(spark, path, keep={name for name in folder_names(spark, path) if _batch_of(name) not in gone})


def compact_log(spark: SparkSession, path: str, schema: T.StructType, max_folders: int = 32) -> bool:
    """Merge the folders of a log when there are more than ``max_folders``; True if it did.

    The folders go after the pointer names the merged table, so a failure in between loses nothing.
    """
    folders = batch_folders(spark, path)
    if len(folders) <= max_folders:
        return False
    replace_log(read_log(spark, path, schema), path)
    return True


def replace_log(rows: DataFrame, path: str) -> None:
    """Put ``rows`` (with their batch) in place of all that the log holds now."""
    spark = rows.sparkSession
    folders = batch_folders(spark, path)
    replace_table(rows, f"{path}/{_MERGED}")
    remove_batches(spark, path, folders)


def _exists(spark: SparkSession, path: str) -> bool:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)


def replace_partitions(df: DataFrame, path: str, column: str) -> None:
    """Write the partitions that ``df`` has rows of in place of those that are there; others stay."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(column).parquet(path)


def replace_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Rebuild a derived table as a new version and point readers to it.

    The version is complete before the pointer names it, so the plan may read the
    table it rebuilds, a failure leaves the old version, and no reader meets a
    half-written one. The version before stays for readers that have begun; older
    ones are removed.
    """
    spark = df.sparkSession
    made = f"{time.time_ns():020d}"
    df.write.partitionBy(*partition_by).parquet(f"{path}/{_VERSIONS}/v{made}")
    spark.createDataFrame([(made,)], _POINTER).coalesce(1).write.mode("append").parquet(f"{path}/{_CURRENT}")
    older = sorted(r["made"] for r in _pointers(spark, path).collect())[:-2]
    for version in older:
        folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{_VERSIONS}/v{version}")
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


_VERSIONS, _CURRENT, _MERGED = "versions", "current", "_merged"
_POINTER = "made string"


def _pointers(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(_POINTER).parquet(f"{path}/{_CURRENT}")


def read_replaced(
    spark: SparkSession, path: str, schema: T.StructType | None = None, missing_ok: bool = False
) -> DataFrame:
    """The newest version of a table that ``replace_table`` writes; with ``missing_ok`` one that nobody wrote yet is empty."""
    if missing_ok and not _exists(spark, f"{path}/{_CURRENT}"):
        return spark.createDataFrame([], schema)
    newest = _pointers(spark, path).agg(F.max("made")).first()[0]
    return read_table(spark, f"{path}/{_VERSIONS}/v{newest}", schema)


def append_log(df: DataFrame, path: str, batch: str | None = None) -> str:
    """Append all rows of ``df`` in one write and return the batch they are filed under."""
    batch = batch or uuid.uuid4().hex
    df.write.mode("overwrite").parquet(f"{path}/{BATCH}={batch}")
    return batch


def with_log_id(
    rows: DataFrame, log: DataFrame, id_column: str, order: Sequence[str], batch: str, few: bool = False
) -> DataFrame:
    """Number new log rows after the largest id of all other batches.

    ``few`` is for steps that write a fixed handful of rows, such as one run record:
    those are numbered by a plain window instead of a range-partitioned one.
    """
    last = log.filter(F.col(BATCH) != batch).agg(F.coalesce(F.max(id_column), F.lit(0)))
    if few:
        place = F.row_number().over(Window.orderBy(*nulls_last(order))).cast("long")
        numbered = rows.withColumn(id_column, place)
    else:
        numbered = with_row_id(rows, order, id_column)
    return numbered.withColumn(id_column, F.col(id_column) + last.scalar())


def rules_frame(spark: SparkSession, rules=fixed.VALIDATION_RULES) -> DataFrame:
    """Rule tuples as a table: ids from 1 in the given order, all active unless a 5th field says no."""
    rows = [
        (number, *rule[:4], bool(rule[4]) if len(rule) > 4 else True)
        for number, rule in enumerate(rules, start=1)
    ]
    return spark.createDataFrame(rows, schemas.VALIDATION_RULES)


def load_rules(spark: SparkSession, rules, path: str) -> None:
    """Empty and refill the rule table."""
    replace_table(rules_frame(spark, rules), path)
