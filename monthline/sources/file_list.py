"""Files by listing: which there are, which are new, and which a newer version has replaced."""

from __future__ import annotations

import re
from collections.abc import Iterable
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

# What tells one version of a file from another.
FILE = {"file_path": T.StringType(), "file_size": T.LongType(), "file_modified": T.TimestampType()}
FILE_FIELDS = [T.StructField(name, kind) for name, kind in FILE.items()]

_LISTED = "path string, modificationTime timestamp, length long, content binary"


def file_version() -> list[Column]:
    """Columns that name the file version each row of a file scan comes from."""
    return [
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_size").alias("file_size"),
        F.col("_metadata.file_modification_time").alias("file_modified"),
    ]


def list_files(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """One row per file under ``path``, from the listing alone; no file is opened."""
    return spark.read.format("binaryFile").load(path).select(*file_version())


def stream_files(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """The same for a stream: one row per file that has come since."""
    reader = spark.readStream.format("binaryFile").schema(_LISTED)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path).select(*file_version())


def readable(file_paths: Iterable[str]) -> list[str]:
    """Listed paths as a reader takes them: plain characters, none of them a wildcard."""
    return [re.sub(r"([\\\[\]{}*?])", r"\\\1", unquote(path)) for path in file_paths]


def not_in(files: DataFrame, known: DataFrame) -> DataFrame:
    """File versions that ``known`` does not have."""
    return files.join(known.select(*FILE).distinct(), list(FILE), "left_anti")


def superseded(versions: DataFrame) -> DataFrame:
    """The rows of ``versions`` whose path has a later version: by time of change, then by size."""
    rank = F.struct("file_modified", "file_size")
    newest = versions.groupBy(F.col("file_path").alias("_path")).agg(F.max(rank).alias("_newest"))
    return versions.join(newest, F.col("file_path") == F.col("_path")).filter(rank < F.col("_newest")).drop("_path", "_newest")
