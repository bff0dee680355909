"""Tolerant reader for positional sales files.

Files take one of two routes. Most are split at every line break, so a large one is read
by many tasks. A file in which a quoted field holds a line break (some line has an odd
number of quotes, the file an even one) goes through the multi-line parser as a
whole. A file whose quotes do not pair up stays on the first route, where a stray
quote damages one line only.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from monthline import schemas
from monthline.functions import fixed
from monthline.functions.dates import moment
from monthline.functions.text import null_if_token
from monthline.sources.file_list import FILE, file_version, list_files, readable

REJECTED_LINE = "rejected_line"

# Column pruning stays off: with it the parser only splits the selected fields
# and no longer notices lines with too few or too many of them.
CSV_OPTIONS = {
    "header": True,
    "quote": '"',
    "escape": '"',
    "enforceSchema": True,
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": REJECTED_LINE,
    "columnPruning": False,
    "ignoreLeadingWhiteSpace": True,
    "ignoreTrailingWhiteSpace": True,
}

LINE_SCHEMA = T.StructType(
    schemas.SALES_FILE.fields + [T.StructField(REJECTED_LINE, T.StringType(), True)]
)


def tag_lines(lines: DataFrame, null_tokens: Sequence[str] = fixed.NULL_TOKENS) -> DataFrame:
    """Map null tokens and add the file's name and version; keeps good and rejected lines together."""
    fields = [null_if_token(F.col(name), null_tokens).alias(name) for name in schemas.SALES_FILE.names]
    return lines.select(*fields, F.col("_metadata.file_name").alias("source_file"), *file_version(), REJECTED_LINE)


def multi_line_files(spark: SparkSession, path: str | list[str]) -> list[str]:
    """Listed paths of the files that hold quoted line breaks; one pass that counts quotes."""
    quotes = F.octet_length("value") - F.octet_length(F.replace("value", F.lit('"'), F.lit("")))
    counted = (
        spark.read.text(path)
        .select(F.col("_metadata.file_path").alias("file_path"), quotes.cast("long").alias("quotes"))
        .filter("quotes % 2 = 1")
        .groupBy("file_path")
        .agg(F.count(F.lit(1)).alias("open"))
    )
    # The quotes of a file pair up when the lines that leave one open are even in number.
    return [row["file_path"] for row in counted.filter("open % 2 = 0").select("file_path").collect()]


def _read(spark: SparkSession, path: str | list[str], null_tokens: Sequence[str], multi_line: bool = False) -> DataFrame:
    reader = spark.read.schema(LINE_SCHEMA).options(**CSV_OPTIONS).option("multiLine", multi_line)
    return tag_lines(reader.csv(path), null_tokens)


def scan_lines(spark: SparkSession, path: str | list[str], null_tokens: Sequence[str] = fixed.NULL_TOKENS) -> DataFrame:
    """Good and rejected lines of all files, each file by its route."""
    whole = set(multi_line_files(spark, path))
    if not whole:
        return _read(spark, path, null_tokens)
    split = [row["file_path"] for row in list_files(spark, path).collect() if row["file_path"] not in whole]
    lines = _read(spark, readable(sorted(whole)), null_tokens, multi_line=True)
    return lines.unionByName(_read(spark, readable(split), null_tokens)) if split else lines


def stream_lines(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Lines of new files, split at every line break."""
    reader = spark.readStream.schema(LINE_SCHEMA).options(**CSV_OPTIONS)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return tag_lines(reader.csv(path))


def no_lines(spark: SparkSession) -> DataFrame:
    """What ``scan_lines`` gives for no file at all."""
    extra = [T.StructField("source_file", T.StringType()), *[T.StructField(name, kind) for name, kind in FILE.items()]]
    return spark.createDataFrame([], T.StructType([*schemas.SALES_FILE.fields, *extra, LINE_SCHEMA[REJECTED_LINE]]))


def is_rejected() -> Column:
    """True for lines of the wrong length.

    Spark refuses to scan a file for the rejected text alone, as a plain count
    would; the first field takes part so that every query over either side runs.
    """
    return F.concat(REJECTED_LINE, F.coalesce(schemas.SALES_FILE.names[0], F.lit(""))).isNotNull()


def accepted(lines: DataFrame) -> DataFrame:
    return lines.filter(~is_rejected()).drop(REJECTED_LINE, *FILE)


def rejected(lines: DataFrame) -> DataFrame:
    return lines.filter(is_rejected()).select("source_file", REJECTED_LINE)


def read_sales_csv(
    spark: SparkSession, path: str | list[str], *, null_tokens: Sequence[str] = fixed.NULL_TOKENS
) -> tuple[DataFrame, DataFrame]:
    """(accepted rows, rejected lines with their file). Lines of the wrong length are rejected."""
    lines = scan_lines(spark, path, null_tokens)
    return accepted(lines), rejected(lines)


def with_load_ts(df: DataFrame, now: datetime | None = None) -> DataFrame:
    return df.withColumn("load_ts", moment(now))
