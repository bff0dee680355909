"""Rejected lines that come back repaired.

A rejected line is known by the version of its file and its text; copies of a line in one
file come back together, as often as they were rejected. Repaired rows are landed as a
batch of their own with the file version they come from, so a later version of the file
replaces them with the rest of its rows. A line is repaired once, whichever batch offers
it again; a repeated attempt replaces its batch. What still is no row stays rejected.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from monthline import schemas
from monthline.functions import fixed
from monthline.functions.text import null_if_token
from monthline.plans.layout import Layout
from monthline.plans.load import LOADED, OUTCOME, landed_files, rejected_rows
from monthline.sources.file_list import FILE, FILE_FIELDS, not_in, superseded
from monthline.sources.sales_csv import CSV_OPTIONS, LINE_SCHEMA, REJECTED_LINE, with_load_ts
from monthline.sources.tables import BATCH, append_log, read_log

REPAIRED_LINE = "repaired_line"
_LINE = [*FILE, REJECTED_LINE]
REPAIRED_LINES = T.StructType([*FILE_FIELDS, T.StructField(REJECTED_LINE, T.StringType())])


def repaired_lines(spark: SparkSession, layout: Layout) -> DataFrame:
    """Every line that has come back, and the batch it came with."""
    return read_log(spark, layout.repaired_lines, REPAIRED_LINES)


def quarantined(spark: SparkSession, layout: Layout, batch: str | None = None) -> DataFrame:
    """(source_file, file version, rejected_line, copies) of the lines of current files that wait for repair.

    With ``batch`` as they were before that batch of repairs.
    """
    files = landed_files(spark, layout)
    lines = rejected_rows(spark, layout).join(files.select(BATCH).distinct(), BATCH, "left_semi")
    waiting = not_in(lines, superseded(files)).groupBy("source_file", *_LINE).agg(F.count(F.lit(1)).alias("copies"))
    done = repaired_lines(spark, layout)
    if batch is not None:
        done = done.filter(F.col(BATCH) != batch)
    return waiting.join(done.select(*_LINE).distinct(), _LINE, "left_anti")


def repair(spark: SparkSession, layout: Layout, repairs: DataFrame, batch: str, now: datetime | None = None) -> int:
    """Land the repaired lines of ``repairs`` (file version, rejected_line, repaired_line) that wait; returns their rows.

    Two repairs of one line in a call: the one that comes first as text counts.
    """
    wanted = repairs.groupBy(*_LINE).agg(F.min(REPAIRED_LINE).alias(REPAIRED_LINE))
    options = {name: str(value).lower() if isinstance(value, bool) else value for name, value in CSV_OPTIONS.items() if name not in ("header", "enforceSchema")}
    fields = F.from_csv(REPAIRED_LINE, LINE_SCHEMA.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " "), options)
    parsed = quarantined(spark, layout, batch).join(wanted, _LINE).withColumn("_fields", fields)
    good = parsed.filter(F.col(f"_fields.{REJECTED_LINE}").isNull())
    values = [null_if_token(F.col(f"_fields.{name}"), fixed.NULL_TOKENS).alias(name) for name in schemas.SALES_FILE.names]
    rows = good.select(*values, "source_file", *FILE, REJECTED_LINE, F.expr("explode(sequence(1L, copies))"))
    path = f"{layout.landing}/{BATCH}={batch}"
    landed = with_load_ts(rows, now).withColumn(OUTCOME, F.lit(LOADED))
    names = [*schemas.RAW_SALES.names, *FILE, OUTCOME]
    landed.select(*names, F.col(REJECTED_LINE).alias("repaired_from")).write.mode("overwrite").partitionBy(OUTCOME).parquet(path)
    schema = T.StructType([*REPAIRED_LINES.fields[:-1], T.StructField("repaired_from", T.StringType())])
    written = spark.read.schema(schema).option("basePath", path).parquet(path)
    append_log(written.select(*FILE, F.col("repaired_from").alias(REJECTED_LINE)).distinct(), layout.repaired_lines, batch)
    # Only now the rows are current.
    append_log(written.select(*FILE).distinct(), layout.landed_files, batch)
    return written.count()
