"""Landing of sales files and validation of what was loaded."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from monthline import schemas
from monthline.operators.validation import validate, validation_log_rows
from monthline.plans.layout import Layout
from monthline.session import freeze
from monthline.sources.file_list import FILE, FILE_FIELDS, list_files, not_in, readable, superseded
from monthline.sources.sales_csv import REJECTED_LINE, no_lines, scan_lines, with_load_ts
from monthline.sources.tables import BATCH, append_log, read_log, read_table, with_log_id

OUTCOME = "outcome"
LOADED, REJECTED = "loaded", "rejected"

_LANDING = T.StructType(
    schemas.RAW_SALES.fields
    + [T.StructField(name, T.StringType()) for name in (REJECTED_LINE, BATCH, OUTCOME)]
    + FILE_FIELDS
)
FILE_VERSIONS = T.StructType(FILE_FIELDS)


def landed_files(spark: SparkSession, layout: Layout) -> DataFrame:
    """Path, size and time of every file that has been landed, and its batch."""
    return read_log(spark, layout.landed_files, FILE_VERSIONS)


def superseded_files(spark: SparkSession, layout: Layout) -> DataFrame:
    """Landed files of which a later version has been landed as well."""
    return superseded(landed_files(spark, layout))


def files_to_land(files: DataFrame, layout: Layout, batch: str, force: bool = False) -> list[str]:
    """Paths of the listed files that no other batch has landed; nothing is opened for it.

    A batch that is repeated gets its own files again, and is refused when one of them
    is no longer there in the version it had. The paths go to the driver, which
    holds the list of a scan's files in any case.
    """
    spark = files.sparkSession
    landed = landed_files(spark, layout)
    own = landed.filter(F.col(BATCH) == batch)
    if not not_in(own.drop(BATCH), files).isEmpty():
        raise ValueError(f"batch {batch} has been loaded from other files")
    wanted = files if force else not_in(files, landed.filter(F.col(BATCH) != batch))
    return sorted(row["file_path"] for row in wanted.select("file_path").collect())


def land_files(
    files: DataFrame, layout: Layout, batch: str, now: datetime | None = None, force: bool = False
) -> None:
    """Land those of the listed files that are new, as one batch.

    Old files are left out before the scan, unless ``force`` asks for them again. Good
    and rejected lines are written in one pass; the outcome is a partition folder, so
    reading either side skips the other. A repeated attempt replaces the batch; a
    batch of that name with other files is refused.
    """
    spark = files.sparkSession
    paths = files_to_land(files, layout, batch, force)
    lines = scan_lines(spark, readable(paths)) if paths else no_lines(spark)
    outcome = F.when(F.col(REJECTED_LINE).isNull(), LOADED).otherwise(REJECTED)
    (
        with_load_ts(lines, now)
        .withColumn(OUTCOME, outcome)
        .write.mode("overwrite")
        .partitionBy(OUTCOME)
        .parquet(f"{layout.landing}/{BATCH}={batch}")
    )
    # The versions that were read; of files without a line, the listed ones.
    written = read_table(spark, f"{layout.landing}/{BATCH}={batch}", _LANDING, layout.landing, missing_ok=True)
    read = freeze(written.select(*FILE).distinct())
    lineless = files.filter(F.col("file_path").isin(paths)).join(read.select("file_path"), "file_path", "left_anti") if paths else files.limit(0)
    append_log(read.unionByName(lineless), layout.landed_files, batch)


def _landing(spark: SparkSession, layout: Layout, outcome: str, batch: str | None) -> DataFrame:
    """One side of the landed lines; for a single batch only its own folder is listed."""
    if batch is None:
        rows = read_table(spark, layout.landing, _LANDING)
    else:
        rows = read_table(spark, f"{layout.landing}/{BATCH}={batch}", _LANDING, layout.landing, missing_ok=True)
    return rows.filter(F.col(OUTCOME) == outcome)


def raw_sales(spark: SparkSession, layout: Layout, batch: str | None = None) -> DataFrame:
    """Loaded rows of one batch as they came, or the current ones of all.

    Rows of files that a later version replaces, and of attempts that did not end, are
    not current. Lists of batches and files go to the rows, never the rows to the list: by
    file, they would be dealt to as many tasks as there are files.
    """
    rows = _landing(spark, layout, LOADED, batch)
    if batch is None:
        files = landed_files(spark, layout)
        rows = rows.join(F.broadcast(files.select(BATCH).distinct()), BATCH, "left_semi")
        rows = rows.join(F.broadcast(superseded(files).select(*FILE).distinct()), list(FILE), "left_anti")
    return rows.select(*schemas.RAW_SALES.names)


def landed_rows(spark: SparkSession, layout: Layout) -> DataFrame:
    """All loaded rows with their batch and file version."""
    return _landing(spark, layout, LOADED, None)


def rejected_lines(spark: SparkSession, layout: Layout, batch: str | None = None) -> DataFrame:
    return _landing(spark, layout, REJECTED, batch).select("source_file", REJECTED_LINE, BATCH)


def rejected_rows(spark: SparkSession, layout: Layout) -> DataFrame:
    """All rejected lines with their batch and file version."""
    return _landing(spark, layout, REJECTED, None)


def validate_batch(
    spark: SparkSession, layout: Layout, batch: str, now: datetime | None = None
) -> DataFrame:
    """Check one loaded batch and log the summary; only its own rows are read."""
    summary = validation_log_rows(validate(raw_sales(spark, layout, batch), batch, now=now))
    log = read_log(spark, layout.validation_log, schemas.VALIDATION_LOG)
    append_log(
        with_log_id(summary, log, "log_id", ["validation_time"], batch, few=True).select(*schemas.VALIDATION_LOG.names),
        layout.validation_log,
        batch,
    )
    return read_log(spark, layout.validation_log, schemas.VALIDATION_LOG).filter(F.col(BATCH) == batch)


def validate_and_load(
    spark: SparkSession, in_path: str | list[str], out_root: str, batch: str, now: datetime | None = None, force: bool = False
) -> DataFrame:
    """Load the files under ``in_path`` that are not landed yet as one batch and return its validation row.

    A file that has changed since it was landed counts as new, and its rows replace those of its old version.
    """
    layout = Layout(out_root)
    land_files(list_files(spark, in_path), layout, batch, now, force)
    return validate_batch(spark, layout, batch, now)
