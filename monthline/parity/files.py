"""Sales files and streams, written from the derived rows and read back."""

from __future__ import annotations

from datetime import timedelta
from functools import reduce

from pyspark.sql import Window, functions as F

from monthline import schemas
from monthline.parity import inputs as src
from monthline.parity.catalog import query
from monthline.parity.inputs import FIELDS, NOW, sql_over
from monthline.plans.layout import Layout
from monthline.parity.feature_queries import FEATURE_SQL
from monthline.plans.feature_table import numbered_features, refresh
from monthline.plans.load import landed_rows, validate_and_load
from monthline.plans.load import raw_sales as landed_sales
from monthline.plans.repair import quarantined, repair
from monthline.plans.totals import aggregate_pending, merge_parts, monthly_totals
from monthline.plans.train import run_pipeline, stored_registry, untrained_series
from monthline.session import freeze, scratch_path
from monthline.sources.sales_csv import REJECTED_LINE, is_rejected, read_sales_csv, scan_lines, with_load_ts
from monthline.sources.tables import read_log
from monthline.streaming.ingest import run_stream
from monthline.streaming.totals import run_totals_stream, stream_totals_table

TRIMMED = """material_group, material_description, trim(sold_state) AS sold_state, supply_location,
  month, fy, net_sales"""


def stream_lots(spark, sf, *, repeat: bool = False) -> Layout:
    """Stream two file lots, then the other two with the same checkpoint."""
    out, checkpoint = scratch_path(spark, "stream-out"), scratch_path(spark, "stream-offsets")
    rows = src.keyed_raw_sales(spark, sf).withColumn("lot", F.col("k") % 4)
    folder = scratch_path(spark, "stream-in")
    for lots in ((0, 1), (2, 3)):
        src.append_sales_files(rows.filter(F.col("lot").isin(*lots)), folder)
        run_stream(spark, folder, out, checkpoint, clock=lambda: NOW, train=False)
        if repeat:
            run_stream(spark, folder, out, checkpoint, clock=lambda: NOW, train=False)
    return Layout(out)


@query("csv_scan", sql_over("raw_sales", select=f"SELECT {TRIMMED} FROM raw_sales"))
def csv_scan(spark, sf):
    good, _ = read_sales_csv(spark, src.write_sales_files(spark, sf))
    return good.select(*FIELDS)


@query(
    "csv_trim",
    sql_over("raw_sales", select="SELECT trim(sold_state) AS sold_state, count(*) AS row_count FROM raw_sales GROUP BY 1"),
)
def csv_trim(spark, sf):
    good, _ = read_sales_csv(spark, src.write_sales_files(spark, sf))
    return good.groupBy("sold_state").agg(F.count(F.lit(1)).alias("row_count"))


@query(
    "csv_reject_split",
    sql_over(
        "keyed_raw",
        select="""
        SELECT CASE WHEN k % 53 = 0 OR k % 59 = 0 THEN 'rejected' ELSE 'accepted' END AS side,
          CASE WHEN k % 53 = 0 OR k % 59 = 0 THEN
            coalesce(material_group, 'NULL') || ',' || material_description || ',' || coalesce(sold_state, '') || ',' || supply_location
            || ',' || coalesce(month, 'null') || ',' || coalesce(fy, 'NULL')
            || CASE WHEN k % 53 = 0 THEN '' ELSE ',' || coalesce('"' || net_sales || '"', '') || ',extra' END END AS line,
          count(*) AS lines
        FROM keyed_raw GROUP BY 1, 2""",
    ),
)
def csv_reject_split(spark, sf):
    """Both sides from one scan of the files."""
    lines = scan_lines(spark, src.write_sales_files(spark, sf, broken=True))
    side = F.when(is_rejected(), F.lit("rejected")).otherwise(F.lit("accepted"))
    sides = lines.select(side.alias("side"), F.col(REJECTED_LINE).alias("line"))
    return sides.groupBy("side", "line").agg(F.count(F.lit(1)).alias("lines"))


@query(
    "source_file_lineage",
    sql_over("keyed_raw", select="SELECT CAST(k % 4 AS VARCHAR) AS lot, count(*) AS row_count FROM keyed_raw GROUP BY 1"),
)
def source_file_lineage(spark, sf):
    """Rows per lot, each lot in files of its own, by the file name that the scan gives each row."""
    out = []
    for lot in range(4):
        good, _ = read_sales_csv(spark, src.write_sales_files(spark, sf, lots=(lot,)))
        out.append(good.groupBy("source_file").agg(F.count(F.lit(1)).alias("n")).withColumn("lot", F.lit(str(lot))))
    files = reduce(lambda a, b: a.unionByName(b), out)
    named = files.filter(F.col("source_file").endswith(".csv"))
    return named.groupBy("lot").agg(F.sum("n").alias("row_count"))


@query(
    "load_timestamp",
    sql_over(
        "raw_sales",
        select=f"SELECT source_file, {src.NOW_SQL} AS load_ts, count(*) AS row_count FROM raw_sales GROUP BY source_file",
    ),
)
def load_timestamp(spark, sf):
    return (
        with_load_ts(src.raw_sales(spark, sf), NOW)
        .groupBy("source_file", "load_ts")
        .agg(F.count(F.lit(1)).alias("row_count"))
    )


@query(
    "validate_and_load",
    sql_over(
        "flagged",
        select="""
        SELECT 'batch_1' AS batch_id, count(*) AS total_records,
          count(*) FILTER (WHERE NOT (bad_net_sales OR bad_month OR bad_fy)) AS valid_records,
          count(*) FILTER (WHERE bad_net_sales OR bad_month OR bad_fy) AS invalid_records,
          CASE WHEN count(*) FILTER (WHERE bad_net_sales OR bad_month OR bad_fy) / count(*) * 100 <= 5
            THEN 'PASSED' ELSE 'FAILED' END AS validation_status
        FROM flagged""",
    ),
)
def load_and_validate(spark, sf):
    out = scratch_path(spark, "loaded")
    row = validate_and_load(spark, src.write_sales_files(spark, sf), out, "batch_1", NOW)
    return row.select("batch_id", "total_records", "valid_records", "invalid_records", "validation_status")


@query("stream_ingest_csv", sql_over("raw_sales", select=f"SELECT {TRIMMED} FROM raw_sales"))
def stream_ingest_csv(spark, sf):
    return landed_sales(spark, stream_lots(spark, sf)).select(*FIELDS)


@query(
    "stream_append_only",
    sql_over("raw_sales", select="SELECT count(*) AS total_records FROM raw_sales"),
)
def stream_append_only(spark, sf):
    """Every row once, although each lot is offered to two runs."""
    layout = stream_lots(spark, sf, repeat=True)
    return landed_sales(spark, layout).agg(F.count(F.lit(1)).alias("total_records"))


@query("stream_two_sources", sql_over("raw_sales", select=f"SELECT {TRIMMED} FROM raw_sales"))
def stream_two_sources(spark, sf):
    """Two streams with offsets of their own write into one folder; the second also offers a file again."""
    out = scratch_path(spark, "two-streams")
    for lots in ((0, 1), (2, 3)):
        folder = src.write_sales_files(spark, sf, lots=lots)
        for _ in range(2):  # the second stream has lost its offsets
            run_stream(spark, folder, out, scratch_path(spark, "offsets"), clock=lambda: NOW, train=False)
    return landed_sales(spark, Layout(out)).select(*FIELDS)


@query("load_once", sql_over("raw_sales", select=f"SELECT {TRIMMED} FROM raw_sales"))
def load_once(spark, sf):
    """The same folder loaded under two batch names counts once."""
    out, folder = scratch_path(spark, "loaded-twice"), src.write_sales_files(spark, sf)
    for batch in ("one", "two"):
        validate_and_load(spark, folder, out, batch, NOW)
    return landed_sales(spark, Layout(out)).select(*FIELDS)


def _features_of(lots: str) -> str:
    """Count of the feature rows that the file lots chosen by a condition give."""
    whole = sql_over("features", select="SELECT count(*) AS n FROM features")
    return whole.replace("SELECT * EXCLUDE (k) FROM keyed_raw", f"SELECT * EXCLUDE (k) FROM keyed_raw WHERE {lots}")


@query(
    "stream_trigger_pipeline",
    f"SELECT 1 AS run, 'SUCCESS' AS status, (SELECT n FROM ({_features_of('k % 4 < 2')})) AS records_processed, 1 AS decided "
    f"UNION ALL SELECT 2, 'SUCCESS', (SELECT n FROM ({_features_of('true')})), 2",
)
def stream_trigger_pipeline(spark, sf):
    """Two lots of files each start a full run, a trigger without new files starts none."""
    out, checkpoint, folder = (scratch_path(spark, name) for name in ("trigger-out", "trigger-offsets", "trigger-in"))
    rows = src.keyed_raw_sales(spark, sf).withColumn("lot", F.col("k") % 4)
    times = iter([NOW + timedelta(days=k) for k in range(9)])
    for lots in ((0, 1), (2, 3), ()):
        if lots:
            src.append_sales_files(rows.filter(F.col("lot").isin(*lots)), folder)
        run_stream(spark, folder, out, checkpoint, clock=lambda: next(times))
    layout = Layout(out)
    runs = read_log(spark, layout.runs, schemas.PIPELINE_RUNS).withColumn(
        "run", F.row_number().over(Window.orderBy("run_time"))
    )
    made = read_log(spark, layout.comparison_log, schemas.MODEL_COMPARISON_LOG)
    decided = made.groupBy("batch").agg(F.max("comparison_id").cast("int").alias("decided"))
    return runs.join(decided, "batch").select("run", "status", "records_processed", "decided")


@query("stream_monthly_totals", sql_over("agg_sales", select="SELECT * FROM agg_sales"))
def stream_monthly_totals(spark, sf):
    return monthly_totals(spark, stream_lots(spark, sf))


@query("stateful_monthly_totals", sql_over("agg_sales", select="SELECT * FROM agg_sales"))
def stateful_monthly_totals(spark, sf):
    """Two lots, then the query starts again from its checkpoint for the other two, as many files a micro-batch as a lot has."""
    out, checkpoint, folder = (scratch_path(spark, name) for name in ("state-out", "state-offsets", "state-in"))
    rows = src.keyed_raw_sales(spark, sf).withColumn("lot", F.col("k") % 4)
    files = src.files_per_lot(spark, sf, least=2)
    for lots in ((0, 1), (2, 3)):
        src.place_sales_files(rows.filter(F.col("lot").isin(*lots)), folder, files)
        run_totals_stream(spark, folder, out, checkpoint, max_files=files, max_batches=3)
    return stream_totals_table(spark, out)


@query(
    "trigger_log",
    sql_over(
        "keyed_raw",
        select=f"SELECT {src.NOW_SQL} AS run_time, count(*) AS new_rows, 'NEW_FILES' AS trigger_type "
        "FROM keyed_raw GROUP BY k % 4 >= 2",
    ),
)
def trigger_log(spark, sf):
    layout = stream_lots(spark, sf)
    return read_log(spark, layout.trigger_log, schemas.TRIGGER_LOG).select("run_time", "new_rows", "trigger_type")


LOADS_SQL = "SELECT CASE WHEN k % 4 < 2 THEN 'first' ELSE 'second' END AS batch, count(*) AS row_count FROM keyed_raw GROUP BY 1"


@query("load_new_files", sql_over("keyed_raw", select=LOADS_SQL))
def load_new_files(spark, sf):
    """A folder that grows, loaded three times: each load takes the files that are new."""
    out, folder = scratch_path(spark, "grown-out"), scratch_path(spark, "grown-in")
    rows = src.keyed_raw_sales(spark, sf).withColumn("lot", F.col("k") % 4)
    for batch, lots in (("first", (0, 1)), ("second", (2, 3)), ("third", ())):
        if lots:
            src.append_sales_files(rows.filter(F.col("lot").isin(*lots)), folder)
        validate_and_load(spark, folder, out, batch, NOW)
    return landed_rows(spark, Layout(out)).groupBy("batch").agg(F.count(F.lit(1)).alias("row_count"))


def _corrected(sql: str) -> str:
    """The same over rows of which two lots have been corrected: some rows are gone, some amounts changed."""
    return sql.replace(
        "SELECT * EXCLUDE (k) FROM keyed_raw",
        "SELECT * EXCLUDE (k) REPLACE (CASE WHEN k % 4 >= 2 AND k % 7 = 0 THEN '1.00' ELSE net_sales END AS net_sales) "
        "FROM keyed_raw WHERE k % 4 < 2 OR k % 5 <> 0",
    )


def corrected_files(spark, sf) -> Layout:
    """All lots loaded, two of them corrected under the same file names and loaded again, then a load of nothing new."""
    out, folder = scratch_path(spark, "corrected-out"), scratch_path(spark, "corrected-in")
    rows = src.keyed_raw_sales(spark, sf).withColumn("lot", F.col("k") % 4)
    late, files = rows.filter("lot >= 2 and k % 5 <> 0"), src.files_per_lot(spark, sf)
    amount = F.when(F.col("k") % 7 == 0, F.lit("1.00")).otherwise(F.col("net_sales"))
    for batch, sent in (("first", rows), ("corrected", late.withColumn("net_sales", amount)), ("again", None)):
        if sent is not None:
            src.place_sales_files(sent, folder, files)
        validate_and_load(spark, folder, out, batch, NOW)
        aggregate_pending(spark, Layout(out))
    return Layout(out)


@query("superseded_rows", _corrected(sql_over("raw_sales", select=f"SELECT {TRIMMED} FROM raw_sales")))
def superseded_rows(spark, sf):
    """Rows of a corrected file stand in place of those of its first version."""
    return landed_sales(spark, corrected_files(spark, sf)).select(*FIELDS)


@query("superseded_totals", _corrected(sql_over("agg_sales", select="SELECT * FROM agg_sales")))
def superseded_totals(spark, sf):
    """Totals after the parts of replaced files have been taken back, before and after a merge of all parts."""
    layout = corrected_files(spark, sf)
    merge_parts(spark, layout, max_parts=0)
    aggregate_pending(spark, layout)
    return monthly_totals(spark, layout)


@query("merged_totals", sql_over("agg_sales", select="SELECT * FROM agg_sales"))
def merged_totals(spark, sf):
    """Four loads, the parts merged whenever there are more than two."""
    out, folder = scratch_path(spark, "merged-out"), scratch_path(spark, "merged-in")
    rows = src.keyed_raw_sales(spark, sf).withColumn("lot", F.col("k") % 4)
    for lot in range(4):
        src.append_sales_files(rows.filter(F.col("lot") == lot), folder)
        validate_and_load(spark, folder, out, f"lot {lot}", NOW)
        aggregate_pending(spark, Layout(out))
        merge_parts(spark, Layout(out), max_parts=2)
    return monthly_totals(spark, Layout(out))


@query("repaired_rows", sql_over("keyed_raw", select=f"SELECT {TRIMMED} FROM keyed_raw WHERE k % 53 <> 0"))
def repaired_rows(spark, sf):
    """Lines with one field too many come back without it, offered twice; those with one too few stay rejected."""
    out = scratch_path(spark, "repaired")
    validate_and_load(spark, src.write_sales_files(spark, sf, broken=True), out, "first", NOW)
    layout = Layout(out)
    waiting = quarantined(spark, layout).filter(F.col(REJECTED_LINE).endswith(",extra"))
    repairs = freeze(waiting.withColumn("repaired_line", F.expr(f"left({REJECTED_LINE}, length({REJECTED_LINE}) - 6)")))
    for batch in ("repair", "repair again"):
        repair(spark, layout, repairs, batch, NOW)
    return landed_sales(spark, layout).select(*FIELDS)


BREAKS_SQL = sql_over(
    "keyed_raw",
    select=f"""SELECT {TRIMMED} FROM (SELECT * REPLACE (CASE WHEN k % 4 < 2 AND k % 5 = 0
      THEN material_description || chr(10) || 'second, "line"' ELSE material_description END AS material_description) FROM keyed_raw)""",
)


def files_with_breaks(spark, sf) -> str:
    """Two lots hold quoted line breaks, two do not."""
    folder = scratch_path(spark, "line-breaks")
    rows = src.keyed_raw_sales(spark, sf).withColumn("lot", F.col("k") % 4)
    text = F.concat("material_description", F.lit('\nsecond, "line"'))
    broken = F.when((F.col("lot") < 2) & (F.col("k") % 5 == 0), text).otherwise(F.col("material_description"))
    src.place_sales_files(rows.withColumn("material_description", broken), folder, src.files_per_lot(spark, sf))
    return folder


@query("csv_line_breaks", BREAKS_SQL)
def csv_line_breaks(spark, sf):
    return read_sales_csv(spark, files_with_breaks(spark, sf))[0].select(*FIELDS)


@query("stream_line_breaks", BREAKS_SQL)
def stream_line_breaks(spark, sf):
    out = scratch_path(spark, "breaks-out")
    run_stream(spark, files_with_breaks(spark, sf), out, scratch_path(spark, "breaks-offsets"), clock=lambda: NOW, train=False)
    return landed_sales(spark, Layout(out)).select(*FIELDS)


@query("incremental_features", FEATURE_SQL)
def incremental_features(spark, sf):
    """Three batches, the features of the touched series built after each, ids made at the end."""
    out, folder = scratch_path(spark, "features-out"), scratch_path(spark, "features-in")
    rows = src.keyed_raw_sales(spark, sf).withColumn("lot", F.col("k") % 4)
    for lots in ((0, 1), (2,), (3,)):
        src.append_sales_files(rows.filter(F.col("lot").isin(*lots)), folder)
        validate_and_load(spark, folder, out, f"lots {lots[0]}", NOW)
        aggregate_pending(spark, Layout(out))
        refresh(spark, Layout(out), NOW)
    return numbered_features(spark, Layout(out)).withColumn("rolling_avg_3", F.round("rolling_avg_3", 4)).drop("created_at")


SERIES_FIT_SQL = sql_over(
    "features",
    select="""
    SELECT CASE WHEN n >= 10 THEN 'trained' ELSE 'left out' END AS outcome, n, count(*) AS series
    FROM (SELECT brand, state, count(*) AS n FROM features WHERE ds IS NOT NULL GROUP BY brand, state) GROUP BY 1, 2""",
)


@query("series_outcomes", SERIES_FIT_SQL)
def series_outcomes(spark, sf):
    """Every series is trained or listed as left out; a second run over the same rows fits none again."""
    out = scratch_path(spark, "outcomes")
    validate_and_load(spark, src.write_sales_files(spark, sf), out, "first", NOW)
    for batch in ("first", "second"):
        run_pipeline(spark, out, NOW, batch, by=["brand", "state"])
    layout = Layout(out)
    trained = read_log(spark, layout.trained_series, schemas.TRAINED_SERIES).select(F.lit("trained").alias("outcome"), "n")
    short = untrained_series(spark, layout).filter("batch = 'second'").select(F.lit("left out").alias("outcome"), "n")
    return trained.unionByName(short).groupBy("outcome", "n").agg(F.count(F.lit(1)).alias("series"))


def full_chain(spark, sf):
    """Load one batch of files and run features, training, comparison and drift on what was loaded."""
    out = scratch_path(spark, "full-run")
    validate_and_load(spark, src.write_sales_files(spark, sf), out, "first", NOW)
    return Layout(out), run_pipeline(spark, out, NOW, "first")


RUN_SQL = sql_over(
    "features",
    select=f"SELECT {src.NOW_SQL} AS run_time, 'FULL_PIPELINE' AS phase, 'SUCCESS' AS status, "
    "count(*) AS records_processed FROM features",
)


@query("pipeline_run_record", RUN_SQL)
@query("full_run", RUN_SQL)
def full_run(spark, sf):
    return full_chain(spark, sf)[1].select("run_time", "phase", "status", "records_processed")


MODEL_SQL = sql_over(
        "global_scored",
        select="""
        SELECT 'SALES_TREND_SEASONAL' AS model_name, 'v20010815_083000' AS model_version, n_train AS training_records,
          round(avg(abs(y - yhat)), 2) AS mae, round(sqrt(avg((y - yhat) * (y - yhat))), 2) AS rmse,
          round(avg(abs((y - yhat) / nullif(y, 0))) * 100, 3) AS mape, 'PRODUCTION' AS status,
          'First model - auto-promoted to PRODUCTION' AS notes
        FROM global_scored GROUP BY n_train""",
)


@query("pipeline_chain", MODEL_SQL)
@query("full_run_model", MODEL_SQL)
def full_run_model(spark, sf):
    """The registry after the first run: its only model was promoted."""
    layout, _ = full_chain(spark, sf)
    return stored_registry(spark, layout).select(
        "model_name",
        "model_version",
        "training_records",
        F.round("mae", 2).alias("mae"),
        F.round("rmse", 2).alias("rmse"),
        F.round("mape", 3).alias("mape"),
        "status",
        "notes",
    )
