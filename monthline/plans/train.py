"""Features, training, promotion and drift over the stored tables."""

from __future__ import annotations

import time
from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from monthline import schemas
from monthline.functions import fixed
from monthline.functions.dates import moment
from monthline.operators.distribution import distribution_step
from monthline.operators.features import SERIES
from monthline.operators.forecast import (
    enough_history,
    error_metrics,
    global_series,
    join_on_keys,
    prediction_rows,
    score_holdout,
)
from monthline.operators.monitoring import (
    LEAD_METRIC,
    drift_baseline,
    drift_check,
    drift_step,
    health_run,
    model_health,
    pipeline_summary,
    run_record,
)
from monthline.operators.registry import (
    candidate_rows,
    changed_rows,
    compare_models,
    comparison_log,
    current_registry,
    model_name,
    registry_events,
)
from monthline.operators.piecewise import score_piecewise
from monthline.plans.layout import Layout
from monthline.plans.load import FILE_VERSIONS, raw_sales
from monthline.plans.feature_table import refresh, stored_features
from monthline.plans.repair import REPAIRED_LINES
from monthline.plans.totals import aggregate_pending, merge_parts, monthly_totals
from monthline.session import freeze
from monthline.sources.tables import (
    BATCH,
    append_log,
    compact_log,
    read_log,
    with_log_id,
)

TREND_SEASONAL, PIECEWISE = "TREND_SEASONAL", "PIECEWISE"
#: Model form -> held-out months with their forecasts.
MODELS = {TREND_SEASONAL: score_holdout, PIECEWISE: score_piecewise}
CANDIDATE_STEP, DECISION_STEP = 0, 1


def refresh_features(spark: SparkSession, layout: Layout, now: datetime | None = None) -> int:
    """Add what has been landed since, bring the feature table up to it and return its row count."""
    aggregate_pending(spark, layout)
    refresh(spark, layout, now)
    return stored_features(spark, layout).count()


def stored_registry(spark: SparkSession, layout: Layout) -> DataFrame:
    return current_registry(read_log(spark, layout.model_events, schemas.MODEL_EVENTS).drop(BATCH))


def _decided(batch: str) -> str:
    return f"{batch}-decided"


def _events_before(spark: SparkSession, layout: Layout, batch: str) -> DataFrame:
    """Registry events without the decisions an earlier attempt of this batch made."""
    events = read_log(spark, layout.model_events, schemas.MODEL_EVENTS)
    return events.filter(F.col(BATCH) != _decided(batch))


def _version(now: datetime) -> str:
    return now.strftime("v%Y%m%d_%H%M%S")


def _fingerprints(series: DataFrame, keys: Sequence[str], model: str) -> DataFrame:
    """(keys, n, fingerprint) of the dated rows of each series: equal where they are, in whatever order they come."""
    content = F.sum(F.xxhash64("ds", "y", F.lit(model)).cast("decimal(38,0)")).cast("string")
    return series.filter(F.col("ds").isNotNull()).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), content.alias("fingerprint"))


def _sort_series(
    spark: SparkSession, layout: Layout, batch: str, series: DataFrame, keys: Sequence[str], model: str
) -> DataFrame:
    """The rows of the series that are to be fitted: long enough, and changed since they last were.

    Both lists are logged for the batch: the fingerprints of the series that are fitted, and the
    series left out for want of rows with the number they have.
    """
    prints = freeze(_fingerprints(series, keys, model))
    short = prints.filter(F.col("n") < fixed.MIN_TRAINING_ROWS).select(
        F.col(keys[0]).alias("model_name"), F.to_json(F.struct(*keys[1:])).alias("series"), "n", F.lit(fixed.SHORT_SERIES_NOTE).alias("reason")
    )
    append_log(short, layout.untrained_series, batch)
    earlier = read_log(spark, layout.trained_series, schemas.TRAINED_SERIES).filter(F.col(BATCH) != batch)
    newest = earlier.groupBy("model_name").agg(F.max_by("fingerprint", "trained").alias("_last"))
    long = prints.filter(F.col("n") >= fixed.MIN_TRAINING_ROWS).join(newest, "model_name", "left")
    return freeze(long.filter(~F.col("_last").eqNullSafe(F.col("fingerprint"))).drop("_last"))


def train_models(
    spark: SparkSession,
    layout: Layout,
    batch: str,
    now: datetime,
    by: Sequence[str] = (),
    model: str = TREND_SEASONAL,
) -> bool:
    """Backtest the global series (or every series in ``by``) and register candidates.

    Returns False and writes nothing when there are too few feature rows. The
    global series is then fitted over the periods there are. Of the series in ``by``
    those with enough rows of their own are fitted, if their rows have changed since
    they last were; the others keep their models. ``model`` is the model form.
    """
    features = stored_features(spark, layout)
    if not enough_history(features, []).take(1):
        return False
    version = _version(now)
    if by:
        series = features.select(*by, "ds", "y", model_name(f"SALES_{model}", by).alias("model_name"))
        keys = ["model_name", *by]
        fitted = _sort_series(spark, layout, batch, series, keys, model)
        series = join_on_keys(series, fitted.select(*keys), keys, "left_semi")
    else:
        series = global_series(features).withColumn("model_name", F.lit(f"SALES_{model}"))
        keys = ["model_name"]
    scored = freeze(MODELS[model](freeze(series), keys, min_rows=fixed.MIN_TRAINING_ROWS if by else 1))
    events = _events_before(spark, layout, batch)
    rows = candidate_rows(error_metrics(scored, [*keys, "n_train"]), F.col("model_name"), version, now, model)
    candidates = with_log_id(rows, events, "model_id", ["model_name"], batch)
    append_log(registry_events(candidates, CANDIDATE_STEP, now), layout.model_events, batch)

    log = read_log(spark, layout.prediction_log, schemas.PREDICTION_LOG)
    predictions = with_log_id(
        prediction_rows(scored, version, now), log, "prediction_id", [*SERIES, "period"], batch
    )
    append_log(predictions.select(*schemas.PREDICTION_LOG.names), layout.prediction_log, batch)
    if by:  # last, so a run that fails before fits them again
        append_log(fitted.select("model_name", "n", "fingerprint", moment(now).alias("trained")), layout.trained_series, batch)
    return True


def untrained_series(spark: SparkSession, layout: Layout) -> DataFrame:
    """The series that runs left out of training, with their rows, the reason and the run."""
    return read_log(spark, layout.untrained_series, schemas.UNTRAINED_SERIES)


def tidy(spark: SparkSession, layout: Layout) -> None:
    """Merge parts and logs that lie in many folders; results stay as they are."""
    merge_parts(spark, layout)
    logs = {
        layout.landed_files: FILE_VERSIONS,
        layout.repaired_lines: REPAIRED_LINES,
        layout.validation_log: schemas.VALIDATION_LOG,
        layout.model_events: schemas.MODEL_EVENTS,
        layout.comparison_log: schemas.MODEL_COMPARISON_LOG,
        layout.prediction_log: schemas.PREDICTION_LOG,
        layout.drift_metrics: schemas.DRIFT_METRICS,
        layout.series_drift: schemas.SERIES_DRIFT,
        layout.distributions: schemas.SERIES_DISTRIBUTION,
        layout.runs: schemas.PIPELINE_RUNS,
        layout.trigger_log: schemas.TRIGGER_LOG,
        layout.trained_series: schemas.TRAINED_SERIES,
        layout.untrained_series: schemas.UNTRAINED_SERIES,
    }
    for path, schema in logs.items():
        compact_log(spark, path, schema)


def compare_and_promote(spark: SparkSession, layout: Layout, batch: str, now: datetime) -> None:
    """Decide every pending candidate, log the decisions and append the new states.

    Events this batch already decided are left out, so a repeated attempt decides
    on the same registry as the first one.
    """
    registry = freeze(current_registry(_events_before(spark, layout, batch)))
    decisions = freeze(compare_models(registry, now=now))
    log = read_log(spark, layout.comparison_log, schemas.MODEL_COMPARISON_LOG)
    rows = with_log_id(comparison_log(decisions), log, "comparison_id", ["model_name"], batch)
    append_log(rows.select(*schemas.MODEL_COMPARISON_LOG.names), layout.comparison_log, batch)
    changes = freeze(registry_events(changed_rows(registry, decisions, now), DECISION_STEP, now))
    append_log(changes, layout.model_events, _decided(batch))


def check_drift(spark: SparkSession, layout: Layout, batch: str, now: datetime) -> None:
    """First run: store the baseline. Later runs: compare with it and log one row."""
    features = stored_features(spark, layout)
    log = read_log(spark, layout.drift_metrics, schemas.DRIFT_METRICS).filter(F.col(BATCH) != batch)
    known = log.filter(F.col("metric_name") == LEAD_METRIC).take(1)
    rows = drift_check(features, log, now=now) if known else drift_baseline(features, now=now)
    order = F.array_position(F.lit(fixed.DRIFT_METRICS), F.col("metric_name")).alias("_order")
    numbered = with_log_id(rows.select("*", order), log, "drift_id", ["_order"], batch, few=True)
    append_log(numbered.select(*schemas.DRIFT_METRICS.names), layout.drift_metrics, batch)


def check_series_drift(spark: SparkSession, layout: Layout, batch: str, now: datetime) -> None:
    """Every series against its own baseline; series that are new get one."""
    log = read_log(spark, layout.series_drift, schemas.SERIES_DRIFT).filter(F.col(BATCH) != batch)
    rows = freeze(drift_step(stored_features(spark, layout), log, SERIES, now))
    numbered = with_log_id(rows, log, "drift_id", [*SERIES, "metric_name"], batch)
    append_log(numbered.select(*schemas.SERIES_DRIFT.names), layout.series_drift, batch)


def check_distributions(spark: SparkSession, layout: Layout, batch: str, now: datetime) -> None:
    """The whole distribution of every series against its first one."""
    log = read_log(spark, layout.distributions, schemas.SERIES_DISTRIBUTION).filter(F.col(BATCH) != batch)
    rows = distribution_step(stored_features(spark, layout), log, SERIES, now)
    append_log(rows.select(*schemas.SERIES_DISTRIBUTION.names), layout.distributions, batch)


def _log_run(
    spark: SparkSession, layout: Layout, record: DataFrame, batch: str, few: bool = True
) -> None:
    log = read_log(spark, layout.runs, schemas.PIPELINE_RUNS)
    rows = with_log_id(record, log, "run_id", ["run_time", "phase"], batch, few)
    append_log(rows.select(*schemas.PIPELINE_RUNS.names), layout.runs, batch)


def check_health(spark: SparkSession, layout: Layout, batch: str, now: datetime) -> DataFrame:
    """Age of the production models; one run-log row per model."""
    health = freeze(model_health(stored_registry(spark, layout), now))
    _log_run(spark, layout, health_run(health, now), f"{batch}-health", few=False)
    return health


def summary(spark: SparkSession, layout: Layout) -> DataFrame:
    return pipeline_summary(
        stored_registry(spark, layout),
        stored_features(spark, layout),
        raw_sales(spark, layout),
        read_log(spark, layout.drift_metrics, schemas.DRIFT_METRICS).drop(BATCH),
    )


def run_pipeline(
    spark: SparkSession,
    out_root: str,
    now: datetime | None = None,
    batch: str | None = None,
    by: Sequence[str] = (),
    model: str = TREND_SEASONAL,
) -> DataFrame:
    """Features, training, comparison and drift in turn; returns the run-log row.

    ``batch`` names the run: running it again under the same name replaces what
    the first attempt wrote.
    """
    layout = Layout(out_root)
    now = now or datetime.now().replace(microsecond=0)
    batch = batch or now.strftime("run%Y%m%d%H%M%S")
    started = time.monotonic()
    try:
        records = refresh_features(spark, layout, now)
        train_models(spark, layout, batch, now, by, model)
        compare_and_promote(spark, layout, batch, now)
        check_drift(spark, layout, batch, now)
        check_series_drift(spark, layout, batch, now)
        check_distributions(spark, layout, batch, now)
        tidy(spark, layout)
    except Exception as problem:
        _log_full_run(spark, layout, batch, now, "FAILED", None, started, str(problem))
        raise
    _log_full_run(spark, layout, batch, now, "SUCCESS", records, started, None)
    return read_log(spark, layout.runs, schemas.PIPELINE_RUNS).filter(F.col(BATCH) == batch)


def _log_full_run(
    spark: SparkSession,
    layout: Layout,
    batch: str,
    now: datetime,
    status: str,
    records: int | None,
    started: float,
    error: str | None,
) -> None:
    one = spark.createDataFrame([(records,)], T.StructType([T.StructField("records", T.LongType())]))
    record = run_record(
        one,
        fixed.FULL_RUN_PHASE,
        F.lit(status),
        F.col("records"),
        now,
        duration_seconds=round(time.monotonic() - started),
        error_message=error,
    )
    _log_run(spark, layout, record, batch)
