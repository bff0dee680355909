"""Data drift against a stored baseline, model age, and the metric summary."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from monthline.functions import fixed
from monthline.functions.dates import age_days, moment
from monthline.functions.labels import label_above, label_below
from monthline.functions.text import fixed2_text
from monthline.operators.forecast import join_on_keys
from monthline.operators.latest import latest_with_status, newest

LEAD_METRIC = fixed.DRIFT_METRICS[0]


def distribution_stats(features: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Mean, sample deviation, range and row count of ``y`` in one pass."""
    return features.groupBy(*by).agg(
        F.avg("y").alias("y_mean"),
        F.stddev_samp("y").alias("y_std"),
        F.min("y").alias("y_min"),
        F.max("y").alias("y_max"),
        F.count(F.lit(1)).alias("record_count"),
    )


def drift_baseline(
    features: DataFrame, by: Sequence[str] = (), now: datetime | None = None
) -> DataFrame:
    """First check: five metrics per key, each its own baseline. No rows for no features."""
    stats = distribution_stats(features, by).filter("record_count > 0")
    metrics = F.array(
        *[
            F.struct(
                F.lit(name).alias("metric_name"), F.col(name.lower()).cast("double").alias("baseline_value")
            )
            for name in fixed.DRIFT_METRICS
        ]
    )
    return stats.select(*by, F.inline(metrics)).select(
        *by,
        moment(now).alias("check_date"),
        "metric_name",
        "baseline_value",
        F.col("baseline_value").alias("current_value"),
        F.lit(0.0).alias("drift_score"),
        F.lit(fixed.DRIFT_BASELINE).alias("drift_status"),
    )


def drift_percent(current: Column, baseline: Column) -> Column:
    """Distance from the baseline in percent of it; NULL for a zero baseline."""
    return F.abs(F.try_divide(current - baseline, baseline)) * 100


def drift_check(
    features: DataFrame,
    drift_log: DataFrame,
    by: Sequence[str] = (),
    warn: float = fixed.DRIFT_LABELS[0][0],
    crit: float = fixed.DRIFT_LABELS[1][0],
    now: datetime | None = None,
) -> DataFrame:
    """Later checks: the mean of ``y`` against the baseline of the newest mean in the log.

    With ``by`` every key is compared with its own baseline. What has no baseline
    yields nothing and is due for ``drift_baseline``.
    """
    means = (
        features.groupBy(*by)
        .agg(F.avg("y").alias("current_value"), F.count(F.lit(1)).alias("_rows"))
        .filter("_rows > 0")
    )
    baselines = (
        drift_log.filter(F.col("metric_name") == LEAD_METRIC)
        .groupBy(*by)
        .agg(newest(F.struct("baseline_value"), None, "check_date", "drift_id").alias("_baseline"))
    )
    paired = join_on_keys(means, baselines, by) if by else means.withColumn("_baseline", baselines.scalar())
    paired = paired.filter(F.col("_baseline").isNotNull()).select("*", "_baseline.baseline_value")
    score = drift_percent(F.col("current_value"), F.col("baseline_value"))
    labels = [(warn, fixed.DRIFT_LABELS[0][1]), (crit, fixed.DRIFT_LABELS[1][1])]
    return paired.withColumn("drift_score", score).select(
        *by,
        moment(now).alias("check_date"),
        F.lit(LEAD_METRIC).alias("metric_name"),
        "baseline_value",
        "current_value",
        "drift_score",
        label_below(F.col("drift_score"), labels, fixed.DRIFT_WORST).alias("drift_status"),
    )


def drift_step(
    features: DataFrame, drift_log: DataFrame, by: Sequence[str], now: datetime | None = None
) -> DataFrame:
    """One check of every key: the mean against its baseline, or all five metrics as baseline of a new key.

    The features are read once; keys that the log does not know get their baseline now.
    """
    stats = distribution_stats(features, by).filter("record_count > 0")
    baselines = (
        drift_log.filter(F.col("metric_name") == LEAD_METRIC)
        .groupBy(*by)
        .agg(newest(F.struct("baseline_value"), None, "check_date", "drift_id").alias("_baseline"))
    )
    paired = join_on_keys(stats, baselines, by, "left")
    mean, base = F.col("y_mean"), F.col("_baseline.baseline_value")
    score = drift_percent(mean, base)
    labels = [(fixed.DRIFT_LABELS[0][0], fixed.DRIFT_LABELS[0][1]), (fixed.DRIFT_LABELS[1][0], fixed.DRIFT_LABELS[1][1])]

    def row(name: str, baseline: Column, current: Column, drift: Column, status: Column) -> Column:
        return F.struct(
            F.lit(name).alias("metric_name"),
            baseline.cast("double").alias("baseline_value"),
            current.cast("double").alias("current_value"),
            drift.alias("drift_score"),
            status.alias("drift_status"),
        )

    first = F.array(
        *[row(name, F.col(name.lower()), F.col(name.lower()), F.lit(0.0), F.lit(fixed.DRIFT_BASELINE)) for name in fixed.DRIFT_METRICS]
    )
    later = F.array(row(LEAD_METRIC, base, mean, score, label_below(score, labels, fixed.DRIFT_WORST)))
    rows = paired.select(*by, F.inline(F.when(F.col("_baseline").isNull(), first).otherwise(later)))
    return rows.select(
        *by, moment(now).alias("check_date"), "metric_name", "baseline_value", "current_value", "drift_score", "drift_status"
    )


def model_health(
    registry: DataFrame,
    now: datetime | None = None,
    aging: int = fixed.AGING_DAYS,
    stale: int = fixed.STALE_DAYS,
) -> DataFrame:
    """Age in days and health of the production model of each name."""
    production = latest_with_status(registry, fixed.PRODUCTION)
    age = age_days(moment(now), F.col("training_date"))
    return production.withColumn("age_days", age).select(
        "model_name",
        "model_version",
        "mae",
        "training_date",
        "age_days",
        label_above(F.col("age_days"), [(stale, "STALE"), (aging, "AGING")], "HEALTHY").alias("health_status"),
    )


def run_record(
    source: DataFrame,
    phase: str,
    status: Column,
    records: Column,
    now: datetime | None = None,
    duration_seconds: int | None = None,
    error_message: str | None = None,
) -> DataFrame:
    """Rows of the run log (without id)."""
    return source.select(
        moment(now).alias("run_time"),
        F.lit(phase).alias("phase"),
        status.alias("status"),
        records.cast("long").alias("records_processed"),
        F.lit(duration_seconds).cast("int").alias("duration_seconds"),
        F.lit(error_message).cast("string").alias("error_message"),
    )


def health_run(health: DataFrame, now: datetime | None = None) -> DataFrame:
    """Run-log rows of a health check; the record count carries the age in days."""
    return run_record(health, fixed.HEALTH_PHASE, F.col("health_status"), F.col("age_days"), now)


def pipeline_summary(
    registry: DataFrame, features: DataFrame, raw: DataFrame, drift_log: DataFrame
) -> DataFrame:
    """(metric, value) in long form, from one aggregate per table."""
    production = F.col("status") == fixed.PRODUCTION
    models = registry.agg(
        newest(F.struct("model_version", "mae"), production, "training_date", "model_id").alias("_p"),
        F.count(F.lit(1)).alias("_n"),
    )
    names = dict(zip(
        ("version", "mae", "features", "raw", "drift", "trained"), fixed.SUMMARY_METRICS, strict=True
    ))

    def line(name: str, value: Column) -> Column:
        return F.struct(F.lit(names[name]).alias("metric"), value.cast("string").alias("value"))

    parts = [
        models.select(
            F.inline(
                F.array(
                    line("version", F.col("_p.model_version")),
                    line("mae", fixed2_text(F.col("_p.mae"))),
                    line("trained", F.col("_n")),
                )
            )
        ),
        features.agg(F.count(F.lit(1)).alias("n")).select(F.inline(F.array(line("features", F.col("n"))))),
        raw.agg(F.count(F.lit(1)).alias("n")).select(F.inline(F.array(line("raw", F.col("n"))))),
        drift_log.agg(newest(F.col("drift_status"), None, "check_date", "drift_id").alias("s")).select(
            F.inline(F.array(line("drift", F.col("s"))))
        ),
    ]
    summary = parts[0]
    for extra in parts[1:]:
        summary = summary.unionByName(extra)
    return summary


def summary_view(spark, name: str, summary: DataFrame) -> str:
    """Register the summary under ``name`` for use in SQL."""
    summary.createOrReplaceTempView(name)
    return name
