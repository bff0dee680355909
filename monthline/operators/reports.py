"""Dashboard queries: at most ten rows each, newest first."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from monthline.functions import fixed
from monthline.operators.latest import latest
from monthline.operators.monitoring import LEAD_METRIC

LEVELS = {"success": ("NORMAL", "BASELINE"), "warning": ("WARNING",)}


def production_kpi(registry: DataFrame) -> DataFrame:
    """Version, MAE and date of the newest production model; equal dates by larger model_id."""
    in_production = registry.filter(F.col("status") == fixed.PRODUCTION)
    return latest(in_production, "training_date", 1, "model_id").select("model_version", "mae", "training_date")


def row_counts(raw: DataFrame, features: DataFrame) -> DataFrame:
    counted = raw.agg(F.count(F.lit(1)).alias("raw_records"))
    return counted.withColumn("features", features.agg(F.count(F.lit(1))).scalar())


def model_history(registry: DataFrame, n: int = 10) -> DataFrame:
    return latest(registry, "training_date", n, "model_id").select(
        "model_version", "model_type", "status", "training_date", "mae", "rmse", "mape", "notes"
    )


def drift_history(drift_log: DataFrame, n: int = 10) -> DataFrame:
    return latest(drift_log, "check_date", n, "drift_id").select(
        "check_date", "metric_name", "baseline_value", "current_value", "drift_score", "drift_status"
    )


def latest_drift_level(drift_log: DataFrame) -> DataFrame:
    """Status of the newest mean check and the display level it maps to."""
    status = F.col("drift_status")
    level = (
        F.when(status.isin(*LEVELS["success"]), F.lit("success"))
        .when(status.isin(*LEVELS["warning"]), F.lit("warning"))
        .otherwise(F.lit("error"))
    )
    newest = latest(drift_log.filter(F.col("metric_name") == LEAD_METRIC), "check_date", 1, "drift_id")
    return newest.select("drift_status", level.alias("level"))


def comparison_history(comparisons: DataFrame, n: int = 10) -> DataFrame:
    return latest(comparisons, "comparison_date", n, "comparison_id").select(
        "comparison_date",
        "production_model_version",
        "candidate_model_version",
        "production_mae",
        "candidate_mae",
        "improvement_percent",
        "decision",
        "decision_reason",
    )


def run_history(runs: DataFrame, n: int = 10) -> DataFrame:
    return latest(runs, "run_time", n, "run_id").select("run_time", "phase", "status", "records_processed")


def trigger_history(triggers: DataFrame, n: int = 10) -> DataFrame:
    return latest(triggers, "run_time", n, "new_rows").select("run_time", "new_rows", "trigger_type")
