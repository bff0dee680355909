"""Model registry operators over the derived registry."""

from __future__ import annotations

from pyspark.sql import functions as F

from monthline import schemas
from monthline.operators.latest import latest_with_status
from monthline.operators.registry import (
    apply_promotion,
    changed_rows,
    compare_models,
    comparison_log,
    current_registry,
    production_info,
    registry_events,
    registry_status,
)
from monthline.parity import inputs as src
from monthline.parity.catalog import query
from monthline.parity.inputs import NOW, NOW_SQL, sql_over
from monthline.session import scratch_path
from monthline.sources.tables import append_log, read_table

DECISION_COLUMNS = """model_name, production_model_version, candidate_model_version, production_mae,
  candidate_mae, round(improvement_percent, 4) AS improvement_percent, decision, decision_reason"""

PROMOTED_SQL = sql_over(
    "decisions",
    select=f"""
    SELECT r.* REPLACE (
      CASE WHEN model_version = candidate_model_version AND decision = 'PROMOTE' THEN 'PRODUCTION'
           WHEN model_version = candidate_model_version THEN 'ARCHIVED'
           WHEN model_version = production_model_version AND decision = 'PROMOTE' THEN 'ARCHIVED'
           ELSE status END AS status,
      CASE WHEN model_version = candidate_model_version AND decision = 'PROMOTE' THEN {NOW_SQL} END AS promoted_date,
      CASE WHEN model_version = candidate_model_version AND production_model_version IS NULL
             THEN 'First model - auto-promoted to PRODUCTION'
           WHEN model_version = candidate_model_version AND decision = 'PROMOTE'
             THEN 'Promoted - ' || decision_reason
           WHEN model_version = candidate_model_version THEN 'Not promoted - ' || decision_reason
           WHEN model_version = production_model_version AND decision = 'PROMOTE'
             THEN 'Replaced by ' || candidate_model_version END AS notes)
    FROM registry r LEFT JOIN decisions d ON d.model_name = r.model_name""",
)


def decisions(spark, sf):
    return compare_models(src.registry(spark, sf), now=NOW)


def rounded(df):
    return df.withColumn("improvement_percent", F.round("improvement_percent", 4)).drop("comparison_date")


@query(
    "latest_production",
    sql_over(
        "registry",
        select="SELECT * FROM registry WHERE status = 'PRODUCTION' QUALIFY row_number() OVER "
        "(PARTITION BY model_name ORDER BY training_date DESC, model_id DESC) = 1",
    ),
)
def latest_production(spark, sf):
    return latest_with_status(src.registry(spark, sf), "PRODUCTION")


@query(
    "latest_candidate",
    sql_over(
        "registry",
        select="SELECT * FROM registry WHERE status = 'CANDIDATE' QUALIFY row_number() OVER "
        "(PARTITION BY model_name ORDER BY training_date DESC, model_id DESC) = 1",
    ),
)
def latest_candidate(spark, sf):
    return latest_with_status(src.registry(spark, sf), "CANDIDATE")


@query("compare_models", sql_over("decisions", select=f"SELECT {DECISION_COLUMNS} FROM decisions"))
def compare(spark, sf):
    return rounded(decisions(spark, sf))


@query(
    "promote_first_model",
    sql_over(
        "decisions",
        select=f"SELECT {DECISION_COLUMNS} FROM decisions WHERE production_model_version IS NULL",
    ),
)
def promote_first_model(spark, sf):
    return rounded(decisions(spark, sf)).filter("production_model_version is null")


@query(
    "no_candidate_noop",
    sql_over(
        "decisions",
        select="SELECT * FROM registry WHERE model_name NOT IN (SELECT model_name FROM decisions)",
    ),
)
def no_candidate_noop(spark, sf):
    """Registry rows of names without a candidate, out of the whole registry after the decisions: unchanged."""
    registry = src.registry(spark, sf)
    made = decisions(spark, sf)
    after = apply_promotion(registry, made, NOW)
    pending = registry.filter(F.col("status") == "CANDIDATE").select("model_name")
    return after.join(pending, "model_name", "left_anti")


@query("apply_promotion", PROMOTED_SQL)
def promotion(spark, sf):
    return apply_promotion(src.registry(spark, sf), decisions(spark, sf), NOW)


@query("append_log", PROMOTED_SQL)
def registry_from_events(spark, sf):
    """The same state read back from appended status events."""
    registry, made = src.registry(spark, sf), decisions(spark, sf)
    path = scratch_path(spark, "model-events")
    append_log(registry_events(registry, 0, NOW), path, "first")
    append_log(registry_events(changed_rows(registry, made, NOW), 1, NOW), path, "second")
    append_log(registry_events(changed_rows(registry, made, NOW), 1, NOW), path, "second")
    return current_registry(read_table(spark, path, schemas.MODEL_EVENTS))


@query(
    "comparison_log_row",
    sql_over("decisions", select=f"SELECT {NOW_SQL} AS comparison_date, {DECISION_COLUMNS} FROM decisions"),
)
def comparison_rows(spark, sf):
    return comparison_log(decisions(spark, sf), NOW).withColumn(
        "improvement_percent", F.round("improvement_percent", 4)
    )


@query(
    "production_model_info",
    sql_over(
        "registry",
        select="SELECT model_name, model_version, mae, training_date FROM registry WHERE status = 'PRODUCTION' "
        "QUALIFY row_number() OVER (PARTITION BY model_name ORDER BY training_date DESC, model_id DESC) = 1",
    ),
)
def production_model_info(spark, sf):
    return production_info(src.registry(spark, sf))


@query(
    "registry_status_report",
    sql_over(
        "registry",
        select="SELECT model_name, model_version, model_type, status, training_date, mae, mape, promoted_date, notes "
        "FROM registry ORDER BY training_date DESC, model_id DESC",
    ),
)
def registry_status_report(spark, sf):
    return registry_status(src.registry(spark, sf))
