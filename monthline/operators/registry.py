"""Model registry: candidates, comparison and promotion per model name.

Status changes are new rows: a registry on disk is a list of status events, and
the current registry is the newest event of every model_id.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from monthline import schemas
from monthline.functions import fixed
from monthline.functions.dates import moment
from monthline.functions.numbers import percent_below
from monthline.functions.text import fixed2_text
from monthline.operators.forecast import join_on_keys
from monthline.operators.latest import latest_with_status, newest, newest_per_key


def model_name(base: str, keys: Sequence[str] = ()) -> Column:
    """``base`` and the keys of a series, parted by ``/``.

    Backslashes and slashes in a key are escaped and NULL is ``\\N``, so no two
    series share a name.
    """
    parts = [
        F.coalesce(F.replace(F.replace(F.col(k).cast("string"), F.lit("\\"), F.lit("\\\\")), F.lit("/"), F.lit("\\/")), F.lit("\\N"))
        for k in keys
    ]
    return F.concat_ws("/", F.lit(base), *parts)


def candidate_rows(
    metrics: DataFrame,
    model_name: str | Column,
    version: str,
    now: datetime | None = None,
    model_type: str = "TREND_SEASONAL",
) -> DataFrame:
    """Registry rows (without id) for freshly backtested models."""
    name = F.lit(model_name) if isinstance(model_name, str) else model_name
    return metrics.select(
        name.alias("model_name"),
        F.lit(version).alias("model_version"),
        F.lit(model_type).alias("model_type"),
        moment(now).alias("training_date"),
        F.col("n_train").cast("long").alias("training_records"),
        "mae",
        "rmse",
        "mape",
        F.lit(fixed.CANDIDATE).alias("status"),
        F.lit(None).cast("timestamp_ntz").alias("promoted_date"),
        F.lit(fixed.NEW_MODEL_NOTE).alias("notes"),
    )


def registry_events(rows: DataFrame, step: int, now: datetime | None = None) -> DataFrame:
    """Registry rows as status events; ``step`` orders events of the same time."""
    return rows.select(
        *schemas.MODEL_REGISTRY.names,
        moment(now).alias("event_time"),
        F.lit(step).cast("int").alias("event_step"),
    )


def current_registry(events: DataFrame) -> DataFrame:
    """Newest status of every model."""
    return newest_per_key(
        events.select(*schemas.MODEL_EVENTS.names), ["model_id"], "event_time", "event_step"
    ).select(*schemas.MODEL_REGISTRY.names)


def champion_challenger(registry: DataFrame) -> DataFrame:
    """Newest PRODUCTION beside newest CANDIDATE model of each name, in one aggregation."""
    model = F.struct("model_version", "mae")
    production = F.col("status") == fixed.PRODUCTION
    candidate = F.col("status") == fixed.CANDIDATE
    return (
        registry.filter(F.col("status").isin(fixed.PRODUCTION, fixed.CANDIDATE))
        .groupBy("model_name")
        .agg(
            newest(model, production, "training_date", "model_id").alias("_p"),
            newest(model, candidate, "training_date", "model_id").alias("_c"),
        )
        .select(
            "model_name",
            F.col("_p.model_version").alias("production_model_version"),
            F.col("_c.model_version").alias("candidate_model_version"),
            F.col("_p.mae").alias("production_mae"),
            F.col("_c.mae").alias("candidate_mae"),
        )
    )


def _sentence(template: str, percent: Column, limit: float) -> Column:
    head, tail = template.format(pct="\0", limit=f"{limit:g}").split("\0")
    return F.concat(F.lit(head), fixed2_text(percent), F.lit(tail))


def compare_models(
    registry: DataFrame,
    min_improvement: float = fixed.MIN_IMPROVEMENT_PERCENT,
    now: datetime | None = None,
) -> DataFrame:
    """One decision per model name that has a candidate; names without one yield nothing."""
    gain = F.col("improvement_percent")
    first = F.col("production_model_version").isNull()
    promote = first | F.coalesce(gain >= min_improvement, F.lit(False))
    reason = (
        F.when(first, F.lit(fixed.FIRST_MODEL_REASON))
        .when(gain >= min_improvement, _sentence(fixed.IMPROVED_REASON, gain, min_improvement))
        .when(gain >= 0, _sentence(fixed.SMALL_GAIN_REASON, gain, min_improvement))
        .when(gain < 0, _sentence(fixed.WORSE_REASON, F.abs(gain), min_improvement))
        .otherwise(F.lit(fixed.NOT_COMPARABLE_REASON))
    )
    return (
        champion_challenger(registry)
        .filter(F.col("candidate_model_version").isNotNull())
        .withColumn("production_mae", F.when(~first, F.col("production_mae")))
        .withColumn("improvement_percent", percent_below(F.col("production_mae"), F.col("candidate_mae")))
        .select(
            "*",
            F.when(promote, F.lit(fixed.PROMOTE)).otherwise(F.lit(fixed.KEEP_CURRENT)).alias("decision"),
            reason.alias("decision_reason"),
            moment(now).alias("comparison_date"),
        )
    )


def apply_promotion(registry: DataFrame, decisions: DataFrame, now: datetime | None = None) -> DataFrame:
    """The registry after the decisions; rows no decision concerns stay as they are."""
    verdict = decisions.select(
        "model_name",
        F.col("production_model_version").alias("_old"),
        F.col("candidate_model_version").alias("_new"),
        "decision",
        "decision_reason",
    )
    promoted = F.col("decision") == fixed.PROMOTE
    is_new = F.col("model_version") == F.col("_new")
    wins = is_new & promoted
    loses = is_new & ~promoted
    replaced = (F.col("model_version") == F.col("_old")) & promoted & ~is_new
    changes = {
        "status": F.when(wins, F.lit(fixed.PRODUCTION))
        .when(loses | replaced, F.lit(fixed.ARCHIVED))
        .otherwise(F.col("status")),
        "promoted_date": F.when(wins, moment(now)).otherwise(F.col("promoted_date")),
        "notes": F.when(wins & F.col("_old").isNull(), F.lit(fixed.FIRST_MODEL_NOTE))
        .when(wins, F.concat(F.lit(fixed.PROMOTED_NOTE), F.col("decision_reason")))
        .when(loses, F.concat(F.lit(fixed.NOT_PROMOTED_NOTE), F.col("decision_reason")))
        .when(replaced, F.concat(F.lit(fixed.REPLACED_NOTE), F.col("_new")))
        .otherwise(F.col("notes")),
    }
    return join_on_keys(registry, verdict, ["model_name"], "left").withColumns(changes).select(*registry.columns)


def changed_rows(registry: DataFrame, decisions: DataFrame, now: datetime | None = None) -> DataFrame:
    """Only the registry rows that the decisions touch, in their new state."""
    touched = decisions.select(
        "model_name",
        F.explode(
            F.array_compact(
                F.array_distinct(
                    F.array(
                        "candidate_model_version",
                        F.when(F.col("decision") == fixed.PROMOTE, F.col("production_model_version")),
                    )
                )
            )
        ).alias("model_version"),
    )
    affected = join_on_keys(registry, touched, ["model_name", "model_version"], "left_semi")
    return apply_promotion(affected, decisions, now)


def comparison_log(decisions: DataFrame, now: datetime | None = None) -> DataFrame:
    """Decisions in the layout of the comparison log (without id)."""
    when = moment(now) if now else F.col("comparison_date")
    return decisions.select(
        when.alias("comparison_date"),
        *[c for c in schemas.MODEL_COMPARISON_LOG.names if c not in ("comparison_id", "comparison_date")],
    )


def production_info(registry: DataFrame) -> DataFrame:
    """Version, MAE and training date of the current production model of each name."""
    return latest_with_status(registry, fixed.PRODUCTION).select(
        "model_name", "model_version", "mae", "training_date"
    )


def registry_status(registry: DataFrame) -> DataFrame:
    """All models with their status, newest first."""
    return registry.orderBy(F.col("training_date").desc_nulls_last(), F.col("model_id").desc()).select(
        "model_name",
        "model_version",
        "model_type",
        "status",
        "training_date",
        "mae",
        "mape",
        "promoted_date",
        "notes",
    )
