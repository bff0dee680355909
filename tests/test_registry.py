"""Comparison and promotion: decision table and registry transitions."""

from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from conftest import ordered, rows_of
from monthline import schemas
from monthline.operators import registry as rg
from monthline.operators.latest import latest, latest_with_status

DAY = datetime(2024, 1, 1)


def registry(spark, rows):
    """Rows of (id, name, status, mae[, day])."""
    full = []
    for number, name, status, mae, *day in rows:
        when = DAY + timedelta(days=day[0] if day else number)
        full.append((number, name, f"v{number}", "T", when, 10, mae, 1.0, 1.0, status, None, None))
    return spark.createDataFrame(full, schemas.MODEL_REGISTRY)


@pytest.mark.parametrize(
    ("production", "candidate", "decision", "reason"),
    [
        (100.0, 95.01, "KEEP_CURRENT", "Improvement only 4.99% (threshold: 5%)"),
        (100.0, 95.0, "PROMOTE", "MAE improved by 5.00%"),
        (100.0, 94.99, "PROMOTE", "MAE improved by 5.01%"),
        (100.0, 100.0, "KEEP_CURRENT", "Improvement only 0.00% (threshold: 5%)"),
        (100.0, 100.01, "KEEP_CURRENT", "Candidate is worse by 0.01%"),
        (100.0, 150.0, "KEEP_CURRENT", "Candidate is worse by 50.00%"),
        (None, 10.0, "KEEP_CURRENT", "not comparable"),
        (0.0, 10.0, "KEEP_CURRENT", "not comparable"),
        (100.0, None, "KEEP_CURRENT", "not comparable"),
    ],
)
def test_decision_table(spark, production, candidate, decision, reason):
    made = rg.compare_models(registry(spark, [(1, "m", "PRODUCTION", production), (2, "m", "CANDIDATE", candidate)]))
    assert rows_of(made, "decision", "decision_reason") == [(decision, reason)]


def test_promotion_moves_both_models(spark, now):
    before = registry(spark, [(1, "m", "PRODUCTION", 100.0), (2, "m", "CANDIDATE", 90.0), (3, "m", "ARCHIVED", 1.0)])
    made = rg.compare_models(before, now=now)
    after = rg.apply_promotion(before, made, now)
    assert after.columns == before.columns
    assert ordered(after, "model_version", "status", "promoted_date", "notes") == [
        ("v1", "ARCHIVED", None, "Replaced by v2"),
        ("v2", "PRODUCTION", now, "Promoted - MAE improved by 10.00%"),
        ("v3", "ARCHIVED", None, None),
    ]


def test_losing_candidate_is_archived(spark, now):
    before = registry(spark, [(1, "m", "PRODUCTION", 100.0), (2, "m", "CANDIDATE", 110.0)])
    after = rg.apply_promotion(before, rg.compare_models(before, now=now), now)
    assert ordered(after, "model_version", "status", "promoted_date", "notes") == [
        ("v1", "PRODUCTION", None, None),
        ("v2", "ARCHIVED", None, "Not promoted - Candidate is worse by 10.00%"),
    ]


def test_first_model_is_promoted(spark, now):
    before = registry(spark, [(1, "m", "CANDIDATE", 5.0)])
    made = rg.compare_models(before, now=now)
    assert rows_of(made, "production_model_version", "production_mae", "improvement_percent", "decision") == [
        (None, None, None, "PROMOTE")
    ]
    assert rows_of(rg.apply_promotion(before, made, now), "status", "promoted_date", "notes") == [
        ("PRODUCTION", now, "First model - auto-promoted to PRODUCTION")
    ]


def test_without_candidate_nothing_happens(spark, now):
    before = registry(spark, [(1, "m", "PRODUCTION", 100.0), (2, "m", "ARCHIVED", 1.0)])
    made = rg.compare_models(before, now=now)
    assert made.count() == 0
    assert ordered(rg.apply_promotion(before, made, now)) == ordered(before)


def test_only_the_newest_candidate_is_compared(spark, now):
    before = registry(
        spark, [(1, "m", "PRODUCTION", 100.0, 0), (2, "m", "CANDIDATE", 50.0, 1), (3, "m", "CANDIDATE", 99.0, 2), (4, "m", "CANDIDATE", 10.0, 1)]
    )
    made = rg.compare_models(before, now=now)
    assert rows_of(made, "candidate_model_version") == [("v3",)]
    after = dict(rows_of(rg.apply_promotion(before, made, now), "model_version", "status"))
    assert after == {"v1": "PRODUCTION", "v2": "CANDIDATE", "v3": "ARCHIVED", "v4": "CANDIDATE"}


def test_equal_dates_go_to_the_larger_id(spark):
    rows = [(1, "m", "CANDIDATE", 1.0, 0), (9, "m", "CANDIDATE", 2.0, 0), (5, "m", "CANDIDATE", 3.0, 0)]
    assert rows_of(latest_with_status(registry(spark, rows), "CANDIDATE"), "model_id") == [(9,)]
    assert rows_of(latest(registry(spark, rows), "training_date", 2, "model_id"), "model_id") == [(9,), (5,)]


def test_names_are_decided_apart(spark, now):
    before = registry(
        spark,
        [(1, "a", "PRODUCTION", 100.0), (2, "a", "CANDIDATE", 50.0), (3, "b", "CANDIDATE", 7.0), (4, "c", "PRODUCTION", 1.0), (5, None, "CANDIDATE", 3.0)],
    )
    after = dict(rows_of(rg.apply_promotion(before, rg.compare_models(before, now=now), now), "model_id", "status"))
    assert after == {1: "ARCHIVED", 2: "PRODUCTION", 3: "PRODUCTION", 4: "PRODUCTION", 5: "PRODUCTION"}


def test_same_version_text_under_two_statuses(spark, now):
    rows = [(1, "m", "PRODUCTION", 100.0), (2, "m", "CANDIDATE", 50.0)]
    before = registry(spark, rows).replace("v2", "v1", "model_version")
    after = rg.apply_promotion(before, rg.compare_models(before, now=now), now)
    assert after.count() == 2


@pytest.mark.parametrize("candidate", [50.0, 99.0, 150.0])
def test_state_from_events_equals_the_transition(spark, now, candidate):
    before = registry(spark, [(1, "m", "PRODUCTION", 100.0), (2, "m", "CANDIDATE", candidate), (3, "n", "CANDIDATE", 1.0), (4, "o", "ARCHIVED", 1.0)])
    made = rg.compare_models(before, now=now)
    changed = rg.changed_rows(before, made, now)
    events = rg.registry_events(before, 0, now).unionByName(rg.registry_events(changed, 1, now))
    assert ordered(rg.current_registry(events)) == ordered(rg.apply_promotion(before, made, now))
    assert changed.count() == (3 if candidate == 50.0 else 2)


def test_log_row_and_reports(spark, now):
    before = registry(spark, [(1, "m", "PRODUCTION", 100.0), (2, "m", "CANDIDATE", 90.0)])
    log = rg.comparison_log(rg.compare_models(before, now=now), now)
    assert log.columns == [c for c in schemas.MODEL_COMPARISON_LOG.names if c != "comparison_id"]
    assert rows_of(log, "comparison_date", "production_mae", "candidate_mae", "improvement_percent") == [(now, 100.0, 90.0, 10.0)]
    assert rows_of(rg.production_info(before), "model_version", "mae") == [("v1", 100.0)]
    assert rows_of(rg.registry_status(before), "model_version") == [("v2",), ("v1",)]


def test_comparison_combines_before_the_shuffle(spark):
    """A name that holds most rows leaves one partial result per task."""
    plan = rg.compare_models(registry(spark, [(1, "m", "CANDIDATE", 1.0)]))._jdf.queryExecution().executedPlan().toString()
    assert "partial_max_by" in plan
    assert "Window" not in plan


def test_extreme_errors_do_not_stop_the_other_decisions(spark, now):
    rows = []
    for i, (old, new) in enumerate([(1e-12, 1e5), (1e300, 1.0), (1.0, 1e300), (float("nan"), 1.0), (10.0, 5.0)]):
        for j, (mae, status) in enumerate([(old, "PRODUCTION"), (new, "CANDIDATE")]):
            rows.append((2 * i + j, f"m{i}", f"v{j}", mae, status))
    models = (
        spark.createDataFrame(rows, "model_id long, model_name string, model_version string, mae double, status string")
        .withColumns({"training_date": F.lit(now), "promoted_date": F.lit(None).cast("timestamp_ntz"), "notes": F.lit(None).cast("string")})
    )
    made = {r.model_name: r for r in rg.compare_models(models, now=now).collect()}
    assert len(made) == 5 and all(r.decision_reason for r in made.values())
    assert made["m4"].decision == "PROMOTE" and made["m0"].decision == "KEEP_CURRENT"


def test_names_of_different_series_differ(spark):
    keys = [("A/B", "KA"), ("A", "B/KA"), (None, "KA"), ("\\N", "KA"), ("?", "KA"), ("A\\", "/KA"), ("A\\/", "KA")]
    df = spark.createDataFrame(keys, "brand string, state string").select(rg.model_name("M", ["brand", "state"]).alias("n"))
    assert df.distinct().count() == len(keys)
