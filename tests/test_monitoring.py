"""Drift, model age, summary and dashboard queries."""

from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from conftest import ordered, rows_of
from monthline import schemas
from monthline.operators import monitoring as mo
from monthline.operators import reports


def features(spark, values, brand="b"):
    return spark.createDataFrame([(brand, "s", float(v)) for v in values], "brand string, state string, y double")


def drift_log(spark, rows):
    """Rows of (id, metric, baseline, day, status)."""
    start = datetime(2024, 1, 1)
    return spark.createDataFrame(
        [(i, start + timedelta(days=d), m, b, b, 0.0, st) for i, m, b, d, st in rows], schemas.DRIFT_METRICS
    )


def test_baseline_has_five_metrics(spark, now):
    got = {r.metric_name: r for r in mo.drift_baseline(features(spark, [1, 2, 3, 6]), now=now).collect()}
    assert {k: r.baseline_value for k, r in got.items()} == {
        "Y_MEAN": 3.0, "Y_STD": pytest.approx(2.160247), "Y_MIN": 1.0, "Y_MAX": 6.0, "RECORD_COUNT": 4.0,
    }
    assert {(r.drift_status, r.drift_score, r.check_date) for r in got.values()} == {("BASELINE", 0.0, now)}
    assert all(r.current_value == r.baseline_value for r in got.values())


def test_baseline_of_one_row_and_of_none(spark):
    one = {r.metric_name: r.baseline_value for r in mo.drift_baseline(features(spark, [5])).collect()}
    assert one["Y_STD"] is None
    assert mo.drift_baseline(features(spark, [])).count() == 0


@pytest.mark.parametrize(
    ("mean", "status"),
    [(109.99, "NORMAL"), (110.0, "WARNING"), (90.01, "NORMAL"), (124.99, "WARNING"), (125.0, "CRITICAL"), (50.0, "CRITICAL")],
)
def test_drift_limits(spark, mean, status):
    log = drift_log(spark, [(1, "Y_MEAN", 100.0, 0, "BASELINE")])
    assert rows_of(mo.drift_check(features(spark, [mean]), log), "metric_name", "drift_status") == [("Y_MEAN", status)]


def test_zero_and_negative_baselines(spark):
    zero = drift_log(spark, [(1, "Y_MEAN", 0.0, 0, "BASELINE")])
    assert rows_of(mo.drift_check(features(spark, [5]), zero), "drift_score", "drift_status") == [(None, "CRITICAL")]
    negative = drift_log(spark, [(1, "Y_MEAN", -100.0, 0, "BASELINE")])
    assert rows_of(mo.drift_check(features(spark, [-95]), negative), "drift_score", "drift_status") == [(5.0, "NORMAL")]


def test_newest_mean_gives_the_baseline(spark):
    log = drift_log(
        spark,
        [(1, "Y_MEAN", 1.0, 0, "BASELINE"), (3, "Y_MEAN", 100.0, 5, "NORMAL"), (2, "Y_MEAN", 7.0, 5, "NORMAL"), (9, "Y_MAX", 1e9, 9, "BASELINE")],
    )
    row = mo.drift_check(features(spark, [100.0]), log).first()
    assert (row.baseline_value, row.drift_score) == (100.0, 0.0)


def test_no_baseline_no_row(spark):
    other = drift_log(spark, [(1, "Y_MAX", 1.0, 0, "BASELINE")])
    assert mo.drift_check(features(spark, [1]), other).count() == 0
    by_brand = other.withColumn("brand", F.lit("b"))
    assert mo.drift_check(features(spark, [1]), by_brand, ["brand"]).count() == 0


def test_no_features_no_row(spark):
    log = drift_log(spark, [(1, "Y_MEAN", 1.0, 0, "BASELINE")])
    assert mo.drift_check(features(spark, []), log).count() == 0


def test_drift_per_series_matches_null_keys(spark):
    old = features(spark, [100]).union(features(spark, [10], None)).union(features(spark, [1], "gone"))
    log = mo.drift_baseline(old, ["brand"]).withColumn("drift_id", F.lit(1))
    new = features(spark, [130]).union(features(spark, [10.5], None)).union(features(spark, [1], "new"))
    got = ordered(mo.drift_check(new, log, ["brand"]), "brand", "drift_status")
    assert got == [("b", "CRITICAL"), (None, "NORMAL")]


def registry(spark, rows):
    return spark.createDataFrame(
        [(i, "m", f"v{i}", "T", when, 10, mae, 1.0, 1.0, status, None, None) for i, status, mae, when in rows],
        schemas.MODEL_REGISTRY,
    )


@pytest.mark.parametrize(("days", "status"), [(0, "HEALTHY"), (30, "HEALTHY"), (31, "AGING"), (90, "AGING"), (91, "STALE")])
def test_health_by_age(spark, now, days, status):
    models = registry(spark, [(1, "PRODUCTION", 5.0, now - timedelta(days=days)), (2, "CANDIDATE", 1.0, now)])
    health = mo.model_health(models, now)
    assert rows_of(health, "model_version", "age_days", "health_status") == [("v1", days, status)]
    assert rows_of(mo.health_run(health, now), "run_time", "phase", "status", "records_processed") == [
        (now, "HEALTH_CHECK", status, days)
    ]


def test_no_production_model_no_health(spark, now):
    assert mo.model_health(registry(spark, [(2, "CANDIDATE", 1.0, now)]), now).count() == 0


def test_summary(spark, now):
    models = registry(spark, [(1, "PRODUCTION", 12345678.5, now - timedelta(days=1)), (2, "CANDIDATE", 1.0, now)])
    log = drift_log(spark, [(1, "Y_MEAN", 1.0, 0, "BASELINE"), (2, "Y_MAX", 1.0, 0, "WARNING")])
    got = dict(rows_of(mo.pipeline_summary(models, features(spark, [1, 2]), features(spark, [1]), log)))
    assert got == {
        "PRODUCTION_MODEL": "v1",
        "PRODUCTION_MAE": "12345678.50",
        "TOTAL_FEATURES": "2",
        "RAW_RECORDS": "1",
        "LATEST_DRIFT_STATUS": "WARNING",
        "MODELS_TRAINED": "2",
    }


def test_summary_of_nothing(spark):
    got = dict(
        rows_of(mo.pipeline_summary(registry(spark, []), features(spark, []), features(spark, []), drift_log(spark, [])))
    )
    assert got["PRODUCTION_MODEL"] is None and got["LATEST_DRIFT_STATUS"] is None
    assert got["TOTAL_FEATURES"] == got["RAW_RECORDS"] == got["MODELS_TRAINED"] == "0"


def test_summary_view(spark, now):
    models = registry(spark, [(1, "PRODUCTION", 5.0, now)])
    name = mo.summary_view(
        spark, "summary_test", mo.pipeline_summary(models, features(spark, []), features(spark, []), drift_log(spark, []))
    )
    assert spark.sql(f"SELECT value FROM {name} WHERE metric = 'PRODUCTION_MODEL'").first()[0] == "v1"


@pytest.mark.parametrize(
    ("status", "level"), [("NORMAL", "success"), ("BASELINE", "success"), ("WARNING", "warning"), ("CRITICAL", "error")]
)
def test_drift_level(spark, status, level):
    log = drift_log(spark, [(1, "Y_MEAN", 1.0, 0, "NORMAL"), (2, "Y_MEAN", 1.0, 1, status), (3, "Y_MAX", 1.0, 2, "BASELINE")])
    assert rows_of(reports.latest_drift_level(log)) == [(status, level)]


def test_dashboard_lists_hold_ten_newest(spark, now):
    models = registry(spark, [(i, "ARCHIVED", 1.0, now + timedelta(days=i)) for i in range(15)])
    assert [r.model_version for r in reports.model_history(models).collect()] == [f"v{i}" for i in range(14, 4, -1)]
    plan = reports.model_history(models)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan
    runs = spark.createDataFrame([(i, now, "P", "S", i, None, None) for i in range(15)], schemas.PIPELINE_RUNS)
    assert [r.records_processed for r in reports.run_history(runs).collect()] == list(range(14, 4, -1))
    assert rows_of(reports.production_kpi(models)) == []
    assert rows_of(reports.row_counts(models, models.limit(3))) == [(15, 3)]
