"""Queries against their SQL counterparts on the small tables.

By default the composed operators are compared; ``PARITY=all`` compares every
registered query.
"""

from __future__ import annotations

import os
import re

import pytest

import __spark_entry__ as entry
from conftest import SMALL
from tools.check_parity import compare, connect

COMPOSED = [
    "csv_scan",
    "csv_reject_split",
    "validate_row_flags",
    "validate_batch_summary",
    "validation_rule_engine",
    "rule_conditions",
    "csv_line_breaks",
    "superseded_totals",
    "repaired_rows",
    "quarantine_split",
    "agg_sales",
    "feature_store",
    "incremental_agg",
    "fit_month_seasonality",
    "backtest_metrics",
    "align_forecast_actual",
    "compare_models",
    "apply_promotion",
    "drift_check_by_series",
    "metric_summary",
    "full_run_model",
]

NAMES = list(entry.queries()) if os.environ.get("PARITY") == "all" else COMPOSED


@pytest.fixture(scope="module")
def con():
    return connect(SMALL)


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, con, name):
    assert compare(spark, con, SMALL, name) is None


def test_names():
    names = set(entry.queries())
    assert set(entry.oracle_sql()) <= names
    without = names - set(entry.oracle_sql())
    assert not {name for name in without if name != "pipeline" and not re.match(r"op\d+_", name)}


def test_entry(spark):
    result = entry.entry(spark)
    assert result.count() > 0
    assert result.columns[0] == "feature_id"
