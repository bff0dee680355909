"""Row checks, batch status, rules and quarantine on hand-made rows."""

from __future__ import annotations

import json

import pytest

from conftest import ordered, rows_of
from monthline import schemas
from monthline.functions import fixed
from monthline.operators import validation
from monthline.operators.validation import (
    apply_rules,
    check_counts,
    check_rules,
    flag_rows,
    quarantine,
    summarise,
    total_counts,
    validate,
    validation_log_rows,
)
from monthline.sources.tables import load_rules, read_replaced, rules_frame

GOOD = ("b1", "p", "s", "l", "Apr-23", "23-24", "1,000.50")


def raw(spark, rows):
    return spark.createDataFrame([(*r, "f.csv", None) for r in rows], schemas.RAW_SALES)


def change(**values):
    row = dict(zip(schemas.SALES_FILE.names, GOOD, strict=True))
    row.update(values)
    return tuple(row.values())


def test_only_format_checks_make_a_row_invalid(spark):
    rows = [
        GOOD,
        change(material_group=None, sold_state=None),
        change(month=None),
        change(fy=None),
        change(net_sales=None),
        change(net_sales="n/a", month="2024/05", fy="2023-24"),
        change(net_sales="nan"),
    ]
    got = rows_of(flag_rows(raw(spark, rows)), "is_valid", "null_material_group", "bad_net_sales", "bad_month", "bad_fy")
    assert got == [
        (True, False, False, False, False),
        (True, True, False, False, False),
        (False, False, False, True, False),
        (False, False, False, False, True),
        (False, False, True, False, False),
        (False, False, True, True, True),
        (True, False, False, False, False),
    ]


def test_a_row_failing_three_checks_counts_once(spark):
    row = validate(raw(spark, [GOOD, change(net_sales="x", month="x", fy="x")]), "b").first()
    assert (row.total_records, row.valid_records, row.invalid_records) == (2, 1, 1)


@pytest.mark.parametrize(
    ("bad", "total", "status"), [(1, 20, "PASSED"), (2, 39, "FAILED"), (0, 3, "PASSED"), (501, 10_000, "FAILED"), (500, 10_000, "PASSED")]
)
def test_status_limit(spark, bad, total, status):
    good = spark.range(total - bad).selectExpr("'Apr-23' month")
    wrong = spark.range(bad).selectExpr("'x' month")
    df = good.union(wrong).selectExpr(
        "'b' material_group", "'p' material_description", "'s' sold_state", "'l' supply_location",
        "month", "'23-24' fy", "'1' net_sales", "'f' source_file",
    )
    assert validate(df, "b").first().validation_status == status


def test_empty_batch_passes(spark, now):
    row = validate(raw(spark, []), "empty", now=now).first()
    assert (row.total_records, row.invalid_records, row.error_rate) == (0, 0, 0.0)
    assert row.validation_status == "PASSED"
    assert row.error_details == []
    assert row.validation_time == now


def test_messages_in_fixed_order(spark):
    rows = [change(fy=None, material_group=None), change(net_sales="x"), change(month="bad", sold_state=None)]
    assert validate(raw(spark, rows), "b").first().error_details == [
        "MATERIAL_GROUP has 1 null values",
        "SOLD_STATE has 1 null values",
        "FY has 1 null values",
        "NET_SALES: 1 non-numeric values",
        "MONTH: 1 invalid format",
        "FY: 1 invalid format",
    ]


def test_summary_per_file(spark):
    rows = [(*GOOD, "a.csv", None), (*change(fy="x"), "b.csv", None), (*GOOD, "b.csv", None)]
    df = spark.createDataFrame(rows, schemas.RAW_SALES)
    got = ordered(validate(df, "b", by="source_file"), "source_file", "total_records", "invalid_records", "validation_status")
    assert got == [("a.csv", 1, 0, "PASSED"), ("b.csv", 2, 1, "FAILED")]


def test_totals_of_files_equal_the_whole(spark, now):
    rows = [(*GOOD, "a.csv", None), (*change(fy="x"), "b.csv", None), (*change(month=None), "b.csv", None)]
    df = spark.createDataFrame(rows, schemas.RAW_SALES)
    for part in (df, df.limit(0)):
        summed = summarise(total_counts(check_counts(part, ["source_file"])), "b", now=now)
        assert rows_of(summed) == rows_of(validate(part, "b", now=now))


def test_error_details_survive_storage_as_variant(spark, folder, now):
    rows = validation_log_rows(validate(raw(spark, [change(fy=None)]), "b", now=now))
    rows.write.parquet(folder("log"))
    stored = spark.read.parquet(folder("log")).selectExpr("to_json(error_details) j").first().j
    assert json.loads(stored) == ["FY has 1 null values", "FY: 1 invalid format"]


def test_all_rules(spark):
    rows = [GOOD, change(material_group=None), change(net_sales="-5"), change(net_sales="n/a"), change(month="2024/05")]
    got = dict(rows_of(apply_rules(raw(spark, rows), rules_frame(spark))))
    assert sorted(got) == sorted(r[0] for r in fixed.VALIDATION_RULES)
    assert {k: v for k, v in got.items() if v} == {
        "MATERIAL_GROUP_EXISTS": 1,
        "MATERIAL_GROUP_NOT_NULL": 1,
        "NET_SALES_NUMERIC": 1,
        "MONTH_FORMAT": 1,
        "NET_SALES_POSITIVE": 2,
    }


def test_inactive_rules_and_missing_columns(spark):
    rules = [
        ("OFF", "NULL_CHECK", "FY", "FY IS NOT NULL", False),
        ("NO_COLUMN", "SCHEMA", "REGION", "Column must exist"),
        ("ON", "NULL_CHECK", "FY", "FY IS NOT NULL"),
    ]
    df = raw(spark, [GOOD, change(fy=None)])
    assert sorted(rows_of(apply_rules(df, rules_frame(spark, rules)))) == [("NO_COLUMN", 2), ("ON", 1)]
    assert rows_of(apply_rules(df, rules_frame(spark, rules[:1]))) == []


def test_unknown_rule_is_refused(spark):
    for rule in (("X", "MAGIC", "FY", "?"), ("X", "FORMAT", "FY", "?"), ("X", "RANGE", "FY", "?")):
        with pytest.raises(Exception, match="unknown rule"):
            apply_rules(raw(spark, [GOOD]), rules_frame(spark, [rule])).collect()


RULES = [
    ("COMPARE", "EXPRESSION", None, "length(fy) = 5"),
    ("RANGE", "EXPRESSION", "NET_SALES", "try_cast(net_sales AS double) BETWEEN 0 AND 500"),
    ("LIST", "EXPRESSION", None, "upper(sold_state) IN ('CA', 'TX')"),
    ("PATTERN", "EXPRESSION", None, "month RLIKE '^[A-Z][a-z]{2}-[0-9]{2}$'"),
    ("COLUMNS", "EXPRESSION", None, "material_group <> material_description"),
    ("NULL_CHECK", "NULL_CHECK", "FY", "FY IS NOT NULL"),
    ("PRESENT", "SCHEMA", "FY", "Column must exist"),
    ("ABSENT", "SCHEMA", "REGION", "Column must exist"),
    ("NO_COLUMN", "EXPRESSION", None, "region = 'x'"),
    ("NO_SQL", "EXPRESSION", None, "fy = = 5"),
    ("NO_CONDITION", "EXPRESSION", None, "fy"),
    ("AGGREGATE", "EXPRESSION", None, "sum(length(fy)) > 1"),
    ("EMPTY", "EXPRESSION", None, None),
    ("MAGIC", "MAGIC", "FY", "?"),
    ("OFF", "EXPRESSION", None, "false", False),
]


@pytest.mark.parametrize("per_scan", [200, 2])
def test_rules_as_conditions(spark, monkeypatch, per_scan):
    monkeypatch.setattr(validation, "CHECKS_PER_SCAN", per_scan)
    rows = [GOOD, change(fy=None), change(sold_state="ny"), change(net_sales="x"), change(month="jan24")]
    got = {r.rule_name: (r.failing_rows, r.problem) for r in check_rules(raw(spark, rows), rules_frame(spark, RULES)).collect()}
    assert got["COMPARE"] == (1, None) and got["NULL_CHECK"] == (1, None)
    assert got["PRESENT"] == (0, None) and got["ABSENT"] == (5, None)
    assert got["RANGE"] == (5, None) and got["COLUMNS"] == (0, None)
    assert got["PATTERN"] == (1, None) and got["LIST"] == (5, None) and "OFF" not in got
    for name in ("NO_COLUMN", "NO_SQL", "NO_CONDITION", "AGGREGATE", "EMPTY", "MAGIC"):
        assert got[name][0] is None and got[name][1], name
    assert check_rules(raw(spark, []), rules_frame(spark, RULES[:1])).collect()[0].failing_rows == 0
    assert check_rules(raw(spark, rows), rules_frame(spark, RULES[-1:])).collect() == []


def test_only_asked_checks_are_counted(spark):
    plan = apply_rules(raw(spark, [GOOD]), rules_frame(spark))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("count_if") + plan.count("count(if") <= 12


def test_many_rules_are_one_pass(spark):
    rules = [(f"R{i}", "NULL_CHECK", "FY", "FY IS NOT NULL") for i in range(12_000)]
    got = apply_rules(raw(spark, [GOOD, change(fy=None)]), rules_frame(spark, rules))
    assert got.count() == 12_000 and got.select("failing_rows").distinct().collect()[0][0] == 1


def test_reloading_rules_replaces_them(spark, folder):
    load_rules(spark, [("OLD", "NULL_CHECK", "FY", "FY IS NOT NULL")], folder("rules"))
    load_rules(spark, fixed.VALIDATION_RULES, folder("rules"))
    stored = read_replaced(spark, folder("rules"), schemas.VALIDATION_RULES).orderBy("rule_id")
    assert rows_of(stored, "rule_id", "rule_name") == [(i, r[0]) for i, r in enumerate(fixed.VALIDATION_RULES, 1)]


def test_quarantine_keeps_every_row(spark):
    df = raw(spark, [GOOD, change(fy="x"), change(month=None), GOOD])
    good, bad = quarantine(df)
    assert good.columns == df.columns
    assert (good.count(), bad.count()) == (2, 2)
    assert ordered(bad, "bad_month", "bad_fy") == [(False, True), (True, False)]
