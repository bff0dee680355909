"""Rejected lines that come back: once, as often as they were rejected, and with their file."""

from __future__ import annotations

from pyspark.sql import functions as F

from conftest import ordered
from monthline.plans import totals
from monthline.plans.layout import Layout
from monthline.plans.load import raw_sales
from monthline.plans.repair import quarantined, repair, repaired_lines
from monthline.session import freeze
from test_landing import box, load_all, put, sale  # noqa: F401

BAD = "B,P,S,L,Apr-23,23-24"


def fixes(spark, layout, **lines):
    waiting = quarantined(spark, layout)
    fixed = F.create_map(*[F.lit(x) for pair in lines.values() for x in pair])
    return freeze(waiting.withColumn("repaired_line", fixed[F.col("rejected_line")]).filter("repaired_line is not null"))


def sums(spark, layout):
    totals.aggregate_pending(spark, layout)
    return [(p, int(t), n) for p, t, n in ordered(totals.monthly_totals(spark, layout), "period", "total_sales", "transaction_count")]


def test_repair_replay_and_double_repair(spark, box):  # noqa: F811
    layout = Layout(str(box / "out"))
    put(box, "a.csv", sale("Apr", 1), BAD, "x,y")
    put(box, "b.csv", BAD, BAD)
    load_all(spark, box, "one")
    assert ordered(quarantined(spark, layout), "source_file", "rejected_line", "copies") == [("a.csv", BAD, 1), ("a.csv", "x,y", 1), ("b.csv", BAD, 2)]
    assert sums(spark, layout) == [("2023-04", 1, 1)]
    repairs = fixes(spark, layout, bad=(BAD, BAD + ',"1,000.00"'), short=("x,y", "x,y,z"))
    assert repair(spark, layout, repairs, "fix") == 3
    assert repair(spark, layout, repairs, "fix") == 3
    assert repair(spark, layout, repairs, "fix again") == 0
    assert ordered(raw_sales(spark, layout), "material_group", "net_sales", "source_file") == [("B", "1", "a.csv"), ("B", "1,000.00", "a.csv"), ("B", "1,000.00", "b.csv"), ("B", "1,000.00", "b.csv")]
    for _ in range(2):
        assert sums(spark, layout) == [("2023-04", 3001, 4)]
    assert ordered(quarantined(spark, layout), "rejected_line") == [("x,y",)]
    assert repaired_lines(spark, layout).count() == 2
    assert load_all(spark, box, "two").total_records == 0


def test_a_later_version_replaces_repaired_rows(spark, box):  # noqa: F811
    layout = Layout(str(box / "out"))
    put(box, "a.csv", sale("Apr", 1), BAD)
    load_all(spark, box, "one")
    repair(spark, layout, fixes(spark, layout, bad=(BAD, BAD + ",5")), "fix")
    assert sums(spark, layout) == [("2023-04", 6, 2)]
    put(box, "a.csv", sale("Apr", 2), minute=1)
    load_all(spark, box, "two")
    assert ordered(raw_sales(spark, layout), "net_sales") == [("2",)]
    assert sums(spark, layout) == [("2023-04", 2, 1)]
    assert quarantined(spark, layout).count() == 0


def test_nothing_to_repair(spark, box):  # noqa: F811
    layout = Layout(str(box / "out"))
    put(box, "a.csv", sale("Apr", 1))
    load_all(spark, box, "one")
    none = quarantined(spark, layout).withColumn("repaired_line", F.lit("x"))
    assert repair(spark, layout, none, "fix") == 0 and sums(spark, layout) == [("2023-04", 1, 1)]
