"""Files by listing: new ones alone are read, later versions replace earlier ones, parts are merged."""

from __future__ import annotations

import os
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from conftest import ordered, rows_of
from monthline import schemas
from monthline.parity import inputs
from monthline.plans import load, totals
from monthline.plans.layout import Layout
from monthline.plans.load import landed_files, raw_sales, rejected_lines, superseded_files, validate_and_load
from monthline.sources import tables
from monthline.sources.file_list import list_files, readable
from monthline.sources.sales_csv import multi_line_files, read_sales_csv, scan_lines
from monthline.sources.tables import append_log, batch_folders, compact_log, read_log
from monthline.streaming.ingest import run_stream

HEADER = "group,description,state,location,month,fy,sales\n"
NOW = datetime(2024, 1, 1)


@pytest.fixture
def box(tmp_path):
    (tmp_path / "in").mkdir()
    return tmp_path


def put(box, name, *lines, minute=0):
    path = box / "in" / name
    path.write_text(HEADER + "".join(line + "\n" for line in lines))
    at = (NOW + timedelta(minutes=minute)).timestamp()
    os.utime(path, (at, at))


def sale(month, amount, brand="B"):
    return f"{brand},P,S,L,{month}-23,23-24,{amount}"


def load_all(spark, box, batch, **options):
    return validate_and_load(spark, str(box / "in"), str(box / "out"), batch, NOW, **options).first()


def sums(spark, box):
    layout = Layout(str(box / "out"))
    totals.aggregate_pending(spark, layout)
    return [(p, int(t), n) for p, t, n in ordered(totals.monthly_totals(spark, layout), "period", "total_sales", "transaction_count")]


def test_only_new_files_are_opened(spark, box, monkeypatch):
    put(box, "a.csv", sale("Apr", 1))
    put(box, "old [1] *.csv", sale("Apr", 2))
    load_all(spark, box, "one")
    put(box, "b c.csv", sale("May", 3))
    opened = []

    def seen(spark, path, *args, **kwargs):
        lines = scan_lines(spark, path, *args, **kwargs)
        opened.extend(os.path.basename(f) for f in lines.inputFiles())
        return lines

    monkeypatch.setattr(load, "scan_lines", seen)
    assert load_all(spark, box, "two").total_records == 1
    assert opened == ["b%20c.csv"]
    assert load_all(spark, box, "three").total_records == 0
    assert opened == ["b%20c.csv"]
    assert ordered(raw_sales(spark, Layout(str(box / "out"))), "net_sales") == [("1",), ("2",), ("3",)]
    assert landed_files(spark, Layout(str(box / "out"))).count() == 3


def test_listing_opens_no_file(spark, box):
    put(box, "a.csv", sale("Apr", 1))
    plan = list_files(spark, str(box / "in"))._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<>" in plan
    assert readable(["file:/x/a%20b%5B1%5D*.csv"]) == ["file:/x/a b\\[1\\]\\*.csv"]


def test_a_file_without_lines_is_landed_once(spark, box, monkeypatch):
    put(box, "empty.csv")
    put(box, "a.csv", sale("Apr", 1))
    load_all(spark, box, "one")
    monkeypatch.setattr(load, "scan_lines", None)
    assert load_all(spark, box, "two").total_records == 0


def test_a_later_version_replaces_rows_and_totals(spark, box):
    put(box, "a.csv", sale("Apr", 10))
    put(box, "b.csv", sale("Apr", 5), sale("May", 7), "short,line")
    load_all(spark, box, "one")
    assert sums(spark, box) == [("2023-04", 15, 2), ("2023-05", 7, 1)]
    put(box, "a.csv", sale("Apr", 11), sale("Jun", 1), minute=1)
    layout = Layout(str(box / "out"))
    assert load_all(spark, box, "two").total_records == 2
    assert ordered(raw_sales(spark, layout), "net_sales") == [("1",), ("11",), ("5",), ("7",)]
    for _ in range(2):
        assert sums(spark, box) == [("2023-04", 16, 2), ("2023-05", 7, 1), ("2023-06", 1, 1)]
    put(box, "b.csv", minute=2)
    load_all(spark, box, "three")
    assert sums(spark, box) == [("2023-04", 11, 1), ("2023-06", 1, 1)]
    assert superseded_files(spark, layout).count() == 2
    assert raw_sales(spark, layout, "one").count() == 3 and rejected_lines(spark, layout, "one").count() == 1


def test_several_versions_before_the_totals_are_made(spark, box):
    for version in range(3):
        put(box, "a.csv", sale("Apr", 10 + version), minute=version)
        load_all(spark, box, f"batch {version}")
    assert sums(spark, box) == [("2023-04", 12, 1)]
    put(box, "a.csv", sale("Apr", 10), minute=0)  # the first version again: an old one, and landed already
    assert load_all(spark, box, "again").total_records == 0
    assert sums(spark, box) == [("2023-04", 12, 1)]


def test_an_old_version_that_comes_late_counts_nothing(spark, box):
    put(box, "a.csv", sale("Apr", 2), minute=5)
    load_all(spark, box, "one")
    put(box, "a.csv", sale("Apr", 1), sale("May", 1), minute=3)
    load_all(spark, box, "two")
    assert sums(spark, box) == [("2023-04", 2, 1)]
    assert ordered(raw_sales(spark, Layout(str(box / "out"))), "net_sales") == [("2",)]


def test_replays_change_nothing(spark, box):
    put(box, "a.csv", sale("Apr", 1))
    load_all(spark, box, "one")
    put(box, "a.csv", sale("Apr", 2), minute=1)
    layout = Layout(str(box / "out"))
    for _ in range(2):
        load_all(spark, box, "two")
        totals.aggregate_pending(spark, layout, "two")
        assert sums(spark, box) == [("2023-04", 2, 1)]
    with pytest.raises(ValueError, match="other files"):
        load_all(spark, box, "one")


def test_lines_of_an_attempt_that_did_not_end_are_not_current(spark, box, monkeypatch):
    put(box, "a.csv", sale("Apr", 1))

    def lost(*args):
        raise RuntimeError("lost")

    monkeypatch.setattr(load, "append_log", lost)
    with pytest.raises(RuntimeError):
        load_all(spark, box, "one")
    monkeypatch.undo()
    load_all(spark, box, "two")
    assert raw_sales(spark, Layout(str(box / "out"))).count() == 1
    assert sums(spark, box) == [("2023-04", 1, 1)]


def test_pending_batches_take_one_write(spark, box, monkeypatch):
    for k in range(4):
        put(box, f"{k}.csv", *([sale("Apr", k)] if k else []))
        load_all(spark, box, f"batch {k}")
    writes = []
    monkeypatch.setattr(totals, "replace_partitions", lambda *args: writes.append(1) or tables.replace_partitions(*args))
    assert sums(spark, box) == [("2023-04", 6, 3)]
    assert sums(spark, box) == [("2023-04", 6, 3)] and writes == [1]
    assert batch_folders(spark, Layout(str(box / "out")).agg_parts) == [f"batch {k}" for k in range(4)]


def two_hundred(spark, layout):
    rows = spark.range(200).selectExpr("'B' brand", "'S' state", "concat('2023-0', id % 9 + 1) period", "cast(id as decimal(25,2)) total_sales", "1L transaction_count", "concat('b', id) batch")
    units = {f.name: F.lit(None).cast(f.dataType) for f in totals._UNIT_FIELDS}
    rows.withColumns(units).write.mode("append").partitionBy("batch").parquet(layout.agg_parts)


def test_many_parts_are_merged(spark, box):
    layout = Layout(str(box / "out"))
    two_hundred(spark, layout)
    before = ordered(totals.monthly_totals(spark, layout))
    assert totals.merge_parts(spark, layout) and not totals.merge_parts(spark, layout)
    assert batch_folders(spark, layout.agg_parts) == []
    assert ordered(totals.monthly_totals(spark, layout)) == before
    two_hundred(spark, layout)  # parts that come again are those that were merged
    assert ordered(totals.monthly_totals(spark, layout)) == before
    assert totals.merge_parts(spark, layout) and ordered(totals.monthly_totals(spark, layout)) == before


@pytest.mark.parametrize("at", ["replace_table", "remove_batches"])
def test_a_merge_that_ends_half_way_loses_nothing(spark, box, monkeypatch, at):
    layout = Layout(str(box / "out"))
    two_hundred(spark, layout)
    before = ordered(totals.monthly_totals(spark, layout))

    def lost(*args):
        raise RuntimeError("lost")

    monkeypatch.setattr(totals, at, lost)
    with pytest.raises(RuntimeError):
        totals.merge_parts(spark, layout)
    monkeypatch.undo()
    assert ordered(totals.monthly_totals(spark, layout)) == before
    totals.merge_parts(spark, layout)
    assert ordered(totals.monthly_totals(spark, layout)) == before and batch_folders(spark, layout.agg_parts) == []


def test_files_are_taken_back_from_merged_parts_once(spark, box):
    layout = Layout(str(box / "out"))
    put(box, "a.csv", sale("Apr", 1))
    load_all(spark, box, "one")
    sums(spark, box)
    totals.merge_parts(spark, layout, 0)
    put(box, "a.csv", sale("Apr", 2), sale("May", 3), minute=1)
    load_all(spark, box, "two")
    for _ in range(3):
        assert sums(spark, box) == [("2023-04", 2, 1), ("2023-05", 3, 1)]
        totals.merge_parts(spark, layout, 0)
    totals.aggregate_pending(spark, layout, "two")
    assert sums(spark, box) == [("2023-04", 2, 1), ("2023-05", 3, 1)]


@pytest.mark.parametrize("at", [None, "replace_table", "remove_batches"])
def test_logs_of_many_batches_are_compacted(spark, folder, monkeypatch, at):
    df = spark.range(2)
    for k in range(6):
        append_log(df.selectExpr(f"id + {10 * k} id"), folder("log"), f"b {k}")
    before = ordered(read_log(spark, folder("log"), df.schema))
    if at:
        monkeypatch.setattr(tables, at, lambda *args: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            compact_log(spark, folder("log"), df.schema, 3)
        monkeypatch.undo()
        assert ordered(read_log(spark, folder("log"), df.schema)) == before
    assert compact_log(spark, folder("log"), df.schema, 3) and not compact_log(spark, folder("log"), df.schema, 3)
    assert ordered(read_log(spark, folder("log"), df.schema)) == before and batch_folders(spark, folder("log")) == []
    append_log(df.selectExpr("id + 100 id"), folder("log"), "b 2")  # a merged batch is made again
    changed = [row for row in before if row[1] != "b 2"] + [(100, "b 2"), (101, "b 2")]
    assert ordered(read_log(spark, folder("log"), df.schema)) == sorted(changed, key=lambda r: str(r[0]))
    assert compact_log(spark, folder("log"), df.schema, 0)
    assert ordered(read_log(spark, folder("log"), df.schema)) == sorted(changed, key=lambda r: str(r[0]))


BREAKS = [
    'B1,"two\nlines, ""x""",CA,L,Apr-23,23-24,"1,234.50"',
    'B2,short,"li\nne"',
    "B3,P,S,L,May-23,23-24,7",
    '"""q",P,S,L,May-23,23-24,7,extra',
]


def test_quoted_line_breaks(spark, box):
    put(box, "a.csv", *BREAKS)
    put(box, "b.csv", sale("May", 9, "B4"), "short,line")
    put(box, "stray.csv", '"B5,P,S,L,May-23,23-24,7', sale("May", 8, "B6"))
    assert [os.path.basename(f) for f in multi_line_files(spark, str(box / "in"))] == ["a.csv"]
    good, bad = read_sales_csv(spark, str(box / "in"))
    assert ordered(good, "material_group", "material_description", "net_sales", "source_file") == [
        ("B1", 'two\nlines, "x"', "1,234.50", "a.csv"), ("B3", "P", "7", "a.csv"), ("B4", "P", "9", "b.csv"), ("B6", "P", "8", "stray.csv"),
    ]
    assert ordered(bad) == [
        ("a.csv", '"""q",P,S,L,May-23,23-24,7,extra'), ("a.csv", 'B2,short,"li\nne"'), ("b.csv", "short,line"), ("stray.csv", '"B5,P,S,L,May-23,23-24,7'),
    ]


@pytest.mark.parametrize("stream", [True, False])
def test_quoted_line_breaks_are_landed(spark, box, stream):
    put(box, "a.csv", *BREAKS)
    put(box, "b.csv", sale("May", 9, "B4"))
    out = str(box / "out")
    if stream:
        run_stream(spark, str(box / "in"), out, str(box / "offsets"), clock=lambda: NOW, train=False, name="s")
    else:
        load_all(spark, box, "one")
    assert ordered(raw_sales(spark, Layout(out)), "material_group", "net_sales") == [("B1", "1,234.50"), ("B3", "7"), ("B4", "9")]
    assert rows_of(rejected_lines(spark, Layout(out)).groupBy().count()) == [(2,)]


def test_empty_folder(spark, box):
    put(box, "empty.csv")
    assert load_all(spark, box, "one").total_records == 0
    assert sums(spark, box) == []
    assert read_log(spark, Layout(str(box / "out")).agg_parts, schemas.AGG_SALES).count() == 1


def test_batches_that_have_totals_are_not_read_again(spark, box):
    put(box, "a.csv", sale("Apr", 1))
    load_all(spark, box, "one")
    assert sums(spark, box) == [("2023-04", 1, 1)]
    for folder, _, names in os.walk(box / "out" / "raw" / "landing" / "batch=one"):
        for name in names:
            if name.endswith(".parquet"):
                (box / "spoilt").write_bytes(b"no parquet file")
                os.replace(box / "spoilt", os.path.join(folder, name))
    put(box, "b.csv", sale("May", 3))
    load_all(spark, box, "two")
    assert sums(spark, box) == [("2023-04", 1, 1), ("2023-05", 3, 1)]


def test_current_rows_are_not_dealt_out_by_their_file(spark, box):
    put(box, "a.csv", sale("Apr", 1))
    load_all(spark, box, "one")
    put(box, "a.csv", sale("Apr", 2), minute=1)
    load_all(spark, box, "two")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = raw_sales(spark, Layout(str(box / "out")))
        plan = rows._jdf.queryExecution().optimizedPlan().toString()
        assert ordered(rows, "net_sales") == [("2",)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    joins = [line for line in plan.splitlines() if "Join LeftSemi" in line or "Join LeftAnti" in line]
    assert joins and all("rightHint=(strategy=broadcast)" in line for line in joins)


def test_placed_files_do_not_grow_with_the_table(spark, box, monkeypatch):
    spark.range(1000).withColumnRenamed("id", "l_orderkey").write.parquet(str(box / "sf" / "lineitem.parquet"))
    assert inputs.files_per_lot(spark, str(box / "sf")) == 4
    monkeypatch.setattr(inputs, "FILE_ROWS", 10)
    files = inputs.files_per_lot(spark, str(box / "sf"))
    assert files == 25
    kept = {name: F.lit("x") for name in inputs.FIELDS}
    rows = spark.range(1000).withColumnRenamed("id", "k").withColumns(kept).withColumn("lot", F.col("k") % 4)
    for _ in range(2):  # the same names again
        inputs.place_sales_files(rows, str(box / "in"), files)
    sizes = [len(f.read_text().splitlines()) - 1 for f in (box / "in").glob("*.csv")]
    assert sum(sizes) == 1000 and len(sizes) > 90 and max(sizes) <= 40
