"""Totals in the state store: restarts, replays and merged micro-batches."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from conftest import SMALL, ordered
from monthline import schemas
from monthline.operators.features import agg_sales, clean_sales
from monthline.parity import inputs as src
from monthline.plans.layout import Layout
from monthline.sources.tables import batch_folders, read_log
from monthline.streaming import totals
from monthline.streaming.totals import run_totals_stream, stream_totals_table, totals_sink

HEADER = "group,description,state,location,month,fy,sales\n"


def put(folder, name, *lines):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text(HEADER + "".join(line + "\n" for line in lines))


def found(spark, out):
    return [(b, p, int(t), n) for b, p, t, n in ordered(stream_totals_table(spark, out), "brand", "period", "total_sales", "transaction_count")]


def test_restart_and_replay(spark, tmp_path):
    out, offsets, box = str(tmp_path / "out"), str(tmp_path / "offsets"), tmp_path / "in"
    put(box, "a.csv", "B,P,S,L,Apr-23,23-24,1", "NULL,P,S,L,Apr-23,23-24,5", "short,line")
    run_totals_stream(spark, str(box), out, offsets)
    put(box, "b.csv", "B,P,S,L,Apr-23,23-24,2", "B,P,S,L,May-23,23-24,3")
    run_totals_stream(spark, str(box), out, offsets)
    expected = [("B", "2023-04", 3, 2), ("B", "2023-05", 3, 1), (None, "2023-04", 5, 1)]
    assert found(spark, out) == expected
    run_totals_stream(spark, str(box), out, offsets)
    last = read_log(spark, Layout(out).stream_totals, schemas.AGG_SALES).filter("batch = '000000000001'").drop("batch")
    again = spark.createDataFrame(last.collect(), schemas.AGG_SALES)
    totals_sink(out)(again, 1)
    assert found(spark, out) == expected


def test_a_sink_that_fails_gets_the_batch_again(spark, tmp_path, monkeypatch):
    out, offsets, box = str(tmp_path / "out"), str(tmp_path / "offsets"), tmp_path / "in"
    put(box, "a.csv", "B,P,S,L,Apr-23,23-24,1")
    run_totals_stream(spark, str(box), out, offsets)
    put(box, "b.csv", "B,P,S,L,Apr-23,23-24,2")

    def lost(*args):
        raise RuntimeError("lost")

    monkeypatch.setattr(totals, "append_log", lost)
    with pytest.raises(Exception, match="lost"):
        run_totals_stream(spark, str(box), out, offsets)
    monkeypatch.undo()
    run_totals_stream(spark, str(box), out, offsets)
    assert found(spark, out) == [("B", "2023-04", 3, 2)]


def test_many_micro_batches_are_merged(spark, tmp_path):
    out, offsets, box = str(tmp_path / "out"), str(tmp_path / "offsets"), str(tmp_path / "in")
    rows = src.keyed_raw_sales(spark, SMALL).withColumn("lot", F.col("k") % 4)
    src.place_sales_files(rows, box, files=2)
    run_totals_stream(spark, box, out, offsets, max_files=1, max_batches=3)
    assert len(batch_folders(spark, Layout(out).stream_totals)) <= 4
    assert ordered(stream_totals_table(spark, out)) == ordered(agg_sales(clean_sales(src.raw_sales(spark, SMALL))))
