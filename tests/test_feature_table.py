"""The feature table by series: equal to a full rebuild, other buckets untouched; training on what changed."""

from __future__ import annotations

import os
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from conftest import SMALL, ordered
from monthline import schemas
from monthline.operators.features import feature_store
from monthline.operators.row_id import running_total
from monthline.parity import inputs as src
from monthline.plans import feature_table, totals, train
from monthline.plans.feature_table import numbered_features, refresh, stored_features
from monthline.plans.layout import Layout
from monthline.plans.load import validate_and_load
from monthline.sources.tables import read_log

NOW = datetime(2024, 1, 1)
HEADER = "group,description,state,location,month,fy,sales\n"
MONTHS = ["Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"]


@pytest.fixture
def box(tmp_path):
    (tmp_path / "in").mkdir()
    return tmp_path


def put(box, name, brands, years=(23,), amount=1, minute=0):
    lines = [f"{b},P,{s},L,{m}-{y},{y}-{y + 1},{amount * (k + 1)}" for b, s in brands for y in years for k, m in enumerate(MONTHS)]
    path = box / "in" / name
    path.write_text(HEADER + "".join(line + "\n" for line in lines))
    at = (NOW + timedelta(minutes=minute)).timestamp()
    os.utime(path, (at, at))


def load(spark, box, batch):
    validate_and_load(spark, str(box / "in"), str(box / "out"), batch, NOW)
    totals.aggregate_pending(spark, Layout(str(box / "out")))


def check(spark, layout):
    expected = feature_store(totals.monthly_totals(spark, layout), now=NOW).drop("created_at")
    found = numbered_features(spark, layout).drop("created_at")
    assert found.columns == expected.columns and ordered(found) == ordered(expected)


def files_of(layout):
    return {f: os.stat(f).st_mtime_ns for top, _, names in os.walk(layout.feature_rows) for n in names if n.endswith(".parquet") for f in [f"{top}/{n}"]}


BRANDS = [(f"B{k}", "CA") for k in range(12)] + [("NULL", "CA"), ("B1", "NULL")]


def test_only_touched_series_are_built(spark, box, monkeypatch):
    layout = Layout(str(box / "out"))
    put(box, "a.csv", BRANDS)
    load(spark, box, "one")
    assert len(refresh(spark, layout, NOW)) > 5
    check(spark, layout)
    before = files_of(layout)
    built = []
    plain = feature_table.feature_rows
    monkeypatch.setattr(feature_table, "feature_rows", lambda t, **k: built.append(sorted({tuple(r) for r in t.select("brand", "state").collect()}, key=str)) or plain(t, **k))
    put(box, "b.csv", [("B3", "CA"), ("NULL", "CA")], years=(24,))
    load(spark, box, "two")
    later = datetime(2024, 2, 2)
    written = refresh(spark, layout, later)
    assert built == [[("B3", "CA"), (None, "CA")]] and 1 <= len(written) <= 2
    check(spark, layout)
    kept = {f: t for f, t in before.items() if not any(f"bucket={b}/" in f for b in written)}
    assert kept and kept.items() <= files_of(layout).items()
    stamps = {(r.brand, r.state): r.created_at for r in stored_features(spark, layout).collect()}
    assert {k for k, v in stamps.items() if v == later} == {("B3", "CA"), (None, "CA")}
    assert refresh(spark, layout, later) == []
    check(spark, layout)


def test_taken_back_series_leave_the_table(spark, box):
    layout = Layout(str(box / "out"))
    put(box, "a.csv", BRANDS)
    load(spark, box, "one")
    refresh(spark, layout, NOW)
    put(box, "a.csv", BRANDS[:2], minute=1)
    load(spark, box, "two")
    refresh(spark, layout, NOW)
    check(spark, layout)
    assert stored_features(spark, layout).select("brand").distinct().count() == 2
    put(box, "a.csv", [], minute=2)
    load(spark, box, "three")
    refresh(spark, layout, NOW)
    assert stored_features(spark, layout).count() == 0 and numbered_features(spark, layout).count() == 0


def test_merged_parts(spark, box):
    layout = Layout(str(box / "out"))
    put(box, "a.csv", BRANDS)
    load(spark, box, "one")
    refresh(spark, layout, NOW)
    totals.merge_parts(spark, layout, 0)
    put(box, "b.csv", [("B3", "CA")], years=(24,))
    load(spark, box, "two")
    assert len(refresh(spark, layout, NOW)) == 1
    check(spark, layout)
    put(box, "c.csv", [("B4", "CA")], years=(24,))
    load(spark, box, "three")
    totals.merge_parts(spark, layout, 0)  # before its series are known: all are built
    assert len(refresh(spark, layout, NOW)) > 5
    check(spark, layout)


def test_a_refresh_that_fails_leaves_the_table(spark, box, monkeypatch):
    layout = Layout(str(box / "out"))
    put(box, "a.csv", BRANDS)
    load(spark, box, "one")
    refresh(spark, layout, NOW)
    before = ordered(stored_features(spark, layout))
    put(box, "b.csv", [("B3", "CA")], years=(24,))
    load(spark, box, "two")
    monkeypatch.setattr(feature_table, "replace_table", lambda *args: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        refresh(spark, layout, NOW)
    monkeypatch.undo()
    assert ordered(stored_features(spark, layout)) == before
    refresh(spark, layout, NOW)
    check(spark, layout)


def test_three_batches_of_the_sample_tables(spark, box):
    layout = Layout(str(box / "out"))
    rows = src.keyed_raw_sales(spark, SMALL).withColumn("lot", F.col("k") % 4)
    for lots in ([0, 1], [2], [3]):
        src.append_sales_files(rows.filter(F.col("lot").isin(lots)), str(box / "in"))
        load(spark, box, f"lots {lots}")
        refresh(spark, layout, NOW)
    check(spark, layout)


def test_running_total(spark):
    df = spark.range(1000).selectExpr("if(id = 7, null, id) id", "id % 5 n")
    rows = running_total(df, ["id"], "n", "before").collect()
    expected, total = {}, 0
    for key in [*[k for k in range(1000) if k != 7], 7]:
        expected[None if key == 7 else key] = total
        total += key % 5
    assert {r.id: r.before for r in rows} == expected


def test_series_that_stay_as_they_are_keep_their_models(spark, box):
    out, layout = str(box / "out"), Layout(str(box / "out"))
    put(box, "a.csv", BRANDS[:3], years=(21, 22, 23))
    put(box, "short.csv", [("S", "CA")])
    load(spark, box, "one")
    train.run_pipeline(spark, out, NOW, "one", by=["brand", "state"])
    first = {r.model_name: r.model_version for r in train.stored_registry(spark, layout).collect()}
    assert len(first) == 3
    left_out = train.untrained_series(spark, layout).collect()
    assert [(r.n, r.batch) for r in left_out] == [(6, "one")] and '"brand":"S"' in left_out[0].series
    put(box, "b.csv", [("B1", "CA")], years=(24,), amount=3)
    load(spark, box, "two")
    for _ in range(2):  # a repeated run fits the same series again
        train.run_pipeline(spark, out, NOW + timedelta(days=1), "two", by=["brand", "state"])
        trained = read_log(spark, layout.trained_series, schemas.TRAINED_SERIES).filter("batch = 'two'").collect()
        assert len(trained) == 1 and "B1" in trained[0].model_name
    models = train.stored_registry(spark, layout).collect()
    assert len(models) == 4 and {r.model_name: r.model_version for r in models if "B1" not in r.model_name} == {k: v for k, v in first.items() if "B1" not in k}
    train.run_pipeline(spark, out, NOW + timedelta(days=2), "three", by=["brand", "state"])
    assert train.stored_registry(spark, layout).count() == 4
    full = Layout(str(box / "full"))
    validate_and_load(spark, str(box / "in"), full.root, "all", NOW)
    train.run_pipeline(spark, full.root, NOW, "all", by=["brand", "state"])
    whole = {r.model_name: (r.training_records, round(r.mae, 6)) for r in train.stored_registry(spark, full).collect()}
    newest = {}
    for r in sorted(models, key=lambda r: r.model_id):
        newest[r.model_name] = (r.training_records, round(r.mae, 6))
    assert newest == whole


def test_series_of_the_piecewise_form_are_told_apart(spark, box):
    out, layout = str(box / "out"), Layout(str(box / "out"))
    put(box, "a.csv", BRANDS[:1], years=(21, 22, 23))
    load(spark, box, "one")
    for k, form in enumerate([train.TREND_SEASONAL, train.PIECEWISE, train.PIECEWISE]):
        train.run_pipeline(spark, out, NOW + timedelta(days=k), f"run {k}", by=["brand", "state"], model=form)
    assert sorted(r.model_type for r in train.stored_registry(spark, layout).collect()) == ["PIECEWISE", "TREND_SEASONAL"]
