"""Incremental ingest: each file once, replays without doubles, work only for new rows."""

from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from conftest import SMALL, ordered, rows_of
from monthline import schemas
from monthline.operators.features import agg_sales, clean_sales
from monthline.parity import inputs as src
from monthline.plans import train
from monthline.plans.layout import Layout
from monthline.plans.load import raw_sales, rejected_lines, validate_and_load
from monthline.sources.file_list import list_files
from monthline.sources.tables import read_log, read_table
from monthline.streaming.ingest import batch_handler, run_stream

HEADER = "group,description,state,location,month,fy,sales\n"


class Clock:
    """A time that moves one day with every batch."""

    def __init__(self):
        self.now = datetime(2024, 1, 1)

    def __call__(self):
        self.now += timedelta(days=1)
        return self.now


@pytest.fixture
def box(tmp_path):
    (tmp_path / "in").mkdir()
    return tmp_path


def put(box, name, *lines):
    (box / "in" / name).write_text(HEADER + "".join(line + "\n" for line in lines))


def run(spark, box, **options):
    options.setdefault("clock", Clock())
    options.setdefault("train", False)
    options.setdefault("name", "stream")
    run_stream(spark, str(box / "in"), str(box / "out"), str(box / "offsets"), **options)
    return Layout(str(box / "out"))


def test_each_file_once_and_rejects_kept(spark, box):
    put(box, "a.csv", "B,P,S,L,Apr-23,23-24,1", "short,line")
    layout = run(spark, box)
    put(box, "b.csv", 'B,P,S,L,Apr-23,23-24,"2,000.5"')
    run(spark, box)
    run(spark, box)
    assert ordered(raw_sales(spark, layout), "source_file", "net_sales") == [("a.csv", "1"), ("b.csv", "2,000.5")]
    assert rows_of(rejected_lines(spark, layout), "rejected_line") == [("short,line",)]
    assert ordered(train.monthly_totals(spark, layout), "period", "transaction_count") == [("2023-04", 2)]
    assert ordered(read_table(spark, layout.trigger_log), "new_rows", "trigger_type") == [
        (1, "NEW_FILES"),
        (1, "NEW_FILES"),
    ]


def test_no_loaded_rows_no_trigger(spark, box):
    put(box, "a.csv", "short,line")
    layout = run(spark, box)
    assert read_log(spark, layout.trigger_log, schemas.TRIGGER_LOG).count() == 0
    assert raw_sales(spark, layout).count() == 0
    assert rejected_lines(spark, layout).count() == 1


def test_one_batch_per_file_when_limited(spark, box):
    for name in ("a.csv", "b.csv", "c.csv"):
        put(box, name, "B,P,S,L,Apr-23,23-24,1")
    layout = run(spark, box, max_files=1)
    assert read_table(spark, layout.trigger_log).count() == 3
    assert raw_sales(spark, layout).count() == 3


def test_failed_batch_is_replayed_without_doubles(spark, box, monkeypatch):
    put(box, "a.csv", "B,P,S,L,Apr-23,23-24,1")
    calls = []

    def failing(*args, **kwargs):
        calls.append(1)
        raise RuntimeError("lost")

    monkeypatch.setattr("monthline.streaming.ingest.aggregate_pending", failing)
    with pytest.raises(Exception, match="lost"):
        run(spark, box)
    monkeypatch.undo()
    assert calls
    layout = run(spark, box)
    assert raw_sales(spark, layout).count() == 1
    assert read_table(spark, layout.trigger_log).count() == 1
    assert rows_of(train.monthly_totals(spark, layout), "transaction_count") == [(1,)]


def test_two_triggers_train_compare_and_check_drift(spark, box):
    """The second run compares with the first one's model and drift baseline."""
    rows = src.keyed_raw_sales(spark, SMALL).selectExpr("*", "k % 4 lot")
    clock = Clock()
    src.append_sales_files(rows.filter("lot < 2"), str(box / "in"))
    layout = run(spark, box, clock=clock, train=True)
    src.append_sales_files(rows.filter("lot >= 2"), str(box / "in"))
    run(spark, box, clock=clock, train=True)

    expected = agg_sales(clean_sales(src.raw_sales(spark, SMALL)))
    assert ordered(train.monthly_totals(spark, layout)) == ordered(expected)

    models = ordered(train.stored_registry(spark, layout), "model_id", "status")
    assert [m for m, _ in models] == [1, 2]
    assert sorted(s for _, s in models) in (["ARCHIVED", "PRODUCTION"],)
    decisions = ordered(
        read_log(spark, layout.comparison_log, schemas.MODEL_COMPARISON_LOG), "comparison_id", "production_model_version", "candidate_model_version"
    )
    assert decisions == [(1, None, "v20240102_000000"), (2, "v20240102_000000", "v20240103_000000")]
    drift = read_log(spark, layout.drift_metrics, schemas.DRIFT_METRICS)
    assert ordered(drift.groupBy("batch").count()) == [("stream-0", 5), ("stream-1", 1)]
    assert rows_of(drift.orderBy("drift_id"), "drift_id") == [(i,) for i in range(1, 7)]
    runs = read_log(spark, layout.runs, schemas.PIPELINE_RUNS).orderBy("run_id")
    count = train.stored_features(spark, layout).count()
    assert rows_of(runs, "run_id", "phase", "status")[1:] == [(2, "FULL_PIPELINE", "SUCCESS")]
    assert rows_of(runs, "records_processed")[-1] == (count,)
    predictions = read_log(spark, layout.prediction_log, schemas.PREDICTION_LOG)
    assert predictions.select("prediction_id").distinct().count() == predictions.count() > 0


def test_a_repeated_run_replaces_its_own_rows(spark, box):
    src.append_sales_files(src.keyed_raw_sales(spark, SMALL).selectExpr("*", "k % 4 lot"), str(box / "in"))
    layout = run(spark, box, clock=Clock(), train=True)
    tables = {
        layout.model_events: schemas.MODEL_EVENTS,
        layout.comparison_log: schemas.MODEL_COMPARISON_LOG,
        layout.drift_metrics: schemas.DRIFT_METRICS,
        layout.prediction_log: schemas.PREDICTION_LOG,
    }
    first = {path: ordered(read_log(spark, path, schema)) for path, schema in tables.items()}
    train.run_pipeline(spark, layout.root, datetime(2024, 1, 2), "stream-0")
    assert {path: ordered(read_log(spark, path, schema)) for path, schema in tables.items()} == first
    assert read_table(spark, layout.runs).count() == 1


def test_per_series_models_and_health(spark, box):
    src.append_sales_files(src.keyed_raw_sales(spark, SMALL).selectExpr("*", "k % 4 lot"), str(box / "in"))
    layout = run(spark, box)
    now = datetime(2024, 5, 1)
    train.run_pipeline(spark, layout.root, now, "all", by=("brand", "state"))
    models = train.stored_registry(spark, layout)
    count = models.count()
    assert count > 10 and models.filter("status = 'PRODUCTION'").count() == count
    assert models.select("model_name").distinct().count() == count
    health = train.check_health(spark, layout, "h1", now + timedelta(days=100))
    assert health.filter("health_status = 'STALE'").count() == count
    summary = dict(rows_of(train.summary(spark, layout)))
    assert summary["MODELS_TRAINED"] == str(count)
    assert summary["LATEST_DRIFT_STATUS"] == "BASELINE"


def test_too_few_features_train_nothing(spark, box):
    put(box, "a.csv", "B,P,S,L,Apr-23,23-24,1")
    layout = run(spark, box, train=True)
    assert train.stored_registry(spark, layout).count() == 0
    assert rows_of(read_table(spark, layout.runs), "status", "records_processed") == [("SUCCESS", 0)]


def test_a_failing_step_is_logged(spark, box, monkeypatch):
    put(box, "a.csv", "B,P,S,L,Apr-23,23-24,1")
    layout = run(spark, box)

    def failing(*args, **kwargs):
        raise RuntimeError("no drift today")

    monkeypatch.setattr(train, "check_drift", failing)
    with pytest.raises(RuntimeError):
        train.run_pipeline(spark, layout.root, datetime(2024, 1, 1), "r")
    assert rows_of(read_table(spark, layout.runs), "status", "error_message") == [("FAILED", "no drift today")]


def test_handler_is_reusable(spark, box):
    handle = batch_handler(str(box / "out"), Clock(), train=False, name="s")
    for name in ("f.csv", "g.csv"):
        put(box, name, "B,P,S,L,Apr-23,23-24,1")
    files = [list_files(spark, str(box / "in" / name)) for name in ("f.csv", "g.csv")]
    for batch in (0, 0, 1):
        handle(files[batch], batch)
    handle(files[0], 2)
    layout = Layout(str(box / "out"))
    assert ordered(raw_sales(spark, layout), "source_file") == [("f.csv",), ("g.csv",)]
    with pytest.raises(ValueError, match="other files"):
        handle(files[1], 0)
    with pytest.raises(ValueError, match="needs a name"):
        batch_handler(str(box / "out"), Clock())(files[0], 0)


def test_streams_with_offsets_of_their_own_keep_their_rows(spark, box):
    put(box, "a.csv", "B,P,S,L,Apr-23,23-24,1", "B,P,S,L,May-23,23-24,2")
    layout = run(spark, box, name=None)
    (box / "more").mkdir()
    (box / "more" / "b.csv").write_text(HEADER + "B,P,S,L,Apr-23,23-24,3\n")
    run_stream(spark, str(box / "more"), layout.root, str(box / "offsets2"), clock=Clock(), train=False)
    run_stream(spark, str(box / "in"), layout.root, str(box / "offsets3"), clock=Clock(), train=False)
    assert ordered(raw_sales(spark, layout), "net_sales") == [("1",), ("2",), ("3",)]
    assert ordered(train.monthly_totals(spark, layout), "period", "transaction_count") == [("2023-04", 2), ("2023-05", 1)]


def test_a_run_counts_what_was_loaded_by_hand(spark, box):
    rows = src.keyed_raw_sales(spark, SMALL).selectExpr("*", "k % 4 lot")
    src.append_sales_files(rows, str(box / "in"))
    out = str(box / "out")
    validate_and_load(spark, str(box / "in"), out, "one", datetime(2024, 1, 1))
    run = train.run_pipeline(spark, out, datetime(2024, 1, 1), "r").first()
    assert (run.status, run.records_processed) == ("SUCCESS", train.stored_features(spark, Layout(out)).count())
    expected = agg_sales(clean_sales(src.raw_sales(spark, SMALL)))
    assert ordered(train.monthly_totals(spark, Layout(out))) == ordered(expected)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        train.run_pipeline(spark, str(box / "nowhere"), datetime(2024, 1, 1), "r")


def test_piecewise_models_are_trained_and_new_series_get_a_baseline(spark, box):
    rows = src.keyed_raw_sales(spark, SMALL).selectExpr("*", "k % 4 lot")
    late = "material_group in ('brand#11', 'brand#12')"
    src.append_sales_files(rows.filter(f"not coalesce({late}, false)"), str(box / "in"))
    out, clock = str(box / "out"), Clock()
    for batch in ("one", "two"):
        validate_and_load(spark, str(box / "in"), out, batch, clock.now)
        train.run_pipeline(spark, out, clock(), batch, model=train.PIECEWISE)
        src.append_sales_files(rows.filter(late), str(box / "in"))
    layout = Layout(out)
    models = train.stored_registry(spark, layout)
    assert rows_of(models.select("model_name", "model_type").distinct()) == [("SALES_PIECEWISE", "PIECEWISE")]
    drift = read_log(spark, layout.series_drift, schemas.SERIES_DRIFT)
    second = drift.filter("batch = 'two'").groupBy(F.expr("drift_status = 'BASELINE'"), F.expr("brand in ('BRAND#11', 'BRAND#12')")).count()
    assert {tuple(r)[:2] for r in second.collect() if r[1] is not None} == {(True, True), (False, False)}
    assert drift.select("drift_id").distinct().count() == drift.count()
