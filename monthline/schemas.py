"""Column layouts of all tables the jobs read and write."""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in columns.items()])


_text = T.StringType()
_whole = T.LongType()
_int = T.IntegerType()
_real = T.DoubleType()
_moment = T.TimestampNTZType()

AMOUNT = T.DecimalType(15, 2)

# The seven positional fields of a sales file, in file order.
SALES_FILE = _struct(
    material_group=_text,
    material_description=_text,
    sold_state=_text,
    supply_location=_text,
    month=_text,
    fy=_text,
    net_sales=_text,
)

RAW_SALES = T.StructType(
    SALES_FILE.fields
    + [T.StructField("source_file", _text), T.StructField("load_ts", _moment)]
)

VALIDATION_LOG = _struct(
    log_id=_whole,
    batch_id=_text,
    validation_time=_moment,
    total_records=_whole,
    valid_records=_whole,
    invalid_records=_whole,
    validation_status=_text,
    error_details=T.VariantType(),
)

VALIDATION_RULES = _struct(
    rule_id=_whole,
    rule_name=_text,
    rule_type=_text,
    column_name=_text,
    rule_definition=_text,
    is_active=T.BooleanType(),
)

CLEAN_SALES = _struct(
    brand=_text,
    product=_text,
    state=_text,
    location=_text,
    month_num=_int,
    year=_int,
    net_sales=AMOUNT,
    period=_text,
    source_file=_text,
)

AGG_SALES = _struct(
    brand=_text,
    state=_text,
    period=_text,
    total_sales=T.DecimalType(25, 2),
    transaction_count=_whole,
)

FEATURE_STORE = _struct(
    feature_id=_whole,
    brand=_text,
    state=_text,
    period=_text,
    ds=T.DateType(),
    y=_real,
    year=_int,
    month=_int,
    quarter=_int,
    lag_1=_real,
    lag_2=_real,
    lag_3=_real,
    rolling_avg_3=_real,
    created_at=_moment,
)

MODEL_REGISTRY = _struct(
    model_id=_whole,
    model_name=_text,
    model_version=_text,
    model_type=_text,
    training_date=_moment,
    training_records=_whole,
    mae=_real,
    rmse=_real,
    mape=_real,
    status=_text,
    promoted_date=_moment,
    notes=_text,
)

# The registry on disk: one row per status change, newest event wins.
MODEL_EVENTS = T.StructType(
    MODEL_REGISTRY.fields
    + [T.StructField("event_time", _moment), T.StructField("event_step", _int)]
)

MODEL_COMPARISON_LOG = _struct(
    comparison_id=_whole,
    comparison_date=_moment,
    model_name=_text,
    production_model_version=_text,
    candidate_model_version=_text,
    production_mae=_real,
    candidate_mae=_real,
    improvement_percent=_real,
    decision=_text,
    decision_reason=_text,
)

PREDICTION_LOG = _struct(
    prediction_id=_whole,
    model_version=_text,
    prediction_time=_moment,
    brand=_text,
    state=_text,
    period=_text,
    predicted_value=_real,
    actual_value=_real,
    error=_real,
)

DRIFT_METRICS = _struct(
    drift_id=_whole,
    check_date=_moment,
    metric_name=_text,
    baseline_value=_real,
    current_value=_real,
    drift_score=_real,
    drift_status=_text,
)

#: The same per series.
SERIES_DRIFT = T.StructType([T.StructField("brand", _text), T.StructField("state", _text), *DRIFT_METRICS.fields])

PIPELINE_RUNS = _struct(
    run_id=_whole,
    run_time=_moment,
    phase=_text,
    status=_text,
    records_processed=_whole,
    duration_seconds=_int,
    error_message=_text,
)

TRIGGER_LOG = _struct(run_time=_moment, new_rows=_whole, trigger_type=_text)

TRAINED_SERIES = _struct(model_name=_text, n=_whole, fingerprint=_text, trained=_moment)

UNTRAINED_SERIES = _struct(model_name=_text, series=_text, n=_whole, reason=_text)

#: Sketches of each series, and how far they are from its first one.
SERIES_DISTRIBUTION = _struct(
    brand=_text, state=_text, check_date=_moment, n=_whole, sketch=T.BinaryType(), distance=_real, drift_score=_real, drift_status=_text
)
