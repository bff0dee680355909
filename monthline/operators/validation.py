"""Row flags, batch summary, rule table and quarantine."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, functions as F, types as T

from monthline.functions import fixed
from monthline.functions.dates import moment
from monthline.functions.numbers import to_amount
from monthline.functions.text import is_fiscal_year_text, is_month_text, is_number_text

def flag_rows(raw: DataFrame) -> DataFrame:
    """Add one flag per check and ``is_valid``.

    NULLs in required columns are flagged but make a row invalid only through
    the format checks.
    """
    flagged = raw.withColumns(
        {
            **{f"null_{name}": F.col(name).isNull() for name in fixed.REQUIRED_COLUMNS},
            "bad_net_sales": ~is_number_text(F.col("net_sales")),
            "bad_month": ~is_month_text(F.col("month")),
            "bad_fy": ~is_fiscal_year_text(F.col("fy")),
        }
    )
    return flagged.withColumn("is_valid", ~(F.col("bad_net_sales") | F.col("bad_month") | F.col("bad_fy")))


def _findings() -> dict[str, tuple[Column, Column, str]]:
    """Counter name -> (row flag, message head, message tail), in report order."""
    found = {
        f"n_null_{name}": (F.col(f"null_{name}"), F.lit(f"{name.upper()} has "), " null values")
        for name in fixed.REQUIRED_COLUMNS
    }
    found["n_bad_net_sales"] = (F.col("bad_net_sales"), F.lit("NET_SALES: "), " non-numeric values")
    found["n_bad_month"] = (F.col("bad_month"), F.lit("MONTH: "), " invalid format")
    found["n_bad_fy"] = (F.col("bad_fy"), F.lit("FY: "), " invalid format")
    return found


def check_counts(raw: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Rows, valid rows and failures per check, in one pass."""
    counters = [F.count_if(flag).alias(name) for name, (flag, _, _) in _findings().items()]
    return (
        flag_rows(raw)
        .groupBy(*by)
        .agg(
            F.count(F.lit(1)).alias("total_records"),
            F.count_if("is_valid").alias("valid_records"),
            *counters,
        )
    )


def error_percent(invalid: Column, total: Column) -> Column:
    """Share of invalid rows in percent; 0 for an empty batch."""
    return F.coalesce(F.try_divide(invalid.cast("double"), total.cast("double")), F.lit(0.0)) * 100


def status_for(percent: Column, limit: float = fixed.MAX_ERROR_PERCENT) -> Column:
    return F.when(percent <= limit, F.lit("PASSED")).otherwise(F.lit("FAILED"))


def total_counts(counts: DataFrame) -> DataFrame:
    """Counts of several groups summed up; all zero when there are none."""
    counters = ["total_records", "valid_records", *_findings()]
    return counts.agg(*[F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in counters])


def summarise(
    counts: DataFrame,
    batch_id: str,
    keys: Sequence[str] = (),
    max_error_pct: float = fixed.MAX_ERROR_PERCENT,
    now: datetime | None = None,
) -> DataFrame:
    """Counts to error rate, status and messages."""
    messages = F.array(
        *[
            F.when(F.col(name) > 0, F.concat(head, F.col(name).cast("string"), F.lit(tail)))
            for name, (_, head, tail) in _findings().items()
        ]
    )
    return (
        counts.withColumn("invalid_records", F.col("total_records") - F.col("valid_records"))
        .withColumn("error_rate", error_percent(F.col("invalid_records"), F.col("total_records")))
        .select(
            *keys,
            F.lit(batch_id).alias("batch_id"),
            moment(now).alias("validation_time"),
            "total_records",
            "valid_records",
            "invalid_records",
            "error_rate",
            status_for(F.col("error_rate"), max_error_pct).alias("validation_status"),
            F.array_compact(messages).alias("error_details"),
        )
    )


def validate(
    raw: DataFrame,
    batch_id: str,
    by: str | Sequence[str] | None = None,
    max_error_pct: float = fixed.MAX_ERROR_PERCENT,
    now: datetime | None = None,
) -> DataFrame:
    """One summary row for the batch, or one per value of ``by``."""
    keys = [by] if isinstance(by, str) else list(by or ())
    return summarise(check_counts(raw, keys), batch_id, keys, max_error_pct, now)


def validation_log_rows(summary: DataFrame) -> DataFrame:
    """Summary rows in the layout of the validation log; messages become a JSON value."""
    return summary.select(
        "batch_id",
        "validation_time",
        "total_records",
        "valid_records",
        "invalid_records",
        "validation_status",
        F.parse_json(F.to_json("error_details")).alias("error_details"),
    )


def _kinds() -> dict[str, Callable[[Column], Column]]:
    """Kind of check -> predicate of a column that is true where the check fails."""
    return {
        "null": lambda col: col.isNull(),
        "number": lambda col: ~is_number_text(col),
        "month": lambda col: ~is_month_text(col),
        "fiscal_year": lambda col: ~is_fiscal_year_text(col),
        "positive": lambda col: ~F.coalesce(to_amount(col) > 0, F.lit(False)),
        "present": lambda col: F.lit(False),
    }


def _kind_of(rule_type: Column, definition: Column) -> Column:
    """The kind of check a rule asks for; NULL for an unknown rule."""
    formats = F.lit(None)
    for text, kind in fixed.FORMAT_DEFINITIONS.items():
        formats = F.when(definition == text, F.lit(kind)).otherwise(formats)
    return (
        F.when(rule_type == "SCHEMA", F.when(F.contains(definition, F.lit("not be null")), F.lit("null")).otherwise(F.lit("present")))
        .when(rule_type == "NULL_CHECK", F.lit("null"))
        .when((rule_type == "FORMAT") & formats.isNotNull(), formats)
        .when((rule_type == "RANGE") & F.contains(definition, F.lit("positive")), F.lit("positive"))
    )


def rule_kind(rule_type: Column, definition: Column) -> Column:
    """The kind of check a rule asks for; an unknown rule stops the job with its text."""
    unknown = F.raise_error(F.concat_ws(" ", F.lit("unknown rule:"), rule_type, definition))
    return F.coalesce(_kind_of(rule_type, definition), unknown)


def failing(col: Column, kind: str) -> Column:
    """Row predicate that is true where a check of this kind fails."""
    return _kinds()[kind](col)


def _text_columns(raw: DataFrame) -> dict[str, Column]:
    """The columns as text, by their names in small letters."""
    return {name.lower(): F.col(f"`{name}`").cast("string") for name in raw.columns}


#: Predicates that are counted in one aggregate; more of them take another scan.
CHECKS_PER_SCAN = 200


def _count_checks(raw: DataFrame, checks: Sequence[tuple], failing_rows: Sequence[Column]) -> DataFrame:
    """(_check, _failing) by the place in ``checks`` of each predicate, and the number of all rows under -1."""
    counted = None
    for begin in range(0, max(1, len(checks)), CHECKS_PER_SCAN):
        part = failing_rows[begin : begin + CHECKS_PER_SCAN]
        sums = raw.agg(F.count(F.lit(1)).alias("_all"), *[F.count_if(column).alias(f"_c{k}") for k, column in enumerate(part)])
        cells = [F.struct(F.lit(begin + k).alias("_check"), F.col(f"_c{k}").alias("_failing")) for k in range(len(part))]
        cells += [F.struct(F.lit(-1).alias("_check"), F.col("_all").alias("_failing"))] * (begin == 0)
        rows = sums.select(F.inline(F.array(*cells)))
        counted = rows if counted is None else counted.unionByName(rows)
    return counted


def apply_rules(raw: DataFrame, rules: DataFrame) -> DataFrame:
    """(rule_name, failing_rows) for every active rule, from a single pass over ``raw``.

    Each pair of a column and a kind of check that some rule asks for is counted once,
    however many rules ask for it; there are no more of them than columns times kinds. The
    rules find their counts by a join. A rule on a column that ``raw`` does not have is
    broken by every row. An unknown rule stops the job; ``check_rules`` reports it.
    """
    asked = rules.filter("is_active").select(
        "rule_name", F.lower("column_name").alias("_column"), rule_kind(F.col("rule_type"), F.col("rule_definition")).alias("_kind")
    )
    text = _text_columns(raw)
    # Whether a column is there needs no count.
    pairs = [tuple(r) for r in asked.select("_column", "_kind").distinct().collect() if r["_column"] in text and r["_kind"] != "present"]
    counts = _count_checks(raw, pairs, [failing(text[column], kind) for column, kind in pairs])
    known = [(column, kind, k) for k, (column, kind) in enumerate(pairs)] + [(column, "present", None) for column in text]
    places = raw.sparkSession.createDataFrame([*known, (None, None, -1)], "_column string, _kind string, _check int").withColumn("_known", F.lit(True))
    found = asked.join(places, ["_column", "_kind"], "left")
    # The rows of a column that is not there all fail, those of one that is there do not.
    check = F.when(F.col("_known").isNull(), F.lit(-1)).otherwise(F.col("_check"))
    return found.withColumn("_check", check).join(counts, "_check", "left").select("rule_name", F.coalesce("_failing", F.lit(0)).alias("failing_rows"))


EXPRESSION = "EXPRESSION"


def _predicate(raw: DataFrame, definition: str) -> tuple[Column | None, str | None]:
    """(rows that break an expression, what is wrong with the expression); one of the two."""
    try:
        condition = F.expr(definition)
        kind = raw.select(condition).schema[0].dataType
        if not isinstance(kind, T.BooleanType):
            return None, f"no condition but {kind.simpleString()}: {definition}"
        breaks = ~F.coalesce(condition, F.lit(False))
        raw.agg(F.count_if(breaks))
    except PySparkException as problem:
        return None, f"{problem.getCondition() or type(problem).__name__}: {definition}"
    return breaks, None


def check_rules(raw: DataFrame, rules: DataFrame) -> DataFrame:
    """(rule_name, failing_rows, problem) for every active rule, all counted in one aggregate.

    Besides the known kinds, rules of type EXPRESSION hold a SQL condition over the
    columns, such as comparisons, ranges, lists, patterns or two columns; rows for which it is
    not true fail. A rule that is unknown or no such condition gets a problem in place of a
    count, and the others are counted all the same. Distinct checks go through the
    driver, which builds the columns; a rule table is written by hand.
    """
    kind, unknown = _kind_of(F.col("rule_type"), F.col("rule_definition")), F.concat_ws(" ", F.lit("unknown rule:"), "rule_type", "rule_definition")
    asked = rules.filter("is_active").select(
        "rule_name",
        F.when(F.col("rule_type") == EXPRESSION, F.lit("")).otherwise(F.lower("column_name")).alias("_column"),
        F.when(F.col("rule_type") == EXPRESSION, F.coalesce("rule_definition", F.lit(""))).otherwise(F.coalesce(kind, unknown)).alias("_kind"),
        F.coalesce(F.col("rule_type") == EXPRESSION, F.lit(False)).alias("_is_expression"),
    )
    text, checks, columns, found = _text_columns(raw), [], [], []
    for column, name, is_expression in asked.select("_column", "_kind", "_is_expression").distinct().collect():
        breaks, problem = None, None
        if is_expression:
            breaks, problem = _predicate(raw, name)
        elif name not in _kinds():
            problem = name
        else:
            breaks = failing(text[column], name) if column in text else F.lit(True)
        found.append((column, name, is_expression, None if problem else len(checks), problem))
        if breaks is not None:
            checks.append((column, name))
            columns.append(breaks)
    counts = _count_checks(raw, checks, columns)
    places = raw.sparkSession.createDataFrame(found, "_column string, _kind string, _is_expression boolean, _check int, problem string")
    same = [F.col(f"a.{n}").eqNullSafe(F.col(f"b.{n}")) for n in ("_column", "_kind", "_is_expression")]
    placed = asked.alias("a").join(places.alias("b"), same).select("rule_name", "_check", "problem")
    return placed.join(counts, "_check", "left").select("rule_name", F.col("_failing").alias("failing_rows"), "problem")


def quarantine_sides(raw: DataFrame) -> DataFrame:
    """All rows with their flags and ``side`` (good or bad), for one pass that writes both sides by ``side``."""
    return flag_rows(raw).withColumn("side", F.when(F.col("is_valid"), F.lit("good")).otherwise(F.lit("bad"))).drop("is_valid")


def quarantine(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid rows as they came, invalid rows with their flags); reading both scans ``raw`` twice."""
    flagged = flag_rows(raw)
    good = flagged.filter("is_valid").select(*raw.columns)
    bad = flagged.filter(~F.col("is_valid")).drop("is_valid")
    return good, bad
