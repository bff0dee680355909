"""Trend with changepoints and yearly Fourier terms, one ridge fit per series.

Model form after Taylor and Letham, "Forecasting at Scale" (2018):
y = trend(t) * (1 + season(t)). Spark distributes the series; a series is at
most a few hundred months and is fitted by one small least-squares solve.
"""

from __future__ import annotations

import sys
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window, functions as F, types as T

from monthline.functions import fixed
from monthline.operators.forecast import time_split, trend_month

# The fit travels with the job, so executors need numpy and pandas but not this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Changepoints are placed in the first part of the train months.
CHANGEPOINT_RANGE = 0.8
# Monthly data cannot tell more than six yearly harmonics apart.
MAX_ORDER = 6
# Trend and season are fitted in turn, each with the other held fixed. Every turn
# lowers the same penalized loss; the rounds end when one lowers it by less than
# this share of the loss without a model.
TOLERANCE = 1e-7


def _ridge(design: np.ndarray, target: np.ndarray, penalties: np.ndarray) -> np.ndarray:
    gram = design.T @ design + np.diag(penalties)
    try:
        return np.linalg.solve(gram, design.T @ target)
    except np.linalg.LinAlgError:
        return np.linalg.lstsq(gram, design.T @ target, rcond=None)[0]


def _trend_design(t: np.ndarray, knots: np.ndarray) -> np.ndarray:
    hinges = np.maximum(t[:, None] - knots[None, :], 0.0)
    return np.column_stack([np.ones_like(t), t, hinges])


def _season_design(month: np.ndarray, order: int) -> np.ndarray:
    angle = 2.0 * np.pi * month[:, None] * np.arange(1, order + 1)[None, :] / 12.0
    return np.column_stack([np.sin(angle), np.cos(angle)])


def _fit_one(pdf: pd.DataFrame, changepoints: int, order: int, ridge: float) -> pd.DataFrame:
    pdf = pdf.sort_values("ds")
    train = pdf["is_train"].to_numpy(bool)
    y = pdf["y"].to_numpy(float)
    month = pdf["t"].to_numpy(float)
    first, span = month[train].min(), max(np.ptp(month[train]), 1.0)
    t = (month - first) / span
    scale = max(np.abs(y[train]).max(), 1e-12)
    count = min(changepoints, max(int(train.sum() * CHANGEPOINT_RANGE) - 1, 0))
    knots = np.linspace(0.0, CHANGEPOINT_RANGE, count + 1)[1:]

    trend_x = _trend_design(t, knots)
    season_x = _season_design(month, order)
    trend_penalty = np.r_[1e-9, 1e-9, np.full(count, ridge)]
    season_penalty = np.full(season_x.shape[1], ridge * 1e-2)
    target = y[train] / scale
    season, loss = np.zeros_like(t), np.inf
    while True:
        weighted = trend_x[train] * (1.0 + season[train])[:, None]
        slopes = _ridge(weighted, target, trend_penalty)
        trend = trend_x @ slopes
        weighted = season_x[train] * trend[train][:, None]
        waves = _ridge(weighted, target - trend[train], season_penalty)
        season = season_x @ waves
        gap = target - trend[train] * (1.0 + season[train])
        before, loss = loss, gap @ gap + trend_penalty @ slopes**2 + season_penalty @ waves**2
        if not before - loss > TOLERANCE * (target @ target):
            break

    return pdf.drop(columns="t").assign(yhat=trend * (1.0 + season) * scale)


def fit_piecewise(
    df: DataFrame,
    keys: Sequence[str],
    changepoints: int = 25,
    fourier_order: int = MAX_ORDER,
    ridge: float = 1.0,
    min_rows: int = fixed.MIN_TRAINING_ROWS,
) -> DataFrame:
    """(keys, ds, y, is_train, yhat): fitted on the train part, forecast for all months.

    A series has at most as many knots as its train months allow. The series are
    few bytes but much arithmetic, so they are dealt out to a fixed number of tasks,
    which adaptive execution does not merge; window and fit both use that one
    shuffle. ``min_rows`` counts all rows of a series.
    """
    if not 0 < fourier_order <= MAX_ORDER:
        raise ValueError(f"fourier_order must be from 1 to {MAX_ORDER}, as months tell no more harmonics apart")
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dated = df.select(*keys, "ds", "y").filter(F.col("ds").isNotNull() & F.col("y").isNotNull())
    split = (
        time_split(dated.repartition(tasks, *keys), keys)
        .filter((F.col("n") >= min_rows) & (F.col("n_train") > 0))
        .select(*keys, "ds", "y", "is_train", trend_month(F.col("ds")).alias("t"))
    )
    schema = T.StructType(
        [field for field in split.schema.fields if field.name != "t"] + [T.StructField("yhat", T.DoubleType())]
    )
    return split.groupBy(*keys).applyInPandas(
        lambda pdf: _fit_one(pdf, changepoints, fourier_order, ridge), schema
    )


def score_piecewise(df: DataFrame, keys: Sequence[str], min_rows: int = fixed.MIN_TRAINING_ROWS) -> DataFrame:
    """The held-out months: (keys, n_train, ds, y, yhat)."""
    found = fit_piecewise(df, keys, min_rows=min_rows)
    n_train = F.count_if("is_train").over(Window.partitionBy(*keys))
    return found.withColumn("n_train", n_train).filter(~F.col("is_train")).select(*keys, "n_train", "ds", "y", "yhat")
