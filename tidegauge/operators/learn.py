"""Forecast models on MLlib and their evaluation table."""

from __future__ import annotations

import math

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.functions.numbers import is_finite
from tidegauge.operators import boosting, trend
from tidegauge.operators.aggregates import error_measures
from tidegauge.operators.clean import finite_rows
from tidegauge.operators.ordering import sequence_blocks, sequences, split_by_time, with_row_index
from tidegauge.operators.standardize import (
    Scale,
    apply_scale,
    clip_columns,
    fit_scale,
    fit_target,
)

PREDICTION = "prediction"


def feature_columns(df: DataFrame, target: str) -> list[str]:
    """Every column but the target, the timestamp included."""
    return [c for c in df.columns if c != target]


def _usable(df: DataFrame, features: list[str], target: str) -> DataFrame:
    """Rows with finite numbers everywhere, as doubles."""
    numbers = df.select(*[F.col(c).cast("double").alias(c) for c in [*features, target]])
    return finite_rows(numbers, [*features, target])


# Stands for a missing feature; far below all values, so that one split of a tree sets such rows apart.
MISSING = -1e30


def _for_trees(df: DataFrame, features: list[str], target: str) -> DataFrame:
    """Rows with a finite target, as doubles; missing and non-finite features become :data:`MISSING`.

    Warm-up rows, whose long lags are NULL, stay in.
    """
    numbers = df.select(*[F.col(c).cast("double").alias(c) for c in [*features, target]])
    filled = {c: F.when(is_finite(F.col(c)), F.col(c)).otherwise(F.lit(MISSING)) for c in features}
    return finite_rows(numbers, [target]).withColumns(filled)


def _assembler(features: list[str]) -> VectorAssembler:
    return VectorAssembler(inputCols=features, outputCol="features", handleInvalid="error")


def _score(name: str, model, train: DataFrame, df: DataFrame, features: list[str], target: str) -> DataFrame:
    """Errors on ``df``, with the rows that were trained on and measured, both counted."""
    scored = model.transform(df)
    measures = error_measures(F.col(target), F.col(PREDICTION))
    counted = scored.agg(F.count(PREDICTION).alias("rows_measured"), *[c.alias(n) for n, c in measures.items()])
    return counted.select(
        F.lit(name).alias("model"),
        F.lit(len(features)).alias("features_number"),
        F.lit(train.count()).cast("long").alias("rows_train"),
        "rows_measured",
        *measures,
    )


def train_forest(
    df: DataFrame,
    target: str,
    n_trees: int = 40,
    max_depth: int = 8,
    min_rows: int = 7,
    seed: int = 42,
    test_size: float = 0.15,
    val_size: float = 0.15,
) -> tuple[PipelineModel, DataFrame]:
    """Random forest on the training part, measured on the validation part."""
    features = feature_columns(df, target)
    train, val, _ = split_by_time(df, test_size, val_size)
    forest = RandomForestRegressor(
        labelCol=target,
        numTrees=n_trees,
        maxDepth=max_depth,
        minInstancesPerNode=max(1, min_rows // 2),
        seed=seed,
    )
    train = _for_trees(train, features, target)
    model = Pipeline(stages=[_assembler(features), forest]).fit(train)
    return model, _score("random_forest", model, train, _for_trees(val, features, target), features, target)


def train_boosted(
    df: DataFrame,
    target: str,
    n_trees: int = 300,
    max_depth: int = 5,
    learning_rate: float = 0.08,
    subsample: float = 0.9,
    colsample: float = 0.9,
    min_child_weight: float = 1.0,
    gamma: float = 0.0,
    alpha: float = 0.0,
    lambda_: float = 1.0,
    patience: int = 50,
    seed: int = 42,
    test_size: float = 0.15,
    val_size: float = 0.15,
) -> tuple[boosting.Booster, DataFrame]:
    """Boosted trees stopped early on the validation part, measured on the test part.

    Rows with missing features are trained on; each split learns where they go.
    """
    features = feature_columns(df, target)
    train, val, test = split_by_time(df, test_size, val_size)
    settings = boosting.Settings(
        n_trees, max_depth, learning_rate, subsample, colsample, min_child_weight, gamma, alpha, lambda_, patience, seed
    )
    model = boosting.fit(train, val, features, target, settings)
    train, test = (
        finite_rows(part.select(*[F.col(c).cast("double").alias(c) for c in [*features, target]]), [target])
        for part in (train, test)
    )
    return model, _score("boosted_trees", model, train, test, features, target)


def seasonal_regressors(
    df: DataFrame, daily_order: int = 4, weekly_order: int = 3, ts: str = "timestamp"
) -> tuple[DataFrame, list[str]]:
    """Trend and Fourier columns of a daily and a weekly period."""
    day_ms, week_ms = 86_400_000, 7 * 86_400_000
    # Fixed value: 2024-01-01 00:00 UTC, a Monday, keeps the trend column small.
    origin = 1_704_067_200_000
    columns = {"trend": (F.col(ts) - F.lit(origin)) / F.lit(float(day_ms))}
    for label, period, order in (("day", day_ms, daily_order), ("week", week_ms, weekly_order)):
        phase = F.pmod(F.col(ts) - F.lit(origin), F.lit(period)) / F.lit(float(period))
        for k in range(1, order + 1):
            columns[f"{label}_sin_{k}"] = F.sin(F.lit(2 * math.pi * k) * phase)
            columns[f"{label}_cos_{k}"] = F.cos(F.lit(2 * math.pi * k) * phase)
    return df.withColumns(columns), list(columns)


def train_seasonal(
    df: DataFrame,
    target: str,
    regressors: list[str],
    test_size: float = 0.15,
    val_size: float = 0.15,
    ridge: float = 1e-3,
) -> tuple[PipelineModel, DataFrame]:
    """Trend, daily and weekly terms and extra regressors in a linear model.

    Rows with a non-finite number are dropped; measured on the validation part.
    """
    columns = [c for c in regressors if c in df.columns and c != target]
    framed, terms = seasonal_regressors(df.select("timestamp", target, *columns))
    features = [*terms, *columns]
    train, val, _ = split_by_time(framed, test_size, val_size)
    train, val = _usable(train, features, target), _usable(val, features, target)
    if train.isEmpty() or val.isEmpty():
        raise ValueError("no row with finite numbers is left to train or measure on")
    linear = LinearRegression(labelCol=target, regParam=ridge, elasticNetParam=0.0)
    model = Pipeline(stages=[_assembler(features), linear]).fit(train)
    return model, _score("seasonal_regression", model, train, val, features, target)


def train_trend(
    df: DataFrame,
    target: str,
    regressors: list[str],
    settings: trend.TrendSettings | None = None,
    test_size: float = 0.15,
    val_size: float = 0.15,
) -> tuple[trend.Trend, DataFrame]:
    """Trend with changepoints, waves and extra regressors, measured on the validation part."""
    columns = [c for c in regressors if c in df.columns and c != target]
    train, val, _ = split_by_time(df.select("timestamp", target, *columns), test_size, val_size)
    train, val = (_usable(part, ["timestamp", *columns], target) for part in (train, val))
    model = trend.fit_trend(train, target, columns, settings)
    features = ["timestamp", *columns]
    return model, _score("changepoint_trend", model, train, val, features, target)


def evaluation_table(scores: list[DataFrame]) -> DataFrame:
    """One row per model: feature count, rows trained on and measured, MAE, RMSE, MAPE."""
    table = scores[0]
    for score in scores[1:]:
        table = table.unionByName(score)
    return table


def prepare_sequences(
    df: DataFrame,
    target: str,
    length: int = 1440,
    test_size: float = 0.15,
    val_size: float = 0.15,
    blocks: bool = False,
    short: str = "fail",
) -> tuple[dict[str, DataFrame], Scale, Scale]:
    """Training tables of a sequence model, per part.

    Finite rows only; features standardised with the training part and clipped to [-20, 20];
    target standardised with the training part; then sequences of ``length`` rows, or with ``blocks`` the
    rows in blocks that a reader slices (see :func:`sequence_blocks`). A part that is too short for a
    sequence stops with an error, or gives an empty table if ``short`` is ``empty``.
    """
    features = feature_columns(df, target)
    names = ("train", "val", "test")
    parts = dict(zip(names, split_by_time(df, test_size, val_size)))
    order = "_order"
    usable = {
        name: _usable(
            part.withColumn(order, F.col("timestamp")), [*features, order], target
        )
        for name, part in parts.items()
    }
    x_scale = fit_scale(usable["train"], features)
    y_scale = fit_target(usable["train"], target)
    tables = {}
    for name, part in usable.items():
        scaled = apply_scale(apply_scale(part, x_scale), y_scale)
        indexed = with_row_index(clip_columns(scaled, features), (order,))
        if short != "empty" and indexed.count() <= length:
            raise ValueError(f"Not enough rows in the {name} part for sequences of {length}.")
        tables[name] = (sequence_blocks if blocks else sequences)(indexed, features, target, length)
    return tables, x_scale, y_scale
