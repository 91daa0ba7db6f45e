"""Forecaster with changepoints: normal equations, coordinate descent, planted bends, seasonal modes."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidegauge.operators import learn, trend

DAY = trend.DAY_MS
START = 1_704_067_200_000


def series(spark, value, days=40, step=1_800_000):
    rows = spark.range(days * DAY // step).select((F.lit(START) + F.col("id") * step).alias("timestamp"), (F.pmod(F.hash("id"), F.lit(100)) / 100).alias("noise"))
    day = (F.col("timestamp") - START) / DAY
    return rows.withColumn("y", value(day, F.col("noise"))).repartition(3)


def test_normal_equations(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(500, 4)) * [1, 10, 0.1, 1] + [0, 1e6, 5, -3]
    df = spark.createDataFrame(x.tolist(), "a double, b double, c double, d double").repartition(5)
    n, mean, products = trend.normal_equations(df, [F.col(c) for c in "abcd"])
    assert n == 500 and mean == pytest.approx(x.mean(axis=0))
    assert products == pytest.approx((x - x.mean(axis=0)).T @ (x - x.mean(axis=0)), rel=1e-9)
    assert trend.normal_equations(df.limit(0), [F.col("a")])[0] == 0


def test_descent_meets_the_optimality_conditions():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(300, 8))
    y = x[:, 0] * 3 - x[:, 3] + 0.1 * rng.normal(size=300)
    a, c = x.T @ x / 300, x.T @ y / 300
    sparse, ridge = np.array([0.0] + [0.2] * 7), np.array([0.1] + [0.0] * 7)
    w = trend.descend(a, c, sparse, ridge, 10_000, 1e-12)
    gradient = a @ w - c + ridge * w
    for k in range(8):
        if w[k]:
            assert gradient[k] + sparse[k] * np.sign(w[k]) == pytest.approx(0, abs=1e-8)
        else:
            assert abs(gradient[k]) <= sparse[k] + 1e-8
    assert (w[[1, 2, 4, 5, 6, 7]] == 0).all()


def test_planted_bend_is_found(spark):
    """The slope falls from 2 to -3 a day on day 16, which is a point of the grid."""
    df = series(spark, lambda day, noise: 2 * day - 5 * F.greatest(day - 16, F.lit(0.0)) + 4 * F.sin(2 * np.pi * day) + noise)
    model = trend.fit_trend(df, "y", settings=trend.TrendSettings(changepoints=19))
    near = [change for when, change in model.bends if abs(when - START - 16 * DAY) < 2 * DAY]
    assert sum(near) == pytest.approx(-5, rel=0.1)
    assert sum(abs(change) for when, change in model.bends if abs(when - START - 16 * DAY) >= 2 * DAY) < 0.5
    scored = model.transform(df)
    assert scored.agg(F.avg(F.abs(F.col("prediction") - F.col("y")))).first()[0] < 0.5
    straight = trend.fit_trend(df, "y", settings=trend.TrendSettings(changepoints=0)).transform(df)
    assert straight.agg(F.avg(F.abs(F.col("prediction") - F.col("y")))).first()[0] > 3


def test_seasons_that_grow_with_the_trend(spark):
    df = series(spark, lambda day, noise: F.exp(1 + 0.05 * day) * (1 + 0.5 * F.sin(2 * np.pi * day)))
    error = {}
    for mode in trend.MODES:
        _, score = learn.train_trend(df, "y", [], trend.TrendSettings(mode=mode, daily_order=6))
        row = score.first()
        error[mode] = row["mape"]
        assert row["model"] == "changepoint_trend" and row["rows_train"] == 1344 and row["rows_measured"] == 288
    assert error["multiplicative"] < 0.3 * error["additive"]
    with pytest.raises(ValueError, match="mode"):
        trend.fit_trend(df, "y", settings=trend.TrendSettings(mode="other"))
    with pytest.raises(ValueError, match="no row"):
        trend.fit_trend(df.filter("y < 0"), "y")


def test_regressors_and_rows_without_numbers(spark):
    df = series(spark, lambda day, noise: day + 7 * noise).withColumn("y", F.when(F.col("noise") < 0.9, F.col("y")))
    model = trend.fit_trend(df, "y", ["noise"])
    filled = model.transform(df.filter("y IS NULL"))
    day = (F.col("timestamp") - START) / DAY
    assert filled.agg(F.max(F.abs(F.col("prediction") - day - 7 * F.col("noise")))).first()[0] < 0.1
