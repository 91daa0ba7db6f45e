from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from tidegauge.operators import learn

COLUMNS = ["tide", "wind", "rain"]
TARGET = COLUMNS[0]


@pytest.fixture(scope="module")
def frame(spark):
    """Six days every ten minutes: a half-day tide that the wind lifts, and rain without any meaning."""
    t = F.col("id") * 600_000
    turn = 2 * math.pi * F.col("id") / 72
    wind = 3 + F.pmod(F.hash("id"), F.lit(100)) / 50
    df = spark.range(6 * 144).select(
        (F.lit(1_704_067_200_000) + t).alias("timestamp"),
        (10 + 4 * F.sin(turn) + wind).alias("tide"),
        wind.alias("wind"),
        (F.pmod(F.hash("id", F.lit(1)), F.lit(7)) / 7).alias("rain"),
    )
    return df.repartition(2).cache()


def test_models_beat_the_mean(spark, frame):
    spread = frame.agg(F.stddev_pop(TARGET)).first()[0]
    _, forest = learn.train_forest(frame, TARGET, n_trees=10, max_depth=5)
    _, boosted = learn.train_boosted(frame, TARGET, n_trees=15, max_depth=3)
    model, seasonal = learn.train_seasonal(frame, TARGET, COLUMNS)
    table = {r["model"]: r for r in learn.evaluation_table([forest, boosted, seasonal]).collect()}
    assert list(table) == ["random_forest", "boosted_trees", "seasonal_regression"]
    assert table["random_forest"]["features_number"] == 3
    for row in table.values():
        assert 0 < row["mae"] <= row["rmse"] < 2 * spread and row["mape"] > 0
    assert table["seasonal_regression"]["rmse"] < spread


def test_rows_without_numbers_are_left_out(spark, frame):
    holes = frame.withColumn("wind", F.when(F.col("timestamp") % 1_800_000 == 0, float("inf")).otherwise(F.col("wind")))
    assert learn._usable(holes, COLUMNS[1:], TARGET).count() < frame.count()
    _, score = learn.train_seasonal(holes, TARGET, COLUMNS)
    assert score.count() == 1
    with pytest.raises(ValueError, match="no row with finite numbers"):
        learn.train_seasonal(frame.withColumn(TARGET, F.lit(float("nan"))), TARGET, COLUMNS)


def test_sequence_tables(spark, frame):
    tables, x_scale, y_scale = learn.prepare_sequences(frame, TARGET, length=24)
    n = frame.count()
    sizes = {name: df.count() for name, df in tables.items()}
    assert sizes == {"train": int(n * 0.7) - 24, "val": int(n * 0.85) - int(n * 0.7) - 24, "test": n - int(n * 0.85) - 24}
    row = tables["test"].first()
    assert len(row["x"]) == 24 and len(row["x"][0]) == 3
    limits = tables["test"].select(F.explode(F.flatten("x")).alias("v")).agg(F.min("v"), F.max("v")).first()
    assert -20.0 <= limits[0] and limits[1] <= 20.0
    assert set(x_scale.mean) == {"timestamp", "wind", "rain"} and set(y_scale.mean) == {TARGET}
    with pytest.raises(ValueError, match="Not enough rows"):
        learn.prepare_sequences(frame, TARGET, length=600)
