"""Aggregates outside the grid: training means, error measures, ensembles, de-duplication."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.functions.anyvalue import kv_map
from tidegauge.functions.numbers import EPSILON, floor_div
from tidegauge.operators.filters import recent_window


def training_aggregate(
    metrics: DataFrame,
    as_of: datetime | None = None,
    days: int = 7,
    bucket_minutes: int | None = 5,
    day: str | None = None,
) -> DataFrame:
    """Mean value by time bucket, name, attributes and resource attributes over recent days.

    ``bucket_minutes=None`` groups by the raw timestamp. ``timestamp`` repeats the bucket in epoch
    milliseconds so that the feature functions can take the result as it is.
    """
    recent = recent_window(metrics, days, as_of, day=day)
    if bucket_minutes is None:
        bucket = F.col("timestamp")
    else:
        width = bucket_minutes * 60_000_000
        bucket = F.timestamp_micros(floor_div(F.unix_micros("timestamp"), width) * F.lit(width))
    rows = recent.select(
        bucket.alias("bucket"),
        "__name__",
        "value",
        kv_map(F.col("attributes")).alias("attributes"),
        kv_map(F.col("resource_attributes")).alias("resource_attributes"),
    )
    return (
        rows.groupBy("bucket", "__name__", "attributes", "resource_attributes")
        .agg(F.avg("value").alias("value"))
        .withColumn("timestamp", F.unix_millis("bucket"))
    )


def error_measures(truth: Column, prediction: Column) -> dict[str, Column]:
    """MAE, RMSE and MAPE as aggregate columns."""
    error = truth - prediction
    return {
        "mae": F.avg(F.abs(error)),
        "rmse": F.sqrt(F.avg(error * error)),
        "mape": F.avg(F.abs(error) / F.greatest(F.abs(truth), F.lit(EPSILON))),
    }


def evaluate(
    df: DataFrame, truth: str, prediction: str, by: tuple[str, ...] = ()
) -> DataFrame:
    """Error measures of the whole frame or per group."""
    measures = error_measures(F.col(truth), F.col(prediction))
    return df.groupBy(*by).agg(*[c.alias(n) for n, c in measures.items()])


def ensemble_mean(df: DataFrame, row: str = "row_id", prediction: str = "prediction") -> DataFrame:
    """Mean prediction per row over all runs."""
    return df.groupBy(row).agg(F.avg(prediction).alias(prediction))


def keep_last_series(
    series: DataFrame, query_id: str = "query_id", kind: str = "kind", ordinal: str = "ordinal"
) -> DataFrame:
    """Per query id only the points of the series listed last; a later kind beats an earlier one.

    The winner table has one row per query id and comes from a partial aggregation. It is joined
    without a hint: the planner broadcasts it while it is small and otherwise shuffles, splitting a
    hot query id at run time.
    """
    winners = series.groupBy(query_id).agg(F.max(F.struct(kind, ordinal)).alias("_last")).select(
        query_id, F.col(f"_last.{kind}").alias(kind), F.col(f"_last.{ordinal}").alias(ordinal)
    )
    return series.join(winners, [query_id, kind, ordinal], "left_semi")


def distinct_names(metrics: DataFrame, name: str = "__name__") -> DataFrame:
    """How many metric names occur. Names are made distinct before they are counted."""
    return metrics.select(name).distinct().agg(F.count(name).alias("n_names"))
