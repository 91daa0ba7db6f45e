"""Many series onto one regular grid.

The defined result is: distinct timestamps of all series, every series left-joined onto them in
turn, then resampled. Duplicate timestamps in one series repeat the rows of the others in those
joins. ``merge_series`` gets the same numbers without joining: each timestamp is folded to one row
with the repeat factor of every series, so no pairs of duplicates are ever produced.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.functions.numbers import AGGREGATES, check_aggregates, floor_to

GRID_MS = 60_000


def timeline(series: DataFrame, ts: str = "timestamp") -> DataFrame:
    """Every timestamp that occurs in any series, once."""
    return series.select(ts).distinct()


def resample(
    df: DataFrame,
    columns: dict[str, str],
    step_ms: int = GRID_MS,
    ts: str = "timestamp",
    keys: tuple[str, ...] = (),
    tie: tuple[str, ...] = (),
) -> DataFrame:
    """Left-closed windows labelled by their start, one aggregate per column.

    ``tie`` orders rows of equal timestamp for first and last.
    """
    check_aggregates(columns)
    order = F.struct(ts, *tie) if tie else F.col(ts)
    bucket = floor_to(F.col(ts), step_ms).alias("_bucket")
    aggregates = [AGGREGATES[agg](F.col(c), order).alias(c) for c, agg in columns.items()]
    return (
        df.groupBy(*keys, bucket).agg(*aggregates).withColumnRenamed("_bucket", ts)
        .select(ts, *keys, *columns)
    )


def _at_timestamp(name: str, agg: str, tie: str | None) -> dict[str, Column]:
    """What one series contributes to one timestamp."""
    mine = F.col("query_id") == name
    value = F.when(mine, F.col("value"))
    parts = {f"{name}__rows": F.count(F.when(mine, 1))}
    if agg in ("mean", "sum"):
        parts[f"{name}__n"] = F.count(value)
        parts[f"{name}__sum"] = F.sum(value)
    elif agg in ("min", "max"):
        parts[f"{name}__value"] = AGGREGATES[agg](value, F.col("timestamp"))
    else:
        order = F.when(mine, F.struct(F.col(tie)) if tie else F.struct(F.col("value")))
        parts[f"{name}__value"] = AGGREGATES[agg](F.col("value"), order)
    return parts


def _over_window(name: str, agg: str, repeats: dict[str, Column]) -> Column:
    """Aggregate the folded timestamps of one window as if their joined rows were there."""
    order = F.col("timestamp")
    if agg in ("mean", "sum"):
        others = [r for other, r in repeats.items() if other != name]
        weight = reduce(lambda a, b: a * b, others, F.lit(1.0))
        total = F.sum(F.col(f"{name}__sum") * weight)
        if agg == "sum":
            return F.coalesce(total, F.lit(0.0))
        count = F.sum(F.col(f"{name}__n") * weight)
        return F.when(count > 0, total / count)
    return AGGREGATES[agg](F.col(f"{name}__value"), order)


def merge_series(
    series: DataFrame,
    columns: dict[str, str],
    step_ms: int = GRID_MS,
    tie: str | None = None,
) -> DataFrame:
    """Wide grid frame from long ``(query_id, timestamp, value)`` rows.

    ``columns`` maps query ids to aggregates and fixes the column order. Among equal timestamps of
    one series, first and last go by ``tie`` (by value when not given). Two partial aggregations
    and two shuffles, whatever the number of series; a hot timestamp or window is folded on the
    map side first.
    """
    check_aggregates(columns)
    wanted = series.filter(F.col("query_id").isin(list(columns)))
    parts: dict[str, Column] = {}
    for name, agg in columns.items():
        parts.update(_at_timestamp(name, agg, tie))
    folded = wanted.groupBy("timestamp").agg(*[c.alias(n) for n, c in parts.items()])
    repeats = {
        name: F.greatest(F.col(f"{name}__rows"), F.lit(1)).cast("double") for name in columns
    }
    values = [_over_window(name, agg, repeats).alias(name) for name, agg in columns.items()]
    return (
        folded.groupBy(floor_to(F.col("timestamp"), step_ms).alias("_bucket"))
        .agg(*values)
        .withColumnRenamed("_bucket", "timestamp")
    )


def pivot_series(
    series: DataFrame, columns: dict[str, str], step_ms: int = GRID_MS, tie: str | None = None
) -> DataFrame:
    """Variant of :func:`merge_series` for series without duplicate timestamps, which stop the job.

    Means and sums then need no repeat factors, so the long rows go straight into the windows. The
    points of a window are counted in the same aggregation, all and different ones.
    First and last still look at the whole timeline: a window opens with NULL for a series that has
    no point at the first timestamp of the window.
    """
    check_aggregates(columns)
    wanted = series.filter(F.col("query_id").isin(list(columns)))
    values = []
    for name, agg in columns.items():
        mine = F.col("query_id") == name
        value = F.when(mine, F.col("value"))
        if agg in ("first", "last"):
            edge = F.min("timestamp") if agg == "first" else F.max("timestamp")
            at = (
                F.min(F.when(mine, F.col("timestamp")))
                if agg == "first"
                else F.max(F.when(mine, F.col("timestamp")))
            )
            order = F.when(mine, F.col("timestamp"))
            values.append(F.when(edge == at, AGGREGATES[agg](value, order)).alias(name))
        else:
            values.append(AGGREGATES[agg](value, F.col("timestamp")).alias(name))
    windows = wanted.groupBy(floor_to(F.col("timestamp"), step_ms).alias("_bucket")).agg(
        *values,
        F.count("timestamp").alias("_points"),
        F.count_distinct(F.when(F.col("timestamp").isNotNull(), F.struct("query_id", "timestamp"))).alias("_different"),
    )
    stop = F.raise_error(F.lit("a series holds two points at one timestamp: use merge_series"))
    bucket = F.when(F.col("_points") == F.col("_different"), F.col("_bucket")).otherwise(stop.cast("bigint"))
    return windows.select(bucket.alias("timestamp"), *columns)


def has_duplicate_timestamps(series: DataFrame) -> bool:
    """True when some series holds two points at one timestamp (then pivoting is not exact)."""
    repeated = series.groupBy("query_id", "timestamp").count().filter("count > 1")
    return not repeated.isEmpty()


def pivot_or_merge(
    series: DataFrame, columns: dict[str, str], step_ms: int = GRID_MS, tie: str | None = None
) -> DataFrame:
    """Pivoted where that is exact, else merged: for series that may or may not repeat timestamps."""
    wanted = series.filter(F.col("query_id").isin(list(columns)))
    build = merge_series if has_duplicate_timestamps(wanted) else pivot_series
    return build(series, columns, step_ms, tie)
