"""Standardisation with population deviation, fitted once and applied as literals."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.functions.numbers import clip


@dataclass(frozen=True)
class Scale:
    """Mean and usable deviation per column: one number each, however large the frame."""

    mean: dict[str, float]
    std: dict[str, float]


def fit_scale(df: DataFrame, columns: list[str], epsilon: float = 1e-12) -> Scale:
    """Fit on the frame; a deviation below ``epsilon`` counts as 1."""
    measures = [F.count(F.lit(1)).alias("_rows")]
    for i, c in enumerate(columns):
        measures += [F.avg(c).alias(f"m{i}"), F.stddev_pop(c).alias(f"s{i}")]
    row = df.agg(*measures).first()
    if row["_rows"] == 0:
        raise ValueError("standardisation needs at least one row")
    mean = {c: _number(row[f"m{i}"]) for i, c in enumerate(columns)}
    std = {c: _number(row[f"s{i}"]) for i, c in enumerate(columns)}
    return Scale(mean, {c: 1.0 if s < epsilon else s for c, s in std.items()})


def _number(value: float | None) -> float:
    return math.nan if value is None else value


def apply_scale(df: DataFrame, scale: Scale) -> DataFrame:
    """Replace each fitted column by its distance from the mean in deviations."""
    return df.withColumns(
        {c: (F.col(c) - F.lit(m)) / F.lit(scale.std[c]) for c, m in scale.mean.items()}
    )


def standardize(
    train: DataFrame, others: list[DataFrame], columns: list[str]
) -> tuple[DataFrame, list[DataFrame], Scale]:
    """Fit on ``train`` and apply to it and to the other frames."""
    scale = fit_scale(train, columns)
    return apply_scale(train, scale), [apply_scale(df, scale) for df in others], scale


def fit_target(df: DataFrame, target: str) -> Scale:
    """Scale of the target: a tiny or non-finite deviation counts as 1."""
    scale = fit_scale(df, [target], epsilon=1e-8)
    std = scale.std[target]
    return scale if math.isfinite(std) else Scale(scale.mean, {target: 1.0})


def restore_target(df: DataFrame, scale: Scale, column: str, target: str) -> DataFrame:
    """Undo the target scale on a prediction column."""
    return df.withColumn(column, F.col(column) * F.lit(scale.std[target]) + F.lit(scale.mean[target]))


def clip_columns(df: DataFrame, columns: list[str], low: float = -20.0, high: float = 20.0) -> DataFrame:
    return df.withColumns({c: clip(F.col(c), low, high) for c in columns})
