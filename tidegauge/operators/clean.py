"""Cleaning with exact NULL and NaN rules, quality gates and row counters."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tidegauge.functions.numbers import all_of, any_of, float_columns, is_finite


class QualityError(ValueError):
    """A frame failed the gate in front of a write."""


def clean_series(df: DataFrame, value: str = "value", ts: str = "timestamp") -> DataFrame:
    """Drop points without a real value or with a timestamp at or before 0."""
    return df.filter(F.col(value).isNotNull() & ~F.isnan(value) & (F.col(ts) > 0))


def drop_nan_rows(df: DataFrame) -> DataFrame:
    """Drop rows holding NaN in any double column. NULLs stay."""
    tests = [F.coalesce(~F.isnan(c), F.lit(True)) for c in float_columns(df)]
    return df.filter(all_of(tests)) if tests else df


def drop_null_rows(df: DataFrame, column: str, observation: Observation | None = None) -> DataFrame:
    """Drop rows where ``column`` is NULL, counting them when an observation is given."""
    if observation is not None:
        df = df.observe(
            observation,
            F.count(F.lit(1)).alias("rows"),
            F.count_if(F.col(column).isNull()).alias("dropped_rows"),
        )
    return df.filter(F.col(column).isNotNull())


def fill_nulls(df: DataFrame, column: str, value: float = 0.0) -> DataFrame:
    """Replace NULL, and only NULL, in one column."""
    return df.withColumn(column, F.coalesce(F.col(column), F.lit(value)))


def clean_frame(
    df: DataFrame,
    critical: str,
    zero_filled: str,
    observation: Observation | None = None,
) -> DataFrame:
    """NaN rows out, rows without the critical column out, missing counts to 0, in that order."""
    return (
        df.transform(drop_nan_rows)
        .transform(drop_null_rows, critical, observation)
        .transform(fill_nulls, zero_filled)
    )


def finite_rows(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows whose columns all hold finite numbers."""
    return df.filter(all_of([is_finite(F.col(c).cast("double")) for c in columns]))


def quality_flags(df: DataFrame) -> DataFrame:
    """One row: is any NULL present, is any NaN present. Both false for an empty frame."""
    null = any_of([F.col(c).isNull() for c in df.columns])
    nan = any_of([F.coalesce(F.isnan(c), F.lit(False)) for c in float_columns(df)])
    return df.agg(
        F.coalesce(F.bool_or(null), F.lit(False)).alias("has_null"),
        F.coalesce(F.bool_or(nan), F.lit(False)).alias("has_nan"),
    )


def is_null_present(df: DataFrame) -> bool:
    return bool(quality_flags(df).first()["has_null"])


def is_nan_present(df: DataFrame) -> bool:
    return bool(quality_flags(df).first()["has_nan"])


def require_clean(df: DataFrame) -> DataFrame:
    """Return the frame unchanged, or raise when it holds NULL or NaN."""
    flags = quality_flags(df).first()
    if flags["has_null"] or flags["has_nan"]:
        raise QualityError(f"NULL present: {flags['has_null']}, NaN present: {flags['has_nan']}")
    return df


def count_rows(df: DataFrame, name: str, kept=None) -> tuple[DataFrame, Observation]:
    """Count rows, and the rows a condition keeps, as the frame runs; no extra pass."""
    observation = Observation(name)
    counters = [F.count(F.lit(1)).alias("rows")]
    if kept is not None:
        counters.append(F.count_if(kept).alias("kept_rows"))
        counters.append(F.count_if(F.coalesce(~kept, F.lit(True))).alias("filtered_rows"))
    return df.observe(observation, *counters), observation
