"""Numeric Column helpers with NULL and NaN kept apart."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: smallest denominator of the percentage error (double machine epsilon).
EPSILON = 2.220446049250313e-16


def float_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.DoubleType)]


def is_finite(c: Column) -> Column:
    """True for real numbers; false for NULL, NaN and infinities."""
    return F.coalesce(~F.isnan(c) & (F.abs(c) != float("inf")), F.lit(False))


def clip(c: Column, low: float, high: float) -> Column:
    """Limit to [low, high]. NaN is expected to be filtered out before."""
    return F.when(c.isNotNull(), F.greatest(F.least(c, F.lit(high)), F.lit(low)))


def all_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions, F.lit(True))


def any_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions, F.lit(False))


def floor_to(c: Column, step: int) -> Column:
    """Largest multiple of ``step`` not above an integer column, exact for negatives too."""
    return c - F.pmod(c, F.lit(step).cast("bigint"))


def floor_div(c: Column, step: int) -> Column:
    """Index of the step an integer column falls in."""
    return F.call_function("div", floor_to(c, step), F.lit(step).cast("bigint"))


def step_at_or_after(c: Column, step: int) -> Column:
    """Smallest multiple of ``step`` not below an integer column."""
    return -floor_to(-c, step)


def _without_nan(c: Column) -> Column:
    return F.when(~F.isnan(c), c)


def _extreme(pick: Callable[[Column], Column]) -> Callable[[Column, Column], Column]:
    def build(c: Column, order: Column) -> Column:
        # NaN only survives when nothing else is there.
        return F.coalesce(pick(_without_nan(c)), pick(c))

    return build


# Aggregates a column may ask for when it is resampled. ``order`` decides first and last.
AGGREGATES: dict[str, Callable[[Column, Column], Column]] = {
    "mean": lambda c, order: F.avg(c),
    "sum": lambda c, order: F.coalesce(F.sum(c), F.lit(0.0)),
    "min": _extreme(F.min),
    "max": _extreme(F.max),
    "first": lambda c, order: F.min_by(c, order),
    "last": lambda c, order: F.max_by(c, order),
}


def check_aggregates(columns: dict[str, str]) -> None:
    for name, agg in columns.items():
        if agg not in AGGREGATES:
            raise ValueError(f"column {name!r} asks for {agg!r}, which is none of {', '.join(AGGREGATES)}")


def strict(text: Column, kind: str, what: str) -> Column:
    """Text as a number; text that is none stops the job, whatever the session's ANSI setting."""
    number = text.try_cast(kind)
    wrong = F.raise_error(F.concat(F.lit(f"{what} is no {kind}: "), text)).cast(kind)
    return F.when(text.isNotNull() & number.isNull(), wrong).otherwise(number)


def unfold(df: DataFrame, carry: list, array: Column, name: str) -> DataFrame:
    """One row per array element, for arrays that are costly to compute.

    A plain ``explode`` makes the optimizer test size and NULL of its input first, and those tests
    are pushed below the projection that parses the JSON, which is then parsed once per test. The
    outer form adds no tests; its NULL rows are dropped behind it.
    """
    return df.select(*carry, F.explode_outer(array).alias(name)).filter(F.col(name).isNotNull())
