"""Feature sets of a wide grid frame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.functions.calendar import business_day, harmonics_hours, hour_seasonality
from tidegauge.operators.ordering import (
    INDEX,
    block_window,
    in_row_blocks,
    only_home,
    shift_rows,
    with_row_index,
)
from tidegauge.operators.rolling import DAY, HOUR, MINUTE, rolling_statistics

Step = Callable[[DataFrame], DataFrame]

# Lags in minutes by column suffix, and rolling widths in milliseconds.
LAGS = {
    "1m": 1,
    "2m": 2,
    "5m": 5,
    "10m": 10,
    "30m": 30,
    "1h": 60,
    "12h": 720,
    "1d": 1440,
    "7d": 10080,
    "15d": 21600,
    "30d": 43200,
}
WIDTHS = [
    5 * MINUTE,
    10 * MINUTE,
    30 * MINUTE,
    HOUR,
    6 * HOUR,
    12 * HOUR,
    DAY,
    7 * DAY,
    15 * DAY,
    30 * DAY,
]
_TINY = 1e-9


def lag_rows(
    df: DataFrame,
    columns: list[str],
    lags: dict[str, int] | None = None,
    step_seconds: int = 60,
    keys: tuple[str, ...] = (),
    ts: str = "timestamp",
) -> DataFrame:
    """Columns ``{c}_lag_{suffix}``: the value ``minutes`` grid steps of rows earlier.

    Rows are counted, not time: a gap in the frame makes the real distance longer.
    """
    lags = LAGS if lags is None else lags
    shifts = _lag_shifts(columns, lags, step_seconds)
    return shift_rows(with_row_index(df, (ts,), keys), shifts, keys).drop(INDEX)


def _lag_shifts(columns, lags, step_seconds) -> dict[str, tuple[str, int]]:
    per_minute = int(60 / step_seconds)
    return {
        f"{c}_lag_{suffix}": (c, minutes * per_minute)
        for suffix, minutes in lags.items()
        for c in columns
    }


def _guarded(numerator: Column, denominator: Column) -> Column:
    """Quotient where the denominator is not close to 0, NULL elsewhere."""
    return F.when(F.abs(denominator) > _TINY, F.try_divide(numerator, denominator))


def _hour(c: str, stat: str) -> str:
    return f"{c}_{stat}_{HOUR}i"


def _day(c: str, stat: str) -> str:
    return f"{c}_{stat}_{DAY}i"


def diff_ratio_columns(c: str, previous: Column) -> dict[str, Column]:
    """Distance of the previous value to the 1 h mean, and 1 h mean over 1 d mean."""
    hour, day = F.col(_hour(c, "mean")), F.col(_day(c, "mean"))
    return {f"{c}_diff_mean_1h": previous - hour, f"{c}_ratio_mean_1h_1d": _guarded(hour, day)}


def delta_zscore_columns(c: str, previous: Column, previous_mean: Column) -> dict[str, Column]:
    """Change of the 1 h mean, and z-scores of the previous value against 1 h and 1 d."""
    hour, day = F.col(_hour(c, "mean")), F.col(_day(c, "mean"))
    return {
        f"{c}_delta_mean_1h": hour - previous_mean,
        f"{c}_zscore_1h": _guarded(previous - hour, F.col(_hour(c, "std"))),
        f"{c}_zscore_1d": _guarded(previous - day, F.col(_day(c, "std"))),
    }


def lagged_features(
    df: DataFrame,
    columns: list[str],
    ratio_columns: list[str],
    lags: dict[str, int] | None = None,
    widths: list[int] | None = None,
    step_seconds: int = 60,
    keys: tuple[str, ...] = (),
    ts: str = "timestamp",
) -> DataFrame:
    """Lags, rolling means and deviations of the rows before, differences, ratios and z-scores.

    The rows are indexed while the frame is still narrow. Rolling statistics follow, unshifted and
    in time blocks. One pass over row blocks then does every shift at once: the lags, the one-row
    shift of each statistic and the second shift inside the delta of the 1 h mean.
    """
    lags = LAGS if lags is None else lags
    widths = WIDTHS if widths is None else widths
    indexed = with_row_index(df, (ts,), keys)
    rolled = rolling_statistics(indexed, columns, widths, ("mean", "std"), keys, ts)

    lag_shifts = _lag_shifts(columns, lags, step_seconds)
    w = block_window(keys)
    reach = max([2, *[rows for _, rows in lag_shifts.values()]])
    blocks = in_row_blocks(rolled, reach, keys=keys)
    lag_columns = {name: F.lag(c, rows).over(w) for name, (c, rows) in lag_shifts.items()}
    means = [f"{c}_mean_{width}i" for width in widths for c in columns]
    stds = [f"{c}_std_{width}i" for width in widths for c in columns]
    moved = {f"_{name}": F.lag(name, 1).over(w) for name in [*means, *stds]}
    helpers: dict[str, Column] = {}
    for c in ratio_columns:
        helpers[f"_{c}_previous"] = F.lag(c, 1).over(w)
        helpers[f"_{c}_older_mean"] = F.lag(_hour(c, "mean"), 2).over(w)
    shifted = only_home(blocks.withColumns({**lag_columns, **moved, **helpers}))

    # Put the moved statistics in place, then derive the ratios from them.
    statistics = shifted.select(
        *df.columns,
        *lag_columns,
        *[F.col(f"_{name}").alias(name) for name in [*means, *stds]],
        *helpers,
    )
    ratios: dict[str, Column] = {}
    scores: dict[str, Column] = {}
    for c in ratio_columns:
        previous = F.col(f"_{c}_previous")
        ratios.update(diff_ratio_columns(c, previous))
        scores.update(delta_zscore_columns(c, previous, F.col(f"_{c}_older_mean")))
    return statistics.withColumns({**ratios, **scores}).select(
        *df.columns, *lag_columns, *means, *ratios, *stds, *scores
    )


def seasonal_steps(ts: str = "timestamp") -> list[Step]:
    return [
        lambda df: hour_seasonality(df, ts),
        lambda df: harmonics_hours(df, ts),
        lambda df: business_day(df, ts),
    ]


def run_steps(df: DataFrame, steps: list[Step]) -> DataFrame:
    for step in steps:
        df = df.transform(step)
    return df


def _ml_v1(columns: list[str], target: str, **options) -> list[Step]:
    ratio_columns = [c for c in columns if c != target]
    return [*seasonal_steps(), lambda df: lagged_features(df, columns, ratio_columns, **options)]


def _sequence_v1(columns: list[str], target: str, **options) -> list[Step]:
    return seasonal_steps()


# Ordered frame-to-frame functions by feature set and version; add an entry to extend.
FEATURE_SETS: dict[tuple[str, str], Callable[..., list[Step]]] = {
    ("ml", "v1"): _ml_v1,
    ("sequence", "v1"): _sequence_v1,
}


def generate_features(
    df: DataFrame, columns: list[str], target: str, kind: str = "ml", version: str = "v1", **options
) -> DataFrame:
    """Run a registered feature set. ``columns`` are the query ids of the frame, in order."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"unknown columns: {missing}")
    return run_steps(df, FEATURE_SETS[kind, version](columns, target, **options))
