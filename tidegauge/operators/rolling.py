"""Rolling statistics over (t - width, t] on the time axis.

Without a key a plain ``RANGE`` window runs in one task. So rows are put into time blocks, with
copies of the rows the next block looks back at, and every block is worked through on its own.

Inside a block the values are folded into a tree of (count, mean, squared deviations): a node merges
its two halves, and a frame of any width is put together from the few nodes that cover it. Nothing is
ever subtracted, so an outlier leaves no trace in the frames it is not in, a frame of equal values has
deviation exactly 0, and one way serves all widths.

A block holds the rows of three times the longest width of one series. That suits grid frames, with one
row per series and grid step. If any block holds more than ``GROUP_ROWS`` rows, blocks are cut by rows
instead of time (see :mod:`tidegauge.operators.dense`).
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegauge.functions.numbers import floor_div
from tidegauge.operators.dense import dense_statistics
from tidegauge.operators.moments import MomentTree
from tidegauge.operators.ordering import shift_rows, spread_blocks, with_row_index

_BLOCK = "_time_block"
_HOME = "_in_home"

# Most rows of a time block that is worked through as one group.
GROUP_ROWS = 1 << 18
MINUTE, HOUR, DAY = 60_000, 3_600_000, 86_400_000


def in_time_blocks(
    df: DataFrame, width: int, block_ms: int, ts: str, keys: tuple[str, ...] = ()
) -> DataFrame:
    """Copy each row to every block in which a frame of ``width`` can reach back to it."""
    own = floor_div(F.col(ts), block_ms)
    last = floor_div(F.col(ts) + (width - 1), block_ms)
    copies = (
        df.withColumn("_own", own)
        .withColumn(_BLOCK, F.explode(F.sequence(own, last)))
        .withColumn(_HOME, F.col("_own") == F.col(_BLOCK))
        .drop("_own")
    )
    return spread_blocks(copies, *keys, _BLOCK)


def rows_of_fullest_block(df: DataFrame, block_ms: int, ts: str, keys: tuple[str, ...] = ()) -> int:
    counted = df.groupBy(*[F.col(k) for k in keys], floor_div(F.col(ts), block_ms).alias(_BLOCK)).count()
    return counted.agg(F.max("count")).first()[0] or 0


def block_length(width: int) -> int:
    """Blocks of two widths, so that half of the rows is copied, but not below a day."""
    return max(2 * width, DAY)


def _frame_statistics(values: np.ndarray, known: np.ndarray, low: np.ndarray, high: np.ndarray):
    """Mean and sample deviation of frames of rows, with masks of the NULLs."""
    finite = known & np.isfinite(values)
    n, mean, squares = MomentTree(values, finite).moments(low, high)

    def number(flags: np.ndarray) -> np.ndarray:
        upto = np.concatenate([[0], np.cumsum(flags)])
        return upto[high] - upto[low]

    unknown = known & np.isnan(values)
    plus = number(unknown | (known & (values == np.inf))) > 0
    minus = number(unknown | (known & (values == -np.inf))) > 0
    present = number(known)
    mean = np.where(plus & minus, np.nan, np.where(plus, np.inf, np.where(minus, -np.inf, mean)))
    std = np.sqrt(squares / np.maximum(n - 1, 1))
    return mean, present == 0, np.where(plus | minus, np.nan, std), present < 2


def rolling_statistics(
    df: DataFrame,
    columns: list[str],
    widths: list[int],
    statistics: tuple[str, ...] = ("mean", "std"),
    keys: tuple[str, ...] = (),
    ts: str = "timestamp",
) -> DataFrame:
    """Unshifted rolling ``mean`` and ``std`` columns of a frame.

    NULLs are ignored, an empty frame gives NULL, the deviation needs two values; a NaN or infinite
    value shows in the frames it is in. Rows of equal timestamp see the same frame. One shuffle.
    """
    width = max(widths)
    if rows_of_fullest_block(df, block_length(width), ts, keys) > GROUP_ROWS:
        return dense_statistics(df, columns, widths, statistics, keys, ts)
    blocks = in_time_blocks(df, width, block_length(width), ts, keys)
    names = [f"{c}_{stat}_{w}i" for stat in statistics for w in widths for c in columns]
    schema = T.StructType([*df.schema.fields, *[T.StructField(n, T.DoubleType()) for n in names]])
    kept = list(df.columns)

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by(ts)
        times = table.column(ts).to_numpy()
        high = np.searchsorted(times, times, "right")
        home = table.column(_HOME)
        made = {}
        for c in columns:
            column = table.column(c)
            known = column.is_valid().to_numpy()
            values = column.cast(pa.float64()).fill_null(0.0).to_numpy()
            for w in widths:
                low = np.searchsorted(times, times - w, "right")
                mean, no_mean, std, no_std = _frame_statistics(values, known, low, high)
                made[f"{c}_mean_{w}i"] = pa.array(mean, mask=no_mean)
                made[f"{c}_std_{w}i"] = pa.array(std, mask=no_std)
        rows = table.select(kept)
        for name in names:
            rows = rows.append_column(name, made[name])
        return rows.filter(home)

    return blocks.groupBy(*keys, _BLOCK).applyInArrow(run, schema)


def _names(columns: list[str], widths: list[int], label: str) -> list[str]:
    return [f"{c}_{label}_{w}i" for w in widths for c in columns]


def rolling_quantile(
    df: DataFrame,
    columns: list[str],
    widths: list[int],
    q: float,
    label: str,
    keys: tuple[str, ...] = (),
    ts: str = "timestamp",
) -> DataFrame:
    """Unshifted rolling quantile: the median interpolates, other quantiles take the nearest rank.

    Order statistics have no running form in Spark, where each frame would be sorted anew. Blocks
    are therefore handed to pandas, whose rolling quantile keeps the frame sorted as it moves. A
    group is one time block of one series, not a whole series.
    """
    width = max(widths)
    blocks = in_time_blocks(df, width, block_length(width), ts, keys)
    names = _names(columns, widths, label)
    schema = T.StructType([*df.schema.fields, *[T.StructField(n, T.DoubleType()) for n in names]])
    grouped = blocks.groupBy(*keys, _BLOCK)
    return grouped.applyInPandas(_quantiles_of_block(columns, widths, q, label, ts, schema), schema)


def _quantiles_of_block(columns, widths, q, label, ts, schema):
    names, home = schema.fieldNames(), _HOME

    def quantile(frames) -> pd.Series:
        if q == 0.5:
            return frames.median()
        position = (frames.count() - 1) * q
        lower = frames.quantile(q, interpolation="lower")
        higher = frames.quantile(q, interpolation="higher")
        return higher.where(position % 1 >= 0.5, lower)

    def run(block: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values(ts, kind="stable")
        clock = pd.to_datetime(block[ts], unit="ms")
        made = []
        for w in widths:
            for c in columns:
                values = block[c].to_numpy(dtype="float64", na_value=float("nan"))
                frames = pd.Series(values, index=clock).rolling(pd.Timedelta(w, unit="ms"), min_periods=1)
                made.append(f"{c}_{label}_{w}i")
                block[made[-1]] = quantile(frames).to_numpy()
        if block[ts].duplicated().any():
            # Rows of one timestamp share the frame that ends with the last of them.
            block[made] = block.groupby(ts)[made].transform("last")
        return block.loc[block[home], names]

    return run


def _rolled_and_moved(df, names, roll, keys, ts) -> DataFrame:
    """Run ``roll`` on the indexed frame and move its columns down one row, so that a row never
    sees itself. The index is made first, while the frame is narrow: its range sort reads its
    input twice."""
    rolled = roll(with_row_index(df, (ts,), keys))
    moved = shift_rows(rolled, {f"_{c}_moved": (c, 1) for c in names}, keys)
    return moved.select(*df.columns, *[F.col(f"_{c}_moved").alias(c) for c in names])


def rolling_mean(df, columns, widths, keys=(), ts="timestamp") -> DataFrame:
    """Rolling means of the rows before: ``{column}_mean_{width}i``."""
    names = _names(columns, widths, "mean")
    return _rolled_and_moved(
        df, names, lambda x: rolling_statistics(x, columns, widths, ("mean",), keys, ts), keys, ts
    )


def rolling_std(df, columns, widths, keys=(), ts="timestamp") -> DataFrame:
    """Rolling sample deviations of the rows before: ``{column}_std_{width}i``."""
    names = _names(columns, widths, "std")
    return _rolled_and_moved(
        df, names, lambda x: rolling_statistics(x, columns, widths, ("std",), keys, ts), keys, ts
    )


def rolling_p50(df, columns, widths, keys=(), ts="timestamp") -> DataFrame:
    """Rolling medians of the rows before: ``{column}_p50_{width}i``."""
    names = _names(columns, widths, "p50")
    return _rolled_and_moved(
        df, names, lambda x: rolling_quantile(x, columns, widths, 0.5, "p50", keys, ts), keys, ts
    )


def rolling_p90(df, columns, widths, keys=(), ts="timestamp") -> DataFrame:
    """Rolling 0.9-quantiles, nearest rank, of the rows before: ``{column}_p90_{width}i``."""
    names = _names(columns, widths, "p90")
    return _rolled_and_moved(
        df, names, lambda x: rolling_quantile(x, columns, widths, 0.9, "p90", keys, ts), keys, ts
    )
