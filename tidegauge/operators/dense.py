"""Rolling statistics of dense series, where a time block would hold too many rows for one group.

Rows and the ends of their frames are put in one order: a frame (t - width, t] begins behind all rows up to
t - width and ends behind all rows up to t. The order is cut into blocks of equally many entries, whatever the
time they span, so a series with a third of all rows within an hour is as many tasks as it has blocks. A block
folds its rows into (count, mean, squared deviations) and answers for each frame that begins in it what lies
behind the beginning, and for each that ends in it what lies before the end. What lies between are whole blocks;
they are folded once more, per series, from one row a block. The three parts are merged, never subtracted.

The only group that grows with the table is that of a series' blocks: one row for every ``BLOCK_ENTRIES`` entries
(rows times one and the number of widths), and a few more for the pairs of blocks that frames span.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegauge.functions.numbers import floor_div
from tidegauge.operators.moments import MomentTree, merged
from tidegauge.operators.ordering import spread_blocks, with_row_index
from tidegauge.session import checkpoint_root

BLOCK_ENTRIES = 1 << 16
# Of a column: finite values, their mean and squared deviations; known values, and those at plus and minus infinity.
_PARTS = 6
_BEGINS, _ENDS, _WHOLE, _TOTAL = range(4)
_FOUND = "series long, row long, width long, block long, side int, m array<double>"


def _flags(values: np.ndarray, known: np.ndarray) -> list[np.ndarray]:
    unknown = known & np.isnan(values)
    return [known, unknown | (known & (values == np.inf)), unknown | (known & (values == -np.inf))]


class _Folded:
    """The rows of a block, in order, ready for the moments of any run of them."""

    def __init__(self, columns: list[tuple[np.ndarray, np.ndarray]]) -> None:
        self.trees = [MomentTree(v, k & np.isfinite(v)) for v, k in columns]
        self.counts = [[np.concatenate([[0], np.cumsum(f)]) for f in _flags(v, k)] for v, k in columns]

    def between(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        parts = []
        for tree, counts in zip(self.trees, self.counts):
            parts += [*tree.moments(low, high), *[upto[high] - upto[low] for upto in counts]]
        return np.stack(parts, axis=1).astype("f8")


def _joined(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Parts of disjoint sets of rows together."""
    out = a + b
    for k in range(0, a.shape[1], _PARTS):
        n, mean, dev = merged(tuple(a[:, k + i] for i in range(3)), tuple(b[:, k + i] for i in range(3)))
        out[:, k], out[:, k + 1], out[:, k + 2] = n, mean, dev
    return out


def _lists(m: np.ndarray) -> pa.Array:
    offsets = np.arange(len(m) + 1, dtype="i4") * (m.shape[1] if m.ndim > 1 else 0)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(m.reshape(-1)))


def _matrix(column, width: int) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.array(flat.flatten()).reshape(-1, width)


def _rows_of(series, row, width, block, side, m) -> pa.Table:
    n = len(row)
    full = lambda v, t: pa.array(np.full(n, v), t) if np.isscalar(v) else pa.array(v, t)
    return pa.table({"series": full(series, pa.int64()), "row": pa.array(row, pa.int64()), "width": full(width, pa.int64()), "block": full(block, pa.int64()), "side": full(side, pa.int32()), "m": _lists(m)})


def _fold_block(columns: int):
    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("place")
        series, block = table["series"][0].as_py(), table["block"][0].as_py()
        query = table["kind"].to_numpy() == 1
        data = table.filter(pa.array(~query))
        values = [(data[f"v{k}"].fill_null(0.0).to_numpy(), data[f"v{k}"].is_valid().to_numpy()) for k in range(columns)]
        folded, size = _Folded(values), data.num_rows
        place = np.cumsum(~query)[query]
        row, width = table["row"].to_numpy()[query], table["width"].to_numpy()[query]
        upper = width == 0
        order = np.argsort(row[upper], kind="stable")
        ends, end_place = row[upper][order], place[upper][order]
        low_row, low, low_width = row[~upper], place[~upper], width[~upper]
        at = np.minimum(np.searchsorted(ends, low_row), max(len(ends) - 1, 0))
        here = (ends[at] == low_row) if len(ends) else np.zeros(len(low_row), bool)
        high = np.full(len(low), size)
        high[here] = end_place[at[here]]
        out = [
            _rows_of(series, low_row, low_width, block, np.where(here, _WHOLE, _BEGINS), folded.between(low, high)),
            _rows_of(series, ends, 0, block, _ENDS, folded.between(np.zeros(len(ends), int), end_place)),
            _rows_of(series, np.array([-1]), 0, block, _TOTAL, folded.between(np.zeros(1, int), np.array([size]))),
        ]
        return pa.concat_tables(out)

    return run


def _between_blocks(width: int):
    """Of each pair of blocks (lo, hi) what the whole blocks between them hold."""

    def run(table: pa.Table) -> pa.Table:
        hi = table["hi"]
        totals = table.filter(hi.is_null()).sort_by("lo")
        asked = table.filter(hi.is_valid())
        # every block of a series holds entries, so block k is row k
        m = _matrix(totals["m"], width)
        low, high = asked["lo"].to_numpy() + 1, asked["hi"].to_numpy()
        parts = []
        for k in range(0, width, _PARTS):
            parts += MomentTree.over(m[:, k], m[:, k + 1], m[:, k + 2]).moments(low, high)
            for i in range(3, _PARTS):
                upto = np.concatenate([[0.0], np.cumsum(m[:, k + i])])
                parts.append(upto[high] - upto[low])
        found = np.stack(parts, axis=1) if len(low) else np.zeros((0, width))
        return pa.table({"series": asked["series"], "lo": asked["lo"], "hi": asked["hi"], "b": _lists(found)})

    return run


def frame_numbers(m: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(mean, no mean, deviation, no deviation) from the parts of one column."""
    n, mean, squares, present, plus, minus = m.T
    plus, minus = plus > 0, minus > 0
    mean = np.where(plus & minus, np.nan, np.where(plus, np.inf, np.where(minus, -np.inf, mean)))
    std = np.where(plus | minus, np.nan, np.sqrt(squares / np.maximum(n - 1, 1)))
    return mean, present == 0, std, present < 2


def dense_statistics(
    df: DataFrame, columns: list[str], widths: list[int], statistics: tuple[str, ...], keys: tuple[str, ...], ts: str
) -> DataFrame:
    """The columns of ``rolling_statistics``, with groups bounded by rows instead of time."""
    spark = df.sparkSession
    checkpoint_root(spark)
    series = F.xxhash64(*[F.col(f"`{k}`") for k in keys]) if keys else F.lit(0).cast("long")
    rows = with_row_index(df.withColumn("_series", series), (ts,), ("_series",), index="_row")
    values = [F.col(f"`{c}`").cast("double").alias(f"v{k}") for k, c in enumerate(columns)]
    head = [F.col("_series").alias("series"), F.col("_row").alias("row")]
    stamp = F.col(f"`{ts}`").cast("long")
    data = rows.select(*head, stamp.alias("at"), F.lit(0).alias("kind"), F.lit(-1).cast("long").alias("width"), *values)
    ends = [F.struct((stamp - w).alias("at"), F.lit(w).cast("long").alias("width")) for w in (0, *widths)]
    asked = rows.select(*head, F.explode(F.array(*ends)).alias("e")).select("series", "row", "e.at", F.lit(1).alias("kind"), "e.width")
    entries = data.unionByName(asked, allowMissingColumns=True)
    placed = with_row_index(entries, ("at", "kind"), ("series",), index="place").withColumn("block", floor_div(F.col("place"), BLOCK_ENTRIES))
    wide = _PARTS * len(columns)
    found = spread_blocks(placed, "series", "block").groupBy("series", "block").applyInArrow(_fold_block(len(columns)), _FOUND).checkpoint()
    begins = found.filter(F.col("side") == _BEGINS).select("series", "row", "width", F.col("block").alias("lo"), F.col("m").alias("first"))
    stops = found.filter(F.col("side") == _ENDS).select("series", "row", F.col("block").alias("hi"), F.col("m").alias("last"))
    split = begins.join(stops, ["series", "row"])
    pairs = split.filter("hi - lo > 1").select("series", "lo", "hi").distinct()
    totals = found.filter(F.col("side") == _TOTAL).select("series", F.col("block").alias("lo"), F.lit(None).cast("long").alias("hi"), "m")
    asked_pairs = totals.unionByName(pairs, allowMissingColumns=True)
    between = asked_pairs.groupBy("series").applyInArrow(_between_blocks(wide), "series long, lo long, hi long, b array<double>")
    nothing = F.array_repeat(F.lit(0.0), wide)
    three = split.join(between, ["series", "lo", "hi"], "left").select("series", "row", "width", "first", F.coalesce("b", nothing).alias("b"), "last")
    whole = found.filter(F.col("side") == _WHOLE).select("series", "row", "width", F.col("m").alias("first"), nothing.alias("b"), nothing.alias("last"))
    names = [f"{stat}{k}" for k in range(len(columns)) for stat in ("mean", "std")]

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            m = _joined(_joined(*[_matrix(batch.column(c), wide) for c in ("first", "b")]), _matrix(batch.column("last"), wide))
            made = []
            for k in range(len(columns)):
                mean, no_mean, std, no_std = frame_numbers(m[:, k * _PARTS : (k + 1) * _PARTS])
                made += [pa.array(mean, mask=no_mean), pa.array(std, mask=no_std)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], *made], ["series", "row", "width", *names])

    numbers = three.unionByName(whole).mapInArrow(merge, "series long, row long, width long, " + ", ".join(f"{n} double" for n in names))
    made = [
        F.max(F.when(F.col("width") == w, F.col(f"{stat}{k}"))).alias(f"{c}_{stat}_{w}i")
        for stat in statistics
        for w in widths
        for k, c in enumerate(columns)
    ]
    wide_rows = numbers.groupBy(F.col("series").alias("_series"), F.col("row").alias("_row")).agg(*made)
    joined = rows.join(wide_rows, ["_series", "_row"], "left")
    return joined.select(*[F.col(f"`{c}`") for c in df.columns], *[f"{c}_{stat}_{w}i" for stat in statistics for w in widths for c in columns])
