"""Row positions over a whole frame: index, row shifts, chronological split, sequences.

A window without a partition key would pull the frame into one task, and a window per series does
the same for a hot series. Row positions are therefore made once by a range sort, which cuts hot
keys and hot timestamps like everything else, and later operators work on equal blocks of rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegauge.functions.numbers import all_of, floor_div
from tidegauge.session import checkpoint_root

INDEX = "row_idx"
_BLOCK = "_block"
_HOME = "_home"
_TIE = "_tie"
# Rows of one block; a block is the unit a window task sorts.
BLOCK_ROWS = 16_384
# monotonically_increasing_id: partition number above, row number in the lower 33 bits.
_ID_BITS = 33


def row_hash(df: DataFrame) -> Column:
    """64-bit hash of a row; maps, which have no order, count by their sorted entries."""

    def hashable(field: T.StructField) -> Column:
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.MapType):
            return F.array_sort(F.map_entries(c))
        return F.to_json(F.struct(c)) if "map<" in field.dataType.simpleString() else c

    return F.xxhash64(*[hashable(f) for f in df.schema.fields])


def with_row_index(
    df: DataFrame,
    order: tuple[str, ...] = ("timestamp",),
    keys: tuple[str, ...] = (),
    index: str = INDEX,
    partitions: int | None = None,
) -> DataFrame:
    """Number the rows 0, 1, 2, ... by ``order``, per series when ``keys`` are given.

    The sorted frame is checkpointed to the shared folder: partition numbers come from sampled
    range bounds, so they must not be computed a second time after a lost executor. The only
    other table holds one row per (partition, series) and is joined on both, which keeps a hot
    series spread over its partitions. Rows that tie in ``order`` follow a hash of the whole row: their
    order is the same in every run, and a hot timestamp is cut like everything else.
    """
    checkpoint_root(df.sparkSession)
    columns = [*keys, *order, _TIE]
    tied = df.withColumn(_TIE, row_hash(df))
    ranged = (
        tied.repartitionByRange(partitions, *columns) if partitions else tied.repartitionByRange(*columns)
    )
    position = F.monotonically_increasing_id()
    placed = (
        ranged.sortWithinPartitions(*columns)
        .drop(_TIE)
        .withColumn("_position", position)
        .withColumns(
            {
                "_part": F.shiftright("_position", _ID_BITS),
                "_offset": F.col("_position").bitwiseAND(F.lit((1 << _ID_BITS) - 1)),
            }
        )
        .drop("_position")
        .checkpoint()
    )
    parts = placed.groupBy("_part", *keys).agg(
        F.count(F.lit(1)).alias("_rows"), F.min("_offset").alias("_first")
    )
    before = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.select(
        F.col("_part").alias("_start_part"),
        *[F.col(k).alias(f"_start_{k}") for k in keys],
        (F.coalesce(F.sum("_rows").over(before), F.lit(0)) - F.col("_first")).alias("_shift"),
    )
    same_rows = F.col("_part") == F.col("_start_part")
    for k in keys:
        same_rows = same_rows & F.col(k).eqNullSafe(F.col(f"_start_{k}"))
    joined = placed.join(starts if keys else F.broadcast(starts), same_rows)
    return joined.select(*df.columns, (F.col("_offset") + F.col("_shift")).alias(index))


def spread_blocks(df: DataFrame, *columns: str) -> DataFrame:
    """Shuffle blocks over all shuffle partitions.

    Window work is heavy for its bytes. Left to itself the planner would join partitions by size
    and run many blocks in few tasks.
    """
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(partitions, *columns)


def in_row_blocks(
    df: DataFrame,
    reach: int,
    index: str = INDEX,
    block_rows: int = BLOCK_ROWS,
    keys: tuple[str, ...] = (),
) -> DataFrame:
    """Copy each row to its own block and to the block whose first rows look back at it.

    Blocks hold at least four times ``reach`` rows, so at most a quarter of the rows is copied.
    """
    rows = max(block_rows, 4 * reach)
    home = floor_div(F.col(index), rows)
    last = floor_div(F.col(index) + reach, rows)
    copies = (
        df.withColumn("_own", home)
        .withColumn(_BLOCK, F.explode(F.sequence(home, last)))
        .withColumn(_HOME, F.col("_own") == F.col(_BLOCK))
        .drop("_own")
    )
    return spread_blocks(copies, *keys, _BLOCK)


def block_window(keys: tuple[str, ...] = (), index: str = INDEX):
    return Window.partitionBy(*keys, _BLOCK).orderBy(index)


def only_home(df: DataFrame) -> DataFrame:
    return df.filter(_HOME).drop(_BLOCK, _HOME)


def shift_rows(
    df: DataFrame,
    shifts: dict[str, tuple[str, int]],
    keys: tuple[str, ...] = (),
    index: str = INDEX,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Add columns holding the value of another column some rows earlier.

    ``shifts`` maps the new name to (column, rows). All shifts share one shuffle and one sort.
    """
    reach = max(rows for _, rows in shifts.values())
    w = block_window(keys, index)
    moved = in_row_blocks(df, reach, index, block_rows, keys).withColumns(
        {name: F.lag(c, rows).over(w) for name, (c, rows) in shifts.items()}
    )
    return only_home(moved)


def _nth_value(df: DataFrame, column: str, rank: int, fanout: int = 4096) -> tuple[int, int] | None:
    """Value at a 0-based rank of an integer column, and how many rows lie below that value.

    Counts rows in at most ``fanout`` equal slices and narrows to the slice that holds the rank;
    each round is one scan with a small aggregate. NULLs count as the smallest; None when the rank
    falls among them.
    """
    low, high, below = df.agg(
        F.min(column), F.max(column), F.count_if(F.col(column).isNull())
    ).first()
    if rank < below:
        return None
    while low < high:
        width = -(-(high - low + 1) // fanout)
        slices = (
            df.filter(F.col(column).between(low, high))
            .groupBy(floor_div(F.col(column) - F.lit(low), width).alias("slice"))
            .count()
            .collect()
        )
        for row in sorted(slices, key=lambda r: r["slice"]):
            if below + row["count"] > rank:
                start = low + row["slice"] * width
                low, high = start, min(high, start + width - 1)
                break
            below += row["count"]
    return low, below


def _rows_before(df: DataFrame, ts: str, tie: str | None, rank: int) -> Column | None:
    """Predicate that holds for exactly the first ``rank`` rows; None when ties hide the border."""
    found = _nth_value(df, ts, rank)
    if found is None:
        return None
    value, below = found
    earlier = F.col(ts).isNull() | (F.col(ts) < value)
    if below == rank:
        return earlier
    if tie is None:
        return None
    same = F.col(ts).eqNullSafe(F.lit(value))
    found = _nth_value(df.filter(same), tie, rank - below)
    if found is None or below + found[1] != rank:
        raise ValueError(f"'{tie}' does not tell rows of {ts} = {value} apart")
    return earlier | (same & (F.col(tie) < found[0]))


def split_positions(total: int, test_size: float, val_size: float) -> tuple[int, int]:
    """Row numbers where validation and test begin."""
    return int(total * (1 - test_size - val_size)), int(total * (1 - test_size))


def split_by_time(
    df: DataFrame,
    test_size: float = 0.15,
    val_size: float = 0.15,
    ts: str = "timestamp",
    tie: str | None = None,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Chronological train, validation and test frames by row position.

    The two border timestamps are found by counting, so the parts are plain filters on ``ts``
    that reach the scan and nothing is sorted or shuffled. Rows that share a border timestamp are
    told apart by ``tie``, a unique integer column; without one they are numbered by a row index.
    """
    total = df.count()
    first, second = split_positions(total, test_size, val_size)
    if total == 0:
        return df, df, df
    borders = [
        F.lit(True) if rank >= total else _rows_before(df, ts, tie, rank) for rank in (first, second)
    ]
    if any(border is None for border in borders):
        numbered = with_row_index(df, (ts,))
        borders = [F.col(INDEX) < first, F.col(INDEX) < second]
        parts = _three_parts(numbered, *borders)
        return tuple(part.drop(INDEX) for part in parts)
    return _three_parts(df, *borders)


def _three_parts(df: DataFrame, in_train: Column, in_train_or_val: Column):
    return (
        df.filter(in_train),
        df.filter(all_of([~in_train, in_train_or_val])),
        df.filter(~in_train_or_val),
    )


def split_label(
    df: DataFrame,
    test_size: float = 0.15,
    val_size: float = 0.15,
    ts: str = "timestamp",
    tie: str | None = None,
) -> DataFrame:
    """The same split as one frame with a ``split`` column."""
    train, val, test = split_by_time(df, test_size, val_size, ts, tie)
    return (
        train.withColumn("split", F.lit("train"))
        .unionByName(val.withColumn("split", F.lit("val")))
        .unionByName(test.withColumn("split", F.lit("test")))
    )


def sequences(
    df: DataFrame,
    features: list[str],
    target: str,
    length: int,
    keys: tuple[str, ...] = (),
    index: str = INDEX,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Training sequences of an indexed frame: rows [i, i+length) as ``x``, row i+length as ``y``.

    ``x`` is an array of feature arrays in float precision. A frame of n rows gives n - length
    sequences. The output is ``length`` times the input by definition; write it, do not cache it.
    """
    row = F.array(*[F.col(c).cast("float") for c in features])
    w = block_window(keys, index).rowsBetween(-length, -1)
    blocks = in_row_blocks(
        df.select(*keys, index, row.alias("_x"), F.col(target).cast("float").alias("y")),
        length,
        index,
        block_rows,
        keys,
    )
    windows = only_home(blocks.withColumn("x", F.collect_list("_x").over(w)))
    return windows.filter(F.size("x") == length).select(
        *keys, (F.col(index) - length).alias("start_idx"), "x", "y"
    )


def sequence_blocks(
    df: DataFrame,
    features: list[str],
    target: str,
    length: int,
    keys: tuple[str, ...] = (),
    index: str = INDEX,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """The sequences of an indexed frame as blocks of rows: each row once, and a look-back per block.

    A block holds ``x`` and ``y`` of rows ``first_idx``, first_idx + 1, ...; those from position ``home`` on end a
    sequence here. Stored rows are at most a quarter more than the frame's, whatever the length; a group
    is a block of a bounded number of rows. :func:`map_sequences` and :func:`read_sequences` slice.
    """
    row = F.array(*[F.col(c).cast("float") for c in features])
    narrow = df.select(*keys, index, row.alias("_x"), F.col(target).cast("float").alias("_y"))
    blocks = in_row_blocks(narrow, length, index, block_rows, keys)
    entry = F.struct(F.col(index).alias("i"), (~F.col(_HOME)).cast("int").alias("back"), F.col("_x").alias("x"), F.col("_y").alias("y"))
    packed = blocks.groupBy(*keys, _BLOCK).agg(F.array_sort(F.collect_list(entry)).alias("r"))
    stored = packed.select(
        *keys,
        F.get("r.i", F.lit(0)).alias("first_idx"),
        F.aggregate("r.back", F.lit(0), lambda a, b: a + b).alias("home"),
        F.col("r.x").alias("x"),
        F.col("r.y").alias("y"),
    )
    # a block of look-back rows only ends no sequence
    return stored.filter(F.col("home") < F.size("y"))


def map_sequences(
    blocks: DataFrame, length: int, apply: Callable, schema: str, keys: tuple[str, ...] = (), at_once: int = 256
) -> DataFrame:
    """Apply a function to the sequences of stored blocks, some at a time.

    ``apply(start_idx, x, y)`` gets arrays of n, (n, length, features) and n values and returns columns by
    name; ``x`` is a view of the block, so nothing is copied per sequence. ``schema`` names the keys first.
    """
    names = [part.split()[0] for part in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                y = np.array(batch.column("y")[k].values)
                x = np.array(batch.column("x")[k].values.flatten()).reshape(len(y), -1)
                first, home = batch.column("first_idx")[k].as_py(), batch.column("home")[k].as_py()
                own = {c: batch.column(c)[k] for c in keys}
                start = max(home, length)
                if start >= len(y):
                    continue
                # window p holds rows p, ..., p + length - 1
                windows = np.lib.stride_tricks.sliding_window_view(x, length, axis=0).swapaxes(1, 2)
                for low in range(start, len(y), at_once):
                    ends = np.arange(low, min(low + at_once, len(y)))
                    made = apply(first + ends - length, windows[low - length : ends[-1] + 1 - length], y[ends])
                    columns = {**{c: pa.array([v.as_py()] * len(ends), v.type) for c, v in own.items()}, **made}
                    yield pa.RecordBatch.from_arrays([pa.array(columns[n]) for n in names], names)

    return blocks.mapInArrow(run, schema)


def read_sequences(blocks: DataFrame, length: int, keys: tuple[str, ...] = ()) -> DataFrame:
    """The rows of :func:`sequences` from stored blocks; written out they are ``length`` times as large."""

    def nested(start: np.ndarray, x: np.ndarray, y: np.ndarray) -> dict:
        n, width = len(start), x.shape[2]
        rows = pa.ListArray.from_arrays(pa.array(np.arange(n * length + 1, dtype="i4") * width), pa.array(x.reshape(-1)))
        return {"start_idx": start, "x": pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype="i4") * length), rows), "y": y}

    kinds = "".join(f"{c} {blocks.schema[c].dataType.simpleString()}, " for c in keys)
    return map_sequences(blocks, length, nested, f"{kinds}start_idx long, x array<array<float>>, y float", keys)


def preview(df: DataFrame, rows: int = 5) -> DataFrame:
    """First rows, for a look at a frame."""
    return df.limit(rows)
