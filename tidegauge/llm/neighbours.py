"""Approximate nearest neighbours by stable projections and kd-trees.

Vectors are scaled to length one and projected to ``PROJECTED`` Gaussian coordinates. The squared
projected distance of two vectors over their squared distance follows the chi-square distribution, so
projected neighbours are verified one after the other in growing projected distance until that distribution
makes a nearer vector unlikely: the next projected distance exceeds the ``CONFIDENCE`` quantile times the
squared distance of the neighbours found so far. A kd-tree hands them out in that order: leaves are opened as
their boxes come near, and a point is verified once no closed leaf can hold one before it.

Over the cluster, the projected space is cut into cells by a kd-tree on a bounded sample; all vectors
are placed in their cell and every cell builds its own kd-tree. A query first searches its home cell.
The distance found there, with the same test, tells which other cells it still has to search. A cell with very many
vectors is cut into parts with a tree each, one with very many queries is searched in several groups.

Equal vectors are one entry with the smallest ids of its copies, as many as a result can need, so groups
of copies cost one entry and lose no result.

Defined results: NULL, empty and zero vectors and those with NULL or non-finite components take no part,
nor do rows without id; vectors are compared with those of the same length only; rows that repeat an id
count as one per vector; with fewer candidates all are returned; an empty table gives an empty one; other
columns are ignored, whatever their names.
"""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidegauge.llm import base

NEIGHBOURS = 5
PROJECTED = 16
CONFIDENCE = 0.93
SEED = 11
CELL_ROWS = 4096
LEAF_ROWS = 32
# Rows of the sample for each cell it cuts, and the most cells; beyond that, cells are cut into parts.
SAMPLE_PER_CELL = 16
MOST_CELLS = 1 << 14
# Queries searched together in one cell; more are split.
CELL_QUERIES = 20_000
# Leaves opened at once, and points verified between two stopping tests: at first, and at most as these double.
OPENED, MOST_OPENED = 4, 32
VERIFIED, MOST_VERIFIED = 16, 256


def chi_square_quantile(share: float, freedom: int) -> float:
    """Inverse of the chi-square distribution function for an even number of degrees of freedom."""
    low, high = 0.0, 1000.0
    for _ in range(200):
        x = (low + high) / 2
        tail = math.exp(-x / 2) * sum((x / 2) ** k / math.factorial(k) for k in range(freedom // 2))
        low, high = (x, high) if 1 - tail < share else (low, x)
    return high


@lru_cache(maxsize=8)
def projection(length: int, seed: int = SEED) -> np.ndarray:
    return np.random.default_rng([seed, length]).standard_normal((length, PROJECTED))


def projected(vectors: np.ndarray) -> np.ndarray:
    norms = np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))
    return (vectors / norms) @ projection(vectors.shape[1])


def kd_leaves(points: np.ndarray, leaf_rows: int) -> list[np.ndarray]:
    """Row numbers of the leaves of a kd-tree: halved at the median of the widest coordinate."""
    leaves, todo = [], [np.arange(len(points))]
    while todo:
        rows = todo.pop()
        if len(rows) <= leaf_rows:
            leaves.append(rows)
            continue
        own = points[rows]
        axis = int(np.argmax(own.max(axis=0) - own.min(axis=0)))
        order = np.argpartition(own[:, axis], len(rows) // 2)
        todo += [rows[order[: len(rows) // 2]], rows[order[len(rows) // 2 :]]]
    return leaves


def kd_cells(sample: np.ndarray, cells: int) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper borders of cells that cut the whole space, about as many as asked for."""
    width = sample.shape[1]
    done, todo = [], [(sample, np.full(width, -np.inf), np.full(width, np.inf), cells)]
    while todo:
        points, low, high, wanted = todo.pop()
        spread = points.max(axis=0) - points.min(axis=0) if len(points) else np.zeros(width)
        axis = int(np.argmax(spread))
        if wanted <= 1 or len(points) < 2 or spread[axis] == 0:
            done.append((low, high))
            continue
        cut = float(np.median(points[:, axis]))
        below = points[:, axis] < cut
        if not below.any():  # the median is the least value
            cut = float(points[points[:, axis] > cut, axis].min())
            below = points[:, axis] < cut
        high_below, low_above = high.copy(), low.copy()
        high_below[axis] = low_above[axis] = cut
        todo += [(points[below], low, high_below, wanted // 2), (points[~below], low_above, high, wanted - wanted // 2)]
    return np.array([d[0] for d in done]), np.array([d[1] for d in done])


def squared_gaps(point: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Squared distance of a point to each box."""
    gap = np.maximum(np.maximum(low - point, point - high), 0)
    return (gap * gap).sum(axis=1)


class CellIndex:
    """kd-tree over one cell's projected vectors."""

    def __init__(self, vectors: np.ndarray):
        self.vectors = vectors
        self.norms = np.sqrt((vectors * vectors).sum(axis=1))
        self.points = projected(vectors)
        self.leaves = kd_leaves(self.points, LEAF_ROWS)
        self.low = np.array([self.points[r].min(axis=0) for r in self.leaves])
        self.high = np.array([self.points[r].max(axis=0) for r in self.leaves])
        self.verified = 0

    def search(self, vector: np.ndarray, point: np.ndarray, wanted: int, quantile: float, bound: float) -> tuple[np.ndarray, np.ndarray]:
        """Entries and scores of the best found; ``bound`` is a squared distance known to be enough."""
        gaps = squared_gaps(point, self.low, self.high)
        order = np.argsort(gaps, kind="stable")
        norm = math.sqrt(float((vector * vector).sum()))
        rows, scores = np.empty(0, "i8"), np.empty(0)
        waiting, distances = np.empty(0, "i8"), np.empty(0)
        opened, step, share = 0, OPENED, VERIFIED
        while True:
            closed = gaps[order[opened]] if opened < len(order) else np.inf
            nearest_waiting = distances[0] if len(waiting) else np.inf
            if min(closed, nearest_waiting) > quantile * bound or (closed == np.inf and not len(waiting)):
                break  # the stopping test
            if closed <= nearest_waiting:
                new = np.concatenate([self.leaves[k] for k in order[opened : opened + step]])
                opened, step = opened + step, min(2 * step, MOST_OPENED)
                apart = self.points[new] - point
                waiting, distances = np.concatenate([waiting, new]), np.concatenate([distances, (apart * apart).sum(axis=1)])
                first = np.argsort(distances, kind="stable")
                waiting, distances = waiting[first], distances[first]
                continue
            # those before the next closed leaf and within the test, a few at a time
            ready = min(share, int(np.searchsorted(distances, min(closed, quantile * bound), "right")))
            new, waiting, distances = waiting[:ready], waiting[ready:], distances[ready:]
            self.verified, share = self.verified + ready, min(2 * share, MOST_VERIFIED)
            found = (self.vectors[new] * vector).sum(axis=1) / (self.norms[new] * norm)
            rows, scores = np.concatenate([rows, new]), np.concatenate([scores, found])
            if len(rows) > wanted:
                # equal scores at the border all stay: ids decide later
                least = np.partition(scores, len(scores) - wanted)[len(scores) - wanted]
                keep = scores >= least
                rows, scores = rows[keep], scores[keep]
            if len(rows) >= wanted:
                bound = min(bound, max(0.0, 2 - 2 * float(scores.min())))
        return rows, scores


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).astype("f8").reshape(len(flat), -1)


def usable_vectors(df: DataFrame, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """vec_id and vector (in double precision) of the rows that take part."""
    plain = df.select(F.col(f"`{vec_id}`").cast("long").alias("vec_id"), F.col(f"`{vector}`").cast("array<double>").alias("vector"))
    usable = (
        F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
        & F.exists("vector", lambda x: x != 0)
    )
    return plain.filter(F.col("vec_id").isNotNull() & F.col("vector").isNotNull()).filter(usable).distinct()


def entries(valid: DataFrame, copies: int) -> DataFrame:
    """One row per different vector: vector, ids (the smallest of its copies, ``copies`` at most)."""
    # the limit is also applied before the shuffle, so a hot vector sends a few rows per task
    same = Window.partitionBy("vector").orderBy("vec_id")
    few = valid.withColumn("copy", F.row_number().over(same)).filter(F.col("copy") <= copies)
    return few.groupBy("vector").agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))


def _with_cells(rows: DataFrame, lows: dict, highs: dict, ask: bool, quantile: float) -> DataFrame:
    """Add ``cell``: the one cell of a vector, or (``ask``) all cells a query with ``bound`` must still search."""

    def make():
        def apply(batch: pa.RecordBatch) -> pa.RecordBatch:
            vectors = batch.column("vector")
            bounds = batch.column("bound").to_pylist() if ask else None
            home = batch.column("cell").to_pylist() if ask else None
            at, cells = [], []
            lists = vectors.to_pylist()
            points: list = [None] * len(lists)
            for length in {len(v) for v in lists}:
                rows_ = [k for k, v in enumerate(lists) if len(v) == length]
                for k, own in zip(rows_, projected(np.array([lists[k] for k in rows_]))):
                    points[k] = own
            for k, point in enumerate(points):
                low, high = lows[len(lists[k])], highs[len(lists[k])]
                if ask:
                    near = np.flatnonzero(squared_gaps(point, low, high) <= quantile * bounds[k])
                    near = near[near != home[k]]
                else:
                    near = np.flatnonzero(((point >= low) & (point < high)).all(axis=1))[:1]
                at += [k] * len(near)
                cells += near.tolist()
            taken = batch.take(pa.array(at, pa.int64()))
            columns = {n: c for n, c in zip(taken.schema.names, taken.columns)} | {"cell": pa.array(cells, pa.int32())}
            return pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

        return apply

    fields = {f.name: f.dataType.simpleString() for f in rows.schema} | {"cell": "int"}
    return base.map_batches(rows, make, ", ".join(f"{n} {t}" for n, t in fields.items()))


def _search(vectors: DataFrame, queries: DataFrame, wanted: int, quantile: float) -> DataFrame:
    """Search each query in the cell it is sent to: (query_id, vector, cell, ids, score, bound).

    Entries found come with ``ids`` and ``score``; each query also gives a row with NULL ids that
    carries the squared distance within which it has found enough. A group is one part of a cell's vectors and
    one chunk of its queries.
    """
    none = F.lit(None)
    where = ["cell", "length"]
    held = vectors.withColumn("length", F.size("vector"))
    asked = queries.withColumn("length", F.size("vector"))
    # at most a row per cell and length
    parts = held.groupBy(*where).agg(F.ceil(F.count(F.lit(1)) / (4 * CELL_ROWS)).alias("parts"))
    chunks = asked.groupBy(*where).agg(F.ceil(F.count(F.lit(1)) / CELL_QUERIES).alias("chunks"))
    groups = base.stage_table(chunks.join(parts, where), "cells")
    groups = base.broadcast_if_small(groups, groups.count())
    sides = held.join(groups, where).select(
        *where, "vector", "ids", none.cast("long").alias("query_id"), none.cast("double").alias("bound"),
        F.pmod(F.xxhash64("vector"), F.col("parts")).alias("part"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)).alias("chunk"),
    ).unionByName(
        asked.join(groups, where).select(
            *where, "vector", none.cast("array<bigint>").alias("ids"), "query_id", "bound",
            F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"),
            F.pmod(F.xxhash64("query_id"), F.col("chunks")).alias("chunk"),
        )
    )
    schema = pa.schema([("query_id", pa.int64()), ("cell", pa.int32()), ("ids", pa.list_(pa.int64())), ("score", pa.float64()), ("bound", pa.float64())])

    def run(table: pa.Table) -> pa.Table:
        is_query = np.array([q is not None for q in table.column("query_id").to_pylist()])
        asked, held = table.filter(pa.array(is_query)), table.filter(pa.array(~is_query))
        if not len(asked):
            return schema.empty_table()
        cell = asked.column("cell")[0].as_py()
        out: list[tuple] = []
        vectors = _matrix(asked.column("vector"))
        points = projected(vectors)
        index = CellIndex(_matrix(held.column("vector"))) if len(held) else None
        ids = held.column("ids").to_pylist()
        for query, bound, vector, point in zip(asked.column("query_id").to_pylist(), asked.column("bound").to_pylist(), vectors, points):
            if index is not None:
                rows, scores = index.search(vector, point, wanted, quantile, bound)
                out += [(query, cell, ids[r], float(s), None) for r, s in zip(rows.tolist(), scores)]
                if len(rows) >= wanted:
                    bound = min(bound, max(0.0, 2 - 2 * float(scores.min())))
            out.append((query, cell, None, None, bound))
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)

    return sides.groupBy(*where, "part", "chunk").applyInArrow(
        run, "query_id long, cell int, ids array<bigint>, score double, bound double"
    )


def nearest(
    df: DataFrame,
    queries: DataFrame,
    neighbours: int = NEIGHBOURS,
    confidence: float = CONFIDENCE,
    vec_id: str = "vec_id",
    vector: str = "embedding",
) -> DataFrame:
    """The nearest rows of ``df`` by cosine for every row of ``queries``, a row's own id left out.

    query_id, rank (from 1), vec_id, score; ties go to the smaller vec_id.
    """
    quantile = chi_square_quantile(confidence, PROJECTED)
    wanted = neighbours + 1  # a query finds itself, too
    stored = base.stage_table(entries(usable_vectors(df, vec_id, vector), wanted), "vectors")
    asked = usable_vectors(queries, vec_id, vector).select("vector", F.col("vec_id").alias("query_id"))
    sizes = {r["n"]: r["count"] for r in stored.groupBy(F.size("vector").alias("n")).count().collect()}
    total = max(1, sum(sizes.values()))
    cells = {length: min(MOST_CELLS, max(1, count // CELL_ROWS)) for length, count in sizes.items()}
    rows = SAMPLE_PER_CELL * sum(cells.values())
    sample = stored.orderBy(F.xxhash64("vector")).limit(rows) if total > rows else stored
    drawn: dict[int, list] = {}
    for row in sample.select("vector").toLocalIterator():
        drawn.setdefault(len(row["vector"]), []).append(row["vector"])
    lows, highs = {}, {}
    for length in sizes:
        points = projected(np.array(drawn[length])) if length in drawn else np.zeros((1, PROJECTED))
        lows[length], highs[length] = kd_cells(points, cells[length])
    placed = _with_cells(stored, lows, highs, False, quantile)
    at_home = _with_cells(asked.filter(F.size("vector").isin(list(sizes))), lows, highs, False, quantile)
    homes = base.stage_table(at_home.withColumn("bound", F.lit(float("inf"))), "queries")
    placed = base.stage_table(placed, "placed")
    first = base.stage_table(_search(placed, homes, wanted, quantile), "home-cells")
    # a query searched in several parts, or with repeated ids, keeps the least bound it knows
    answered = first.filter(F.col("ids").isNull()).groupBy("query_id").agg(F.min("bound").alias("bound"))
    bounds = homes.select("query_id").distinct().join(answered, "query_id", "left").select("query_id", F.coalesce("bound", F.lit(float("inf"))).alias("bound"))
    further = _with_cells(homes.drop("bound").join(bounds, "query_id"), lows, highs, True, quantile)
    found = first.unionByName(_search(placed, further, wanted, quantile)).filter(F.col("ids").isNotNull())
    pairs = found.select("query_id", F.explode("ids").alias("vec_id"), "score").filter(F.col("query_id") != F.col("vec_id"))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        pairs.withColumn("rank", F.row_number().over(best))
        .filter(F.col("rank") <= neighbours)
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = base.read(spark, sf_dir, "embeddings")
    return nearest(vectors, vectors.filter(F.col("vec_id") % 50 == 0))
