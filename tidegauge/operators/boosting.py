"""Gradient boosted regression trees on histograms.

Features are cut into bins at approximate quantiles, found in one aggregation; missing and non-finite values
have a bin of their own. Trees grow level by level. A level is one grouped aggregation: every task adds up
gradients and hessians of its rows per (node, feature, bin), the sums of all tasks are added, and the driver
picks the splits from a table whose size follows from nodes, features and bins, never from rows. Rows with a
missing feature take the side of a split on which they lower the loss more (learned for each split).

Squared loss. Regularised like the usual boosters: L1 (``alpha``) and L2 (``lambda_``) on leaf values, a
least sum of hessians per child (``min_child_weight``), a least gain of a split (``gamma``), rows and columns
sampled per tree by hash. Binned rows are stored once; the running prediction is stored again every
``STORE_EVERY`` trees, so a pass applies a bounded number of trees and a lost executor repeats little.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.functions.numbers import is_finite
from tidegauge.session import stored

MOST_BINS = 64
STORE_EVERY = 25
ROWS_PER_PART = 100_000
_ACCURACY = 10_000


@dataclass
class Settings:
    n_trees: int = 300
    max_depth: int = 5
    learning_rate: float = 0.08
    subsample: float = 0.9
    colsample: float = 0.9
    min_child_weight: float = 1.0
    gamma: float = 0.0
    alpha: float = 0.0
    lambda_: float = 1.0
    patience: int = 50
    seed: int = 42
    bins: int = MOST_BINS


@dataclass
class Split:
    """Rows of ``node`` with a bin up to ``bin`` go left; missing ones left if ``missing_left``."""

    node: int
    feature: int
    bin: int
    missing_left: bool
    gain: float


@dataclass
class Tree:
    """A binary heap of nodes: the children of k are 2k + 1 and 2k + 2; leaves have a value."""

    splits: dict[int, Split] = field(default_factory=dict)
    values: dict[int, float] = field(default_factory=dict)

    def place(self, bins: np.ndarray) -> np.ndarray:
        """The node each row (rows x features of bins, 0 missing) has come to."""
        at = np.zeros(len(bins), "i4")
        for node in sorted(self.splits):
            here = np.flatnonzero(at == node)
            split = self.splits[node]
            own = bins[here, split.feature]
            left = np.where(own == 0, split.missing_left, own <= split.bin)
            at[here] = 2 * node + np.where(left, 1, 2)
        return at

    def predict(self, bins: np.ndarray) -> np.ndarray:
        table = np.zeros(max([0, *self.values, *self.splits]) * 2 + 3)
        for node, value in self.values.items():
            table[node] = value
        return table[self.place(bins)]


def bin_edges(df: DataFrame, features: list[str], bins: int) -> list[np.ndarray]:
    """Inner borders of the bins of each feature, in one aggregation; equal quantiles are one border."""
    shares = F.array(*[F.lit(k / (bins - 1)) for k in range(1, bins - 1)])
    number = lambda c: F.when(is_finite(F.col(c).cast("double")), F.col(c).cast("double"))
    row = df.agg(*[F.percentile_approx(number(c), shares, _ACCURACY).alias(f"q{k}") for k, c in enumerate(features)]).first()
    return [np.unique(np.array(q if q else [], "f8")) for q in row]


def binned(values: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    """Bins from 1 on; a bin holds what is above the border before it and at or below its own; 0 is missing."""
    out = np.zeros(values.shape, "u1")
    for k, own in enumerate(edges):
        column = values[:, k]
        finite = np.isfinite(column)
        out[finite, k] = 1 + np.searchsorted(own, column[finite], "left")
    return out


def _shrunk(g: np.ndarray, alpha: float) -> np.ndarray:
    return np.sign(g) * np.maximum(np.abs(g) - alpha, 0.0)


def leaf_value(g: float, h: float, settings: Settings) -> float:
    return float(-_shrunk(np.float64(g), settings.alpha) / (h + settings.lambda_)) * settings.learning_rate


def best_split(node: int, g: np.ndarray, h: np.ndarray, columns: np.ndarray, settings: Settings) -> Split | None:
    """The split of largest gain from sums (features x bins, bin 0 missing); ties to the first feature and bin."""

    def score(a, b):
        return _shrunk(a, settings.alpha) ** 2 / np.maximum(b + settings.lambda_, 1e-300)

    total_g, total_h = g.sum(axis=1, keepdims=True), h.sum(axis=1, keepdims=True)
    left_g, left_h = np.cumsum(g[:, 1:], axis=1)[:, :-1], np.cumsum(h[:, 1:], axis=1)[:, :-1]
    gains = []
    for missing_left in (False, True):
        a = left_g + (g[:, :1] if missing_left else 0)
        b = left_h + (h[:, :1] if missing_left else 0)
        gain = 0.5 * (score(a, b) + score(total_g - a, total_h - b) - score(total_g, total_h)) - settings.gamma
        heavy = np.minimum(b, total_h - b) >= max(settings.min_child_weight, 1e-9)
        gains.append(np.where(heavy & columns[:, None], gain, -np.inf))
    both = np.stack(gains, axis=2)  # features x bins x direction
    if not both.size:
        return None
    at = int(np.argmax(np.round(both, 9)))
    feature, place, direction = np.unravel_index(at, both.shape)
    gain = float(both[feature, place, direction])
    return Split(node, int(feature), int(place) + 1, bool(direction), gain) if gain > 1e-9 else None


def drawn_columns(number: int, tree: int, settings: Settings) -> np.ndarray:
    """Flags of the columns a tree may use: those with the smallest hashes."""
    order = np.argsort([zlib.crc32(f"{settings.seed}:{tree}:{k}".encode()) for k in range(number)], kind="stable")
    flags = np.zeros(number, bool)
    flags[order[: max(1, int(settings.colsample * number))]] = True
    return flags


@dataclass
class Booster:
    """Fitted trees; ``transform`` adds the prediction."""

    features: list[str]
    edges: list[np.ndarray]
    base: float
    trees: list[Tree]

    def transform(self, df: DataFrame, prediction: str = "prediction") -> DataFrame:
        numbers = [F.col(f"`{c}`").cast("double") for c in self.features]
        rows = df.withColumn("_features", F.array(*[F.coalesce(n, F.lit(float("nan"))) for n in numbers]))
        names, model = list(df.columns), self
        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                values = np.array(batch.column("_features").flatten()).reshape(batch.num_rows, len(model.features))
                bins = binned(values, model.edges)
                found = model.base + sum(tree.predict(bins) for tree in model.trees)
                own = pa.array(np.broadcast_to(found, batch.num_rows))
                yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in names], own], [*names, prediction])

        return rows.mapInArrow(run, f"{schema}, `{prediction}` double")


_ROWS = "id long, validation boolean, target double, running double, bins binary"


def _binned_rows(df: DataFrame, features: list[str], target: str, validation: bool, edges, base: float) -> DataFrame:
    numbers = [F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(float("nan"))) for c in features]
    rows = df.select(F.col(f"`{target}`").cast("double").alias("target"), F.array(*numbers).alias("values"))
    rows = rows.filter(is_finite(F.col("target"))).withColumn("id", F.xxhash64("target", "values"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            values = np.array(batch.column("values").flatten()).reshape(n, len(features))
            packed = pa.array([row.tobytes() for row in binned(values, edges)], pa.binary())
            same = pa.array(np.full(n, base))
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(np.full(n, validation)), batch.column("target"), same, packed], [c.split()[0] for c in _ROWS.split(", ")])

    return rows.mapInArrow(run, _ROWS)


def _unpacked(batch: pa.RecordBatch, features: int) -> np.ndarray:
    # all rows have the same length, so the buffer of a batch is a matrix
    return np.frombuffer(b"".join(batch.column("bins").to_pylist()), "u1").reshape(batch.num_rows, features)


def _level(rows: DataFrame, trees: list[Tree], growing: Tree, open_nodes: list[int], columns: np.ndarray, tree: int, settings: Settings) -> pa.Table:
    """Sums (node, feature, bin, g, h) of the open nodes; node -1 holds the validation part's squared error.

    ``trees`` are those since the running prediction was stored.
    """
    number = len(columns)
    slot = np.full(2 ** (settings.max_depth + 2), -1)
    slot[open_nodes] = np.arange(len(open_nodes))
    width = settings.bins + 1
    kept = (np.uint64(settings.subsample * 2**32)) if settings.subsample < 1 else None
    mixed = np.uint64((settings.seed * 1_000_003 + tree) * 0x9E3779B97F4A7C15 % 2**64 | 1)
    names = ["node", "feature", "bin", "g", "h"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        g = np.zeros((len(open_nodes), number, width))
        h = np.zeros_like(g)
        error, counted = 0.0, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            bins = _unpacked(batch, number)
            residual = np.array(batch.column("running")) - np.array(batch.column("target"))
            for done in trees:
                residual = residual + done.predict(bins)
            validation = np.array(batch.column("validation"))
            error += float((residual[validation] ** 2).sum())
            counted += int(validation.sum())
            take = ~validation
            if kept is not None:
                take &= (np.array(batch.column("id")).view("u8") * mixed) >> np.uint64(32) < kept
            at = slot[growing.place(bins)]
            take &= at >= 0
            bins, at, residual = bins[take], at[take], residual[take]
            for f in np.flatnonzero(columns):
                place = at * width + bins[:, f]
                size = len(open_nodes) * width
                g[:, f] += np.bincount(place, residual, size).reshape(-1, width)
                h[:, f] += np.bincount(place, minlength=size).reshape(-1, width)
        node, feature, place = np.nonzero(h)
        found = np.array(open_nodes, "i4")[node], feature.astype("i4"), place.astype("i4"), g[node, feature, place], h[node, feature, place]
        extra = [[-1], [0], [0], [error], [float(counted)]]
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([a, np.array(b, a.dtype)])) for a, b in zip(found, extra)], names)

    sums = rows.mapInArrow(run, "node int, feature int, bin int, g double, h double")
    return sums.groupBy("node", "feature", "bin").agg(F.sum("g").alias("g"), F.sum("h").alias("h")).toArrow()


def _tables(found: pa.Table, node: int, features: int, bins: int) -> tuple[np.ndarray, np.ndarray]:
    own = found.filter(pa.compute.equal(found["node"], node))
    g, h = np.zeros((features, bins + 1)), np.zeros((features, bins + 1))
    at = own["feature"].to_numpy(), own["bin"].to_numpy()
    g[at], h[at] = own["g"].to_numpy(), own["h"].to_numpy()
    return g, h


def fit(train: DataFrame, validation: DataFrame, features: list[str], target: str, settings: Settings) -> Booster:
    """Boost until the validation error has not fallen for ``patience`` trees; keep the trees up to its least."""
    usable = train.filter(is_finite(F.col(f"`{target}`").cast("double")))
    edges = bin_edges(usable, features, settings.bins)
    head = usable.agg(F.avg(F.col(f"`{target}`").cast("double")), F.count(F.lit(1))).first()
    if not head[1]:
        raise ValueError("no row with a finite target is left to train on")
    base = float(head[0])
    both = _binned_rows(train, features, target, False, edges, base).unionByName(_binned_rows(validation, features, target, True, edges, base))
    parts = max(1, -(-head[1] // ROWS_PER_PART))
    rows = stored(both.coalesce(parts) if parts < 8 else both, "boosting/rows")
    trees: list[Tree] = []
    since: list[Tree] = []
    best, best_at = np.inf, 0
    for number in range(settings.n_trees + 1):
        tree, columns = Tree(), drawn_columns(len(features), number, settings)
        open_nodes = [0]
        for depth in range(settings.max_depth + 1):
            found = _level(rows, since, tree, open_nodes, columns, number, settings)
            if depth == 0:
                error = found.filter(pa.compute.equal(found["node"], -1))
                counted = error["h"].to_pylist()[0] if error.num_rows else 0
                loss = error["g"].to_pylist()[0] / counted if counted else 0.0
                if counted and loss < best - 1e-12 * abs(best if np.isfinite(best) else 1.0):
                    best, best_at = loss, number
                elif counted and number - best_at >= settings.patience:
                    return Booster(features, edges, base, trees[:best_at])
            if number == settings.n_trees:
                break
            following = []
            for node in open_nodes:
                g, h = _tables(found, node, len(features), settings.bins)
                # every feature has all rows of the node
                any_column = int(np.flatnonzero(columns)[0])
                sums = g[any_column].sum(), h[any_column].sum()
                split = best_split(node, g, h, columns, settings) if depth < settings.max_depth else None
                if split is None:
                    tree.values[node] = leaf_value(*sums, settings)
                else:
                    tree.splits[node] = split
                    following += [2 * node + 1, 2 * node + 2]
            open_nodes = following
            if not open_nodes:
                break
            if depth == settings.max_depth - 1:
                # the last level's sums follow from the splits' tables
                for node in open_nodes:
                    parent = tree.splits[(node - 1) // 2]
                    g, h = _tables(found, parent.node, len(features), settings.bins)
                    left = np.r_[parent.missing_left, np.arange(1, settings.bins + 1) <= parent.bin]
                    side = left if node % 2 else ~left
                    tree.values[node] = leaf_value(g[parent.feature][side].sum(), h[parent.feature][side].sum(), settings)
                break
        if number == settings.n_trees:
            break
        trees.append(tree)
        since.append(tree)
        if len(since) == STORE_EVERY:
            rows, since = stored(_advanced(rows, since, len(features)), "boosting/rows"), []
    return Booster(features, edges, base, trees[:best_at] if np.isfinite(best) else trees)


def _advanced(rows: DataFrame, trees: list[Tree], features: int) -> DataFrame:
    """The rows with the trees added to their running prediction."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bins = _unpacked(batch, features)
            running = np.array(batch.column("running")) + sum(tree.predict(bins) for tree in trees)
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(running), batch.column("bins")], batch.schema.names)

    return rows.mapInArrow(run, _ROWS)
