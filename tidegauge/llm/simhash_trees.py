"""Near-duplicates by SimHash: fingerprints within a few bits of each other, found with vantage-point trees.

A fingerprint has a bit for each bit of the shingles' 64-bit hashes: 1 if it is set in over half of them.
Equal fingerprints are one point. A tree splits points by their Hamming distance to a vantage point: near
ones go inside, the others outside. Points that link differ by at most ``MOST_BITS`` in their distance to any
vantage point (triangle bound), so a point deep inside or far outside needs only its own side; one close to
the border also visits the other side.

The upper tree is fitted on a bounded sample (``SAMPLE`` points) and deals all points to shards: each point
has one home, and those near a border visit further shards. A shard is a group of its own, in which a further
tree is built over the homes and all visitors search it, down to leaves where distances are computed at once.
Where no vantage point separates the points (very many within a few bits of each other) distances are computed
tile by tile. Shards that are too large are dealt to blocks of homes and of visitors, so that no group
grows with the table; every pair still meets. Only a spanning set of the links found leaves a group, and
components of the links are found by alternating stars.

Defined results: a text without words (NULL too) has fingerprint zero and is linked like any other; rows
repeated whole, or with one id and several texts, are points of their own; a row without id takes no part and gets a
NULL component; an empty table gives an empty one; other columns are ignored, whatever their names. Very long
texts are hashed in pieces.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.llm import base
from tidegauge.llm.components import components

WORDS = 3
SEED = 42
# Fingerprints link at this many differing bits or fewer.
MOST_BITS = 2
# Points the upper tree is fitted on, homes a shard should have, and most shards.
SAMPLE = 1 << 17
SHARD_HOMES = 1 << 14
MOST_SHARDS = 1 << 13
# Most homes and most visitors of a group; larger shards are dealt to blocks.
GROUP_HOMES = 1 << 16
GROUP_VISITORS = 1 << 18
# Leaf of a shard's tree; candidates for a vantage point and the points they are tried on.
LEAF = 192
TRIED = 8
TRIED_ON = 256
# A split must take away at least a tenth of the comparisons.
WORTH = 0.9
_PIECE = 1 << 16
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def shingle_hashes(text: str, words: int = WORDS) -> Iterator[np.ndarray]:
    """XXH64 of the shingles of a text, repeats included, in pieces of bounded size."""
    # bytes split at exactly 0x20 and 0x09-0x0D
    found = text.encode().translate(_LOWER).split()
    if not found:
        return
    if len(found) < words:
        shingles: Iterator[bytes] = iter([b" ".join(found)])
    else:
        shingles = map(b" ".join, zip(*(islice(found, k, None) for k in range(words))))
    hash_of = xxhash.xxh64_intdigest
    while True:
        piece = np.fromiter((hash_of(s, SEED) for s in islice(shingles, _PIECE)), "u8")
        if not len(piece):
            return
        yield piece


def fingerprint(text: str) -> int:
    """Unsigned 64-bit fingerprint; zero without words."""
    ones, number = np.zeros(64, "i8"), 0
    for piece in shingle_hashes(text):
        ones += np.unpackbits(piece.view("u1").reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype="i8")
        number += len(piece)
    return int(np.packbits(2 * ones > number, bitorder="little").view("u8")[0])


def fingerprints(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, point): the fingerprint as a signed long, one row per input row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points = np.fromiter((fingerprint(t.as_py()) for t in batch.column(1)), "u8", batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(points.view("i8"))], ["doc_id", "point"])

    return base.id_and_text(df, doc_id, text).mapInArrow(run, "doc_id long, point long")


def distance(points: np.ndarray, vantage: np.uint64) -> np.ndarray:
    return np.bitwise_count(points ^ vantage).astype("i2")


def choose_split(points: np.ndarray) -> tuple[np.uint64, int] | None:
    """(vantage point, radius): inside are points up to the radius; None if no radius separates them.

    Of a few points spread over the array the one is taken whose border costs the fewest visits for an even
    split; the radius is the cheapest between the first and the last quarter.
    """
    tried = points[np.linspace(0, len(points) - 1, min(TRIED, len(points))).astype(int)]
    on = points[np.linspace(0, len(points) - 1, min(TRIED_ON, len(points))).astype(int)]
    best = None
    for vantage in tried:
        often = np.bincount(distance(on, vantage), minlength=65 + MOST_BITS)
        inside = np.cumsum(often)[:65] / len(on)
        # both sides, and the points that visit the other one
        border = np.array([often[max(0, r + 1 - MOST_BITS) : r + 1 + MOST_BITS].sum() for r in range(65)]) / len(on)
        cost = inside**2 + (1 - inside) ** 2 + border
        cost[(inside <= 0) | (inside >= 1)] = np.inf
        radius = int(np.argmin(cost))
        if np.isfinite(cost[radius]) and (best is None or cost[radius] < best[0]):
            best = cost[radius], vantage, radius
    return None if best is None else (best[1], best[2])


def sides(homes: np.ndarray, visitors: np.ndarray, vantage: np.uint64, radius: int) -> tuple[tuple, tuple]:
    """(homes, visitors) as positions for the inside and the outside.

    A pair whose two homes part here is met once: the homes of the side with fewer points near the border
    visit the other side.
    """
    far, away = distance(homes, vantage), distance(visitors, vantage)
    inside = far <= radius
    leaving, entering = inside & (far > radius - MOST_BITS), ~inside & (far <= radius + MOST_BITS)
    if leaving.sum() <= entering.sum():
        entering = np.zeros(len(homes), bool)
    else:
        leaving = np.zeros(len(homes), bool)
    inner = np.flatnonzero(inside), np.flatnonzero(entering), np.flatnonzero(away <= radius + MOST_BITS)
    outer = np.flatnonzero(~inside), np.flatnonzero(leaving), np.flatnonzero(away > radius - MOST_BITS)
    return inner, outer


def compare(left: np.ndarray, right: np.ndarray | None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Linked pairs between two arrays, or inside one, tile by tile."""
    tile = 1024
    for i in range(0, len(left), tile):
        a = left[i : i + tile, None]
        for j in range(0 if right is not None else i, len(left if right is None else right), tile):
            b = (left if right is None else right)[j : j + tile]
            at, to = np.nonzero(np.bitwise_count(a ^ b) <= MOST_BITS)
            if right is None and i == j:
                at, to = at[at < to], to[at < to]
            if len(at):
                yield a[at, 0], b[to]


def linked_pairs(homes: np.ndarray, visitors: np.ndarray, among_homes: bool = True) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All linked pairs of distinct points between homes and visitors and, if asked, among the homes (exact)."""
    open_nodes = [(homes, visitors)]
    while open_nodes:
        own, guests = open_nodes.pop()
        if not len(own) or not (len(guests) or among_homes):
            continue
        half = len(own) / 2 if among_homes else 0
        split = choose_split(own) if len(own) > LEAF else None
        if split is not None:
            parts = []
            for at_homes, at_crossing, at_guests in sides(own, guests, *split):
                crossing = own[at_crossing] if among_homes else own[:0]
                parts.append((own[at_homes], np.concatenate([crossing, guests[at_guests]])))
            if sum(len(h) * ((len(h) / 2 if among_homes else 0) + len(g)) for h, g in parts) < WORTH * len(own) * (half + len(guests)):
                open_nodes.extend(parts)
                continue
        if among_homes:
            yield from compare(own, None)
        yield from compare(guests, own)


class Forest:
    """Spanning links of the points seen: pairs that join nothing new are left out."""

    def __init__(self, points: np.ndarray) -> None:
        self.points = np.sort(points)
        self.parent = np.arange(len(points))
        self.links: list[tuple[np.ndarray, np.ndarray]] = []

    def _roots(self, at: np.ndarray) -> np.ndarray:
        up = self.parent[at]
        while (up != (further := self.parent[up])).any():
            up = further
        return up

    def add(self, left: np.ndarray, right: np.ndarray) -> None:
        a, b = np.searchsorted(self.points, left), np.searchsorted(self.points, right)
        while len(a):
            root_a, root_b = self._roots(a), self._roots(b)
            apart = root_a != root_b
            a, b, root_a, root_b = a[apart], b[apart], root_a[apart], root_b[apart]
            low, high = np.minimum(root_a, root_b), np.maximum(root_a, root_b)
            # one link for each root that moves; roots only move to smaller ones, so there are no cycles
            moved, chosen = np.unique(high, return_index=True)
            self.parent[moved] = low[chosen]
            if len(chosen):
                self.links.append((self.points[a[chosen]], self.points[b[chosen]]))
            self.parent = self.parent[self.parent]


def fit_tree(sample: np.ndarray, shards: int) -> list[tuple]:
    """The upper tree: nodes (vantage, radius, inside, outside) or (shard number,), the root first.

    The node with the most sample points is split next, until there are enough shards.
    """
    nodes: list[tuple] = [(0,)]
    leaves, count = {0: sample}, 1
    while count < shards and leaves:
        at = max(leaves, key=lambda k: len(leaves[k]))
        own = leaves.pop(at)
        split = choose_split(own) if len(own) > 1 else None
        if split is None:
            continue
        inside = distance(own, split[0]) <= split[1]
        # a border that nearly all points cross separates nothing
        if min(inside.sum(), (~inside).sum()) * 16 < len(own):
            continue
        nodes += [nodes[at], (count,)]
        nodes[at] = (*split, len(nodes) - 2, len(nodes) - 1)
        leaves |= {len(nodes) - 2: own[inside], len(nodes) - 1: own[~inside]}
        count += 1
    return nodes


def deal(tree: list[tuple], points: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(shard, position of the point, is a visitor) for a batch: each point's home and the shards it visits."""
    out = []
    nothing = np.empty(0, int)
    open_nodes = [(0, np.arange(len(points)), nothing)]
    while open_nodes:
        at, homes, visitors = open_nodes.pop()
        if len(tree[at]) == 1:
            for rows, visits in ((homes, False), (visitors, True)):
                out.append((np.full(len(rows), tree[at][0]), rows, np.full(len(rows), visits)))
            continue
        vantage, radius, *below = tree[at]
        far, away = distance(points[homes], vantage), distance(points[visitors], vantage)
        # inside homes visit the outside; here the direction must not depend on the batch
        leaving = (far <= radius) & (far > radius - MOST_BITS)
        inner = homes[far <= radius], visitors[away <= radius + MOST_BITS]
        outer = homes[far > radius], np.concatenate([homes[leaving], visitors[away > radius - MOST_BITS]])
        for node, (own, guests) in zip(below, (inner, outer)):
            if len(own) or len(guests):
                open_nodes.append((node, own, guests))
    return tuple(np.concatenate(c) if c else nothing for c in zip(*out)) if out else (nothing, nothing, nothing.astype(bool))


def shards(points: DataFrame, shard_homes: int = SHARD_HOMES) -> DataFrame:
    """(shard, point, visits) of all points; ``points`` has one distinct point a row and is stored."""
    number = points.count()
    wanted = min(MOST_SHARDS, math.ceil(number / shard_homes))
    tree: list[tuple] = [(0,)]
    if wanted > 1:
        # a fixed number of points in hash order; the tree only decides where points meet
        sample = points.orderBy(F.xxhash64("point"), "point").limit(SAMPLE).collect()
        tree = fit_tree(np.array([r["point"] for r in sample], "i8").view("u8"), wanted)
    shared = points.sparkSession.sparkContext.broadcast(tree)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.column(0).to_numpy().view("u8")
            shard, at, visits = deal(shared.value, own)
            yield pa.RecordBatch.from_arrays([pa.array(shard.astype("i4")), pa.array(own[at].view("i8")), pa.array(visits.astype(bool))], ["shard", "point", "visits"])

    return points.mapInArrow(run, "shard int, point long, visits boolean")


def in_groups(dealt: DataFrame, group_homes: int = GROUP_HOMES, group_visitors: int = GROUP_VISITORS) -> DataFrame:
    """(shard, home_block, visit_block, point, visits): every shard as one or more groups of bounded size.

    The homes of a block also visit the later blocks of their shard; visitors are dealt to blocks, each of
    which meets every block of homes. Homes compare among each other in the first block of visitors.
    """
    visits = F.col("visits").cast("long")
    sizes = dealt.groupBy("shard").agg(F.sum(1 - visits).alias("homes"), F.sum(visits).alias("guests"))
    # one row per shard, at most MOST_SHARDS
    sizes = sizes.select(
        "shard",
        F.greatest(F.ceil(F.col("homes") / group_homes), F.lit(1)).alias("home_blocks"),
        F.greatest(F.ceil((F.col("guests") + F.col("homes")) / group_visitors), F.lit(1)).alias("visit_blocks"),
    )
    rows = dealt.join(F.broadcast(sizes), "shard")
    home = F.pmod(F.xxhash64("point"), F.col("home_blocks"))
    visit = F.pmod(F.xxhash64(F.lit("visit"), "point"), F.col("visit_blocks"))
    numbered = rows.withColumns({"home": home, "visit": visit})

    zero, last_home = F.lit(0).cast("long"), F.col("home_blocks") - 1
    own = numbered.filter("NOT visits").select("shard", F.col("home").alias("home_block"), F.explode(F.sequence(zero, F.col("visit_blocks") - 1)).alias("visit_block"), "point", F.lit(False).alias("visits"))
    later = numbered.filter("home_blocks > 1 OR visits").withColumn("from", F.when(F.col("visits"), zero).otherwise(F.col("home") + 1)).filter(F.col("from") <= last_home)
    guests = later.select("shard", F.explode(F.sequence("from", last_home)).alias("home_block"), F.col("visit").alias("visit_block"), "point", F.lit(True).alias("visits"))
    return own.unionByName(guests)


def group_links(groups: DataFrame) -> DataFrame:
    """Spanning links (a, b) of every group, searched with a tree of its own."""

    def run(table: pa.Table) -> pa.Table:
        points = table.column("point").to_numpy().view("u8")
        visits = table.column("visits").to_numpy(zero_copy_only=False)
        first = table.column("visit_block")[0].as_py() == 0
        homes, visitors = points[~visits], points[visits]
        forest = Forest(points)
        # in later blocks of visitors the homes were compared with each other before
        for a, b in linked_pairs(homes, visitors, first):
            forest.add(a, b)
        sides_ = [np.concatenate([pair[k] for pair in forest.links] or [np.empty(0, "u8")]).view("i8") for k in (0, 1)]
        return pa.table({"a": pa.array(sides_[0]), "b": pa.array(sides_[1])})

    return groups.groupBy("shard", "home_block", "visit_block").applyInArrow(run, "a long, b long")


def links(points: DataFrame, shard_homes: int = SHARD_HOMES) -> DataFrame:
    """Links (a, b) between distinct points that reach everything all links reach."""
    dealt = base.stage_table(shards(points, shard_homes), "shards")
    return group_links(in_groups(dealt))


def near_groups(df: DataFrame, doc_id: str = "doc_id", text: str = "text", shard_homes: int = SHARD_HOMES) -> DataFrame:
    """One row per input row: doc_id, point (signed fingerprint), component_id (smallest doc_id reachable)."""
    docs = base.stage_table(fingerprints(df, doc_id, text), "points")
    known = docs.filter(F.col("doc_id").isNotNull())
    points = base.stage_table(known.groupBy("point").agg(F.min("doc_id").alias("lead"), F.count(F.lit(1)).alias("docs")), "distinct-points")
    found = base.stage_table(links(points.select("point"), shard_homes), "links")
    groups = components(found).withColumnRenamed("node", "point")
    placed = points.join(groups, "point", "left").withColumn("component", F.coalesce("component", "point"))
    least = placed.groupBy("component").agg(F.min("lead").alias("component_id"))
    named = base.stage_table(placed.join(least, "component").select("point", "docs", "component_id"), "named-points")
    # points with a two-thousandth of all rows are few; the others are no hot key
    hot = named.filter(F.col("docs") * 2000 > F.lit(known.count())).select("point", F.col("component_id").alias("hot_component"))
    marked = docs.join(F.broadcast(hot), "point", "left")
    nobody = F.col("doc_id").isNull() | F.col("hot_component").isNotNull()
    out = [F.col("doc_id"), F.col("point")]
    done = marked.filter(nobody).select(*out, F.when(F.col("doc_id").isNotNull(), F.col("hot_component")).alias("component_id"))
    rest = marked.filter(~nobody).join(named.select("point", "component_id"), "point").select(*out, "component_id")
    return done.unionByName(rest)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = near_groups(base.read(spark, sf_dir, "documents"))
    return groups.select("doc_id", F.lower(F.lpad(F.hex("point"), 16, "0")).alias("fingerprint"), "component_id")
