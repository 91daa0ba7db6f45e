"""Trie of conversation prefixes, built as burst tries.

A conversation is a sequence of turns; each distinct sequence of its first turns is a node. Nodes near the
root have very many members and few siblings, deep ones few members; so both are built in their own way.

Heads. All suffixes start in the container under the root. A container with more than ``CONTAINER_TURNS``
turns bursts: its suffixes move to new containers by their next turn id. A round bursts several levels at
once (8, then 16, 32, ... further ones), so deep shared beginnings take few rounds, and each row is looked at
in one round only. What is burst are the trie heads; they are counted by partial aggregation, so a node with
a third of all conversations is no single task.

Containers. The remaining containers are bounded. Each is sorted and swept: neighbours in the order share a
beginning, nodes close when it ends. A closed node knows its members, children, leaves and saved tokens.

Sums over the subtrees of heads come from running sums along the smallest member of each node, cut in blocks
of turns, so that neither a deep trie nor a very long conversation is walked in one task.

Turn ids are 128-bit hashes of (role, text). A node's key is a pair of 48-bit sums of its turn ids mixed with
their positions, so it is a prefix sum, and the parent's key is the key less the last term.

Defined results: rows without conv_id take no part; NULL role or text is empty; turns are ordered by turn
(NULL first), then role, then text; rows repeated whole are turns of their own; an empty table gives an empty
one; other columns are ignored, whatever their names. Texts of any length are only hashed and measured.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidegauge.llm import base

# Most turns (and members) of a container that is swept in one task.
CONTAINER_TURNS = 8192
# Levels that the first round of bursts looks at; each further round twice as many.
FIRST_LEVELS = 8
# Turns of a conversation whose running sums are made in one group.
BLOCK_TURNS = 1 << 14
_KEY = (1 << 48) - 1
_PLACE_BITS = 33
# The contract: up to HEAD_KINDS - 1 turns come from the first of HEAD_FAMILY ids.
HEAD_FAMILY = 100
HEAD_KINDS = 6

NODE = "ka long, kb long, pka long, pkb long, depth long, conv_id long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string, head boolean"


def placed_turns(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(turns, pieces): the turns in order with their place in a sort partition, and the pieces of
    conversations by partition with the number of turns before them.

    The range sort cuts a very long conversation like everything else. Texts go no further than this sort.
    """
    empty = F.lit("")
    rows = df.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", F.coalesce("role", empty).alias("role"), F.coalesce("text", empty).alias("text")
    )
    order = ["conv_id", "turn", "role", "text"]
    placed = rows.repartitionByRange(*order).sortWithinPartitions(*order).select(
        "conv_id",
        F.xxhash64("role", "text").alias("ta"),
        F.xxhash64(F.lit("second"), "role", "text").alias("tb"),
        F.char_length("text").cast("long").alias("chars"),
        F.monotonically_increasing_id().alias("place"),
    )
    turns = base.stage_table(placed.withColumn("part", F.shiftright("place", _PLACE_BITS)), "turns")
    pieces = turns.groupBy("conv_id", "part").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("rows"))
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return turns, pieces.withColumn("before", F.coalesce(F.sum("rows").over(before), F.lit(0)))


def _numbered(turns: DataFrame, pieces: DataFrame) -> DataFrame:
    return turns.join(pieces, ["conv_id", "part"]).withColumn("pos", F.col("place") - F.col("first") + F.col("before"))


def sequences(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows, conversations) as they are: (conv_id, n, d, ta, tb, chars) with d from 1, and (conv_id, n)."""
    turns, pieces = placed_turns(df)
    convs = base.stage_table(pieces.groupBy("conv_id").agg(F.sum("rows").alias("n")), "conversations")
    rows = _numbered(turns, pieces.join(convs, "conv_id"))
    return rows.select("conv_id", "n", (F.col("pos") + 1).alias("d"), "ta", "tb", "chars"), convs


def rebuilt(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows, conversations) where the first h turns are those of the family's first conversation.

    h is the checksum of the decimal id modulo ``HEAD_KINDS``, a family ``HEAD_FAMILY`` neighbouring ids. The
    conversation's own turns follow after its first h, which it loses.
    """
    turns, pieces = placed_turns(df)
    family = F.col("conv_id") - F.col("conv_id") % HEAD_FAMILY
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEAD_KINDS
    lengths = pieces.groupBy("conv_id").agg(F.sum("rows").alias("own")).withColumns({"h": h, "family": family})
    lengths = base.stage_table(lengths, "lengths")
    firsts = lengths.select(F.col("conv_id").alias("family"), F.col("own").alias("family_turns"))
    lead = F.least("h", F.coalesce("family_turns", F.lit(0)))
    convs = lengths.join(firsts, "family", "left").withColumn("lead", lead)
    convs = convs.withColumn("n", F.col("lead") + F.greatest(F.col("own") - F.col("h"), F.lit(0))).select("conv_id", "family", "h", "lead", "n")
    convs = base.stage_table(convs, "conversations")
    own = _numbered(turns, pieces.join(convs, "conv_id")).filter("pos >= h")
    own = own.select("conv_id", "n", (F.col("pos") - F.col("h") + F.col("lead") + 1).alias("d"), "ta", "tb", "chars")
    heads = _numbered(turns.filter(F.col("conv_id") == family), pieces).filter(F.col("pos") < HEAD_KINDS - 1)
    heads = heads.select(F.col("conv_id").alias("family"), "pos", "ta", "tb", "chars")
    shared = convs.filter("lead > 0").join(heads, "family").filter("pos < lead")
    shared = shared.select("conv_id", "n", (F.col("pos") + 1).alias("d"), "ta", "tb", "chars")
    return own.unionByName(shared), convs.select("conv_id", "n")


def running_sums(rows: DataFrame, columns: list[str], backwards: bool = False) -> DataFrame:
    """``columns`` become sums over a conversation's rows up to (or from) each row, in blocks of turns.

    Only conversations longer than a block need the sums of their other blocks.
    """
    block = F.floor(F.col("d") / BLOCK_TURNS)
    blocked = rows.withColumn("block", block)
    order = F.col("d").desc() if backwards else F.col("d")
    so_far = Window.partitionBy("conv_id", "block").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    summed = blocked.withColumns({c: F.sum(c).over(so_far) for c in columns})
    long = blocked.filter(F.col("n") >= BLOCK_TURNS)
    wide = [F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in columns]
    totals = long.groupBy("conv_id", "block").agg(*wide)
    order = F.col("block").desc() if backwards else F.col("block")
    others = Window.partitionBy("conv_id").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    mask = F.lit(_KEY + 1).cast("decimal(38,0)")
    offsets = totals.select(
        "conv_id", "block",
        *[(F.sum(c).over(others) % mask if c in ("ka", "kb") else F.sum(c).over(others)).cast("long").alias(f"more_{c}") for c in columns],
    )
    offsets = base.stage_table(offsets.dropna(), "block-sums")
    number = offsets.count()
    if not number:
        return summed.drop("block")
    joined = summed.join(base.broadcast_if_small(offsets, number), ["conv_id", "block"], "left")
    added = {c: F.col(c) + F.coalesce(f"more_{c}", F.lit(0)) for c in columns}
    return joined.withColumns(added).drop("block", *[f"more_{c}" for c in columns])


def with_keys(rows: DataFrame) -> DataFrame:
    """Rows with the key of the node they end (ka, kb) and of its parent (pka, pkb)."""
    a = F.xxhash64("d", "ta", "tb").bitwiseAND(F.lit(_KEY))
    b = F.xxhash64(F.lit("second"), "d", "ta", "tb").bitwiseAND(F.lit(_KEY))
    mixed = rows.select("conv_id", "n", "d", "chars", a.alias("a"), b.alias("b"), a.alias("ka"), b.alias("kb"))
    summed = running_sums(mixed, ["ka", "kb"])
    wrapped = {k: F.col(k).bitwiseAND(F.lit(_KEY)) for k in ("ka", "kb")}
    parents = {f"p{k}": (F.col(k) - F.col(t)).bitwiseAND(F.lit(_KEY)) for k, t in (("ka", "a"), ("kb", "b"))}
    return summed.withColumns(wrapped).withColumns(parents).drop("a", "b")


def burst(turns: DataFrame, container_turns: int) -> DataFrame | None:
    """The rows whose nodes are heads: the containers under them hold too many turns and members."""
    parts, active, start, levels = [], None, 0, FIRST_LEVELS
    node = ["d", "ka", "kb"]
    while True:
        end = start + levels
        seen = turns.filter((F.col("d") > start) & (F.col("d") <= end))
        if active is not None:
            seen = seen.join(base.broadcast_if_small(active, active.count()), "conv_id", "left_semi")
        sizes = seen.groupBy(*node).agg(F.sum(F.col("n") - F.col("d") + 1).alias("size"))
        over = base.stage_table(sizes.filter(F.col("size") > container_turns).select(*node), "oversized")
        number = over.count()
        if not number:
            break
        rows = base.stage_table(seen.join(base.broadcast_if_small(over, number), node, "left_semi"), "heads")
        parts.append(rows)
        active = base.stage_table(rows.filter((F.col("d") == end) & (F.col("n") > end)).select("conv_id"), "active")
        if active.isEmpty():
            break
        start, levels = end, 2 * levels
    found = None
    for part in parts:
        found = part if found is None else found.unionByName(part)
    return found


class _Open:
    """A node whose members are not all seen yet."""

    __slots__ = ("key", "ends", "children")

    def __init__(self, key: tuple[int, int, int]) -> None:
        self.key, self.ends, self.children = key, [], []


def ends_digest(ids: list[int]) -> str:
    return hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()


def _close(node: _Open, depth: int, out: list[list]) -> list:
    """The row of a node (in the order of NODE, without its parent); its children learn their parent."""
    ka, kb, chars = node.key
    n = len(node.ends) + sum(c[7] for c in node.children)
    conv = min(node.ends[:1] + [c[5] for c in node.children])
    leaves = sum(c[9] for c in node.children) or 1
    saved = (n - 1) * chars + sum(c[10] for c in node.children)
    for child in node.children:
        child[6] = conv
    out.extend(node.children)
    return [ka, kb, None, None, depth, conv, None, n, len(node.children), leaves, saved, ends_digest(node.ends), False]


def sweep(suffixes: list[tuple[list[tuple[int, int, int]], int]], depth: int) -> list[list]:
    """Nodes of one container: ``suffixes`` are (path of (ka, kb, chars) from the head on, conv_id)."""
    out: list[list] = []
    stack: list[_Open] = []
    before: list = []
    for path, conv in [*sorted(suffixes), ([], None)]:
        shared = 0
        for a, b in zip(before, path):
            if a != b:
                break
            shared += 1
        while len(stack) > shared:
            closed = _close(stack.pop(), depth + len(stack), out)
            if stack:
                stack[-1].children.append(closed)
            else:
                closed[-1] = True
                out.append(closed)
        stack.extend(map(_Open, path[shared:]))
        if path:
            stack[-1].ends.append(conv)
        before = path
    return out


def swept(rest: DataFrame) -> DataFrame:
    """Nodes of all containers; ``rest`` are the rows below the heads. A container is a bounded group."""
    first = Window.partitionBy("conv_id").orderBy("d").rowsBetween(Window.unboundedPreceding, 0)
    head = {f"h{c}": F.first(c).over(first) for c in ("ka", "kb", "pka", "pkb", "d")}
    order = ["hka", "hkb", "hd"]
    rows = rest.withColumns(head).select(*order, "hpka", "hpkb", "conv_id", "d", "ka", "kb", "chars")
    dealt = rows.repartition(*order).sortWithinPartitions(*order, "conv_id", "d")
    schema = pa.schema([(f.split()[0], {"long": pa.int64(), "string": pa.string(), "boolean": pa.bool_()}[f.split()[1]]) for f in NODE.split(", ")])

    def nodes_of(container: tuple, suffixes: list) -> list[list]:
        depth, pka, pkb = container[2:]
        rows = sweep(suffixes, depth)
        rows[-1][2:4] = pka, pkb
        return rows

    def batch_of(rows: list[list]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        container, conv, suffixes, out = None, None, [], []
        for batch in batches:
            for *now, conv_id, _, ka, kb, chars in zip(*[c.to_pylist() for c in batch.columns]):
                if now != container:
                    if suffixes:
                        out.extend(nodes_of(container, suffixes))
                    if len(out) > 10_000:
                        yield batch_of(out)
                        out = []
                    container, conv, suffixes = now, None, []
                if conv_id != conv:
                    conv = conv_id
                    suffixes.append(([], conv))
                suffixes[-1][0].append((ka, kb, chars))
        if suffixes:
            out.extend(nodes_of(container, suffixes))
        if out:
            yield batch_of(out)

    return dealt.mapInArrow(run, NODE)


def head_ends(ended: DataFrame) -> DataFrame:
    """(d, ka, kb, ends_sha256) of heads where conversations end.

    The ids of a node are sorted and joined to long strings in many tasks; only the digest itself, which is
    sequential by nature, reads a node's strings in one, as a stream.
    """
    node = ["d", "ka", "kb"]
    ordered = ended.select(*node, "conv_id").repartitionByRange(*node, "conv_id").sortWithinPartitions(*node, "conv_id")

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: dict[tuple, list[int]] = {}
            for d, ka, kb, conv in zip(*[c.to_pylist() for c in batch.columns]):
                rows.setdefault((d, ka, kb), []).append(conv)
            columns = [*zip(*rows)] or [[], [], []]
            texts = [",".join(map(str, ids)) for ids in rows.values()]
            ids = [ids[0] for ids in rows.values()]
            yield pa.RecordBatch.from_arrays([*[pa.array(c, pa.int64()) for c in (*columns, ids)], pa.array(texts, pa.string())], [*node, "conv_id", "ids"])

    strings = ordered.mapInArrow(joined, "d long, ka long, kb long, conv_id long, ids string")
    dealt = strings.repartition(*node).sortWithinPartitions(*node, "conv_id")

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, digest = None, None

        def row() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([*[pa.array([v], pa.int64()) for v in now], pa.array([digest.hexdigest()])], [*node, "ends_sha256"])

        for batch in batches:
            for d, ka, kb, _, ids in zip(*[c.to_pylist() for c in batch.columns]):
                if (d, ka, kb) != now:
                    if now is not None:
                        yield row()
                    now, digest = (d, ka, kb), hashlib.sha256(ids.encode())
                else:
                    digest.update(b"," + ids.encode())
        if now is not None:
            yield row()

    return dealt.mapInArrow(digests, "d long, ka long, kb long, ends_sha256 string")


def head_nodes(heads: DataFrame, containers: DataFrame) -> DataFrame:
    """Nodes of the burst part, the root with depth 0 among them; the parent's conv_id is still open."""
    node = ["d", "ka", "kb"]
    counted = heads.groupBy(*node).agg(
        F.count(F.lit(1)).alias("n_convs"),
        F.min("conv_id").alias("conv_id"),
        *[F.max(c).alias(c) for c in ("chars", "pka", "pkb")],
    )
    below = containers.filter("head").select((F.col("depth") - 1).alias("d"), "pka", "pkb", "conv_id", "n_leaves", "saved_tokens")
    counted = base.stage_table(counted, "head-counts")
    children = counted.filter("d > 0").select((F.col("d") - 1).alias("d"), "pka", "pkb").unionByName(below.select("d", "pka", "pkb"))
    children = children.groupBy("d", F.col("pka").alias("ka"), F.col("pkb").alias("kb")).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = base.stage_table(counted.join(children, node, "left").fillna(0, ["n_children"]), "head-nodes")
    # every node's own part stands at its smallest member; sums from there to the root reach all ancestors
    own = nodes.select("conv_id", "d", (F.col("n_children") == 0).cast("long").alias("n_leaves"), ((F.col("n_convs") - 1) * F.col("chars")).alias("saved_tokens"))
    parts = own.unionByName(below.select("conv_id", "d", "n_leaves", "saved_tokens"))
    parts = parts.groupBy("conv_id", "d").agg(F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens"))
    along = heads.select("conv_id", "n", *node).join(parts, ["conv_id", "d"], "left").fillna(0, ["n_leaves", "saved_tokens"])
    below_each = running_sums(along, ["n_leaves", "saved_tokens"], backwards=True)
    sums = below_each.groupBy(*node).agg(F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens"))
    ends = head_ends(heads.filter("d = n"))
    nothing = F.lit(ends_digest([]))
    whole = nodes.join(sums, node).join(ends, node, "left").withColumn("ends_sha256", F.coalesce("ends_sha256", nothing))
    return whole.select("ka", "kb", "pka", "pkb", F.col("d").alias("depth"), "conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def trie(rows: DataFrame, convs: DataFrame, container_turns: int = CONTAINER_TURNS) -> DataFrame:
    """One row per node: its key and its parent's, depth, conv_id (smallest member), parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens, ends_sha256. The last turn of a node is turn ``depth`` of ``conv_id``."""
    turns = base.stage_table(with_keys(rows), "keyed-turns")
    burst_rows = burst(turns, container_turns)
    zero = F.lit(0).cast("long")
    nothing = F.lit(None).cast("long")
    roots = convs.select("conv_id", "n", zero.alias("d"), zero.alias("chars"), zero.alias("ka"), zero.alias("kb"), nothing.alias("pka"), nothing.alias("pkb"))
    rest, heads = turns, roots
    if burst_rows is not None:
        rest = turns.join(burst_rows.select("conv_id", "d"), ["conv_id", "d"], "left_anti")
        heads = roots.unionByName(burst_rows)
    containers = base.stage_table(swept(rest), "containers")
    upper = base.stage_table(head_nodes(heads, containers), "upper")
    parents = upper.select(
        F.col("ka").alias("pka"), F.col("kb").alias("pkb"), (F.col("depth") + 1).alias("depth"), F.col("conv_id").alias("parent_conv_id")
    )
    parents = base.broadcast_if_small(parents, parents.count())
    tops = upper.unionByName(containers.filter("head").select(upper.columns)).join(parents, ["pka", "pkb", "depth"], "left")
    columns = ["ka", "kb", "pka", "pkb", "depth", "conv_id", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return tops.select(columns).unionByName(containers.filter("NOT head").select(columns))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes = trie(*rebuilt(base.read(spark, sf_dir, "conversations")))
    return nodes.drop("ka", "kb", "pka", "pkb")


SQL = f"""
WITH turns AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) - 1 AS pos
  FROM conversations WHERE conv_id IS NOT NULL
),
step AS (
  SELECT range AS n, list_reduce(list_prepend(range, range(8)),
    lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v
  FROM range(256)
),
crc AS (SELECT list(v ORDER BY n) AS t FROM step),
ids AS (
  SELECT DISTINCT conv_id,
    list_transform(regexp_extract_all(hex(encode(conv_id::VARCHAR)), '..'), lambda h: ('0x' || h)::BIGINT) AS b
  FROM turns
),
convs AS (
  SELECT conv_id, conv_id - conv_id % {HEAD_FAMILY} AS family,
    xor(list_reduce(list_prepend(4294967295::BIGINT, b),
      lambda c, x: xor(t[(xor(c, x) & 255) + 1], c >> 8)), 4294967295) % {HEAD_KINDS} AS h
  FROM ids, crc
),
built AS (
  SELECT c.conv_id, 0 AS part, pos, role, text FROM convs c JOIN turns t ON t.conv_id = c.family AND pos < h
  UNION ALL
  SELECT c.conv_id, 1, pos, role, text FROM convs c JOIN turns t ON t.conv_id = c.conv_id AND pos >= h
),
paths AS (
  SELECT c.conv_id, coalesce(list({{'r': role, 't': text}} ORDER BY part, pos) FILTER (role IS NOT NULL), []) AS s
  FROM convs c LEFT JOIN built b ON b.conv_id = c.conv_id GROUP BY c.conv_id
),
members AS (SELECT conv_id, d, s[1:d] AS p, d = len(s) AS ends FROM (SELECT conv_id, s, unnest(range(len(s) + 1)) AS d FROM paths)),
nodes AS (
  SELECT p, d, min(conv_id) AS conv_id, count(*) AS n_convs,
    CASE WHEN d = 0 THEN 0 ELSE (count(*) - 1) * length(p[d].t) END AS saved,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
  FROM members GROUP BY p, d
),
linked AS (
  SELECT a.*, b.conv_id AS parent_conv_id FROM nodes a LEFT JOIN nodes b ON a.d = b.d + 1 AND a.p[1:a.d - 1] = b.p
),
families AS (SELECT d - 1 AS d, p[1:d - 1] AS p, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY ALL),
counted AS (SELECT l.*, coalesce(n_children, 0) AS n_children FROM linked l LEFT JOIN families f ON l.d = f.d AND l.p = f.p),
above AS (SELECT saved, n_children, unnest(range(d + 1)) AS up, p FROM counted),
sums AS (
  SELECT up AS d, p[1:up] AS p, sum(saved)::BIGINT AS saved_tokens, count(*) FILTER (n_children = 0) AS n_leaves
  FROM above GROUP BY ALL
)
SELECT conv_id, c.d AS depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256
FROM counted c JOIN sums s ON c.d = s.d AND c.p = s.p
"""
