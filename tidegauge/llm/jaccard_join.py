"""Similarity self-join of documents on word shingles, with adaptive multi-match prefixes.

Two documents link when their sets of five-word shingles have a Jaccard similarity of at least 0.8. If
sets are sorted by one order of all shingles, rare ones first, then similar sets share at least ``l``
shingles within their first ``n - ceil(0.8 n) + l``, for any ``l``. A longer prefix costs more postings
but asks for more shared ones before a pair is verified; each document takes the length with the least
estimated cost, and a pair must share as many as the shorter of its two choices asks for.

Steps: (1) One pass counts shingles in a table of fixed size and gives every text a class, so that equal
sets are joined as one. (2) Prefixes in the order of that rough count: a document that shares too few of
them with any other class is similar to none and leaves. (3) For those that stay, shingles are counted
exactly, prefixes are chosen and posting lists formed. (4) Pairs from short lists are counted and those
with enough matches verified on the texts. Long lists, as groups of near copies make them, are cut in
blocks, and every pair of blocks is verified as a matrix product in a task of its own; only a spanning
set of links leaves it. (5) Links become components.

No pair is dropped: lists have no cap, only two ways to be worked through. Shingles are 64-bit hashes,
as are classes of equal sets. Shingles whose rough count is far above the mean are not counted exactly
but sorted last, so that counting never gathers a very frequent shingle in one task.

Links are between classes of equal sets, not between ids: an id may stand on rows with different texts.

Defined results: NULL texts and texts without words have no shingles and are linked with nothing; rows
that are repeated whole are one document; rows with one id and different texts are documents of their own; a
row without id takes no part and gets a NULL component; an empty table gives an empty one; other columns are
ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidegauge.llm import base
from tidegauge.llm.components import components
from tidegauge.llm.shingles import distinct, mix, shingle_hashes

# Similarity in percent.
SIMILARITY = 80
# Rough counts: a table of 2**SLOT_BITS counters, sent around in SLOT_BLOCKS pieces.
SLOT_BITS = 20
SLOT_BLOCKS = 64
# A shingle is very frequent when its counter is above this many times the mean and HOT_LEAST.
HOT_TIMES = 8
HOT_LEAST = 10_000
# Longest extension of a prefix, and the cost of verifying a candidate per shingle against one posting.
MOST_MATCHES = 8
VERIFY_COST = 0.25
# Lists up to this length are joined as pairs; longer ones are cut in blocks of so many documents.
SHORT_LIST = 64
BLOCK_DOCS = 512
_ODD = 0x9E3779B97F4A7C15
# Counter tables added up in one group; more tasks are added in rounds.
ADD_AT_ONCE = 128


def least_overlap(n):
    """Fewest shingles a set of n shares with any set similar to it: ceil(0.8 n)."""
    return (SIMILARITY * n + 99) // 100


def sift_matches(n):
    """Matches asked for in the first sieve: a twentieth of the least overlap, 1 at least."""
    return max(1, (least_overlap(n) + 19) // 20)


def similar(shared, n_a, n_b):
    return 100 * shared >= SIMILARITY * (n_a + n_b - shared)


def shingle_set(text: str) -> np.ndarray:
    return distinct(shingle_hashes(text))


def _class_of(hashes: np.ndarray) -> int:
    """64-bit hash of a set; positive, 0 for the empty set."""
    if not len(hashes):
        return 0
    # the hashes are well mixed already, so their sum tells sets apart
    total = hashes.sum(dtype="u8", keepdims=True)
    return int(mix(total * np.uint64(_ODD) + np.bitwise_xor.reduce(hashes))[0] >> np.uint64(1)) | 1


def _slot(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - SLOT_BITS)).astype("i8")


def survey(docs: DataFrame) -> DataFrame:
    """One pass over the texts: rows (doc_id, text_a, text_b, n, class) and, per task, its counters in pieces.

    ``text_a`` and ``text_b`` are a 128-bit hash that tells the texts of a repeated id apart.
    """
    base.small_batches(docs.sparkSession)
    longs = ["doc_id", "text_a", "text_b", "n", "class"]
    schema = pa.schema([*[(c, pa.int64()) for c in longs], ("task", pa.int64()), ("piece", pa.int32()), ("counts", pa.binary())])
    hashed = docs.select("doc_id", "text", *[h.alias(c) for c, h in zip(longs[1:3], base.hash128(F.col("text")))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base.give_back()
        counters = np.zeros(1 << SLOT_BITS, "i8")
        for batch in batches:
            sets = [shingle_set(t) for t in batch.column(1).to_pylist()]
            if not sets:
                continue
            counters += np.bincount(_slot(np.concatenate(sets)), minlength=1 << SLOT_BITS)
            nothing = [pa.nulls(len(sets), f.type) for f in list(schema)[5:]]
            numbers = [pa.array([len(s) for s in sets], pa.int64()), pa.array([_class_of(s) for s in sets], pa.int64())]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), batch.column(3), *numbers, *nothing], schema=schema)
        if counters.any():
            pieces = [p.tobytes() for p in np.split(counters, SLOT_BLOCKS)]
            nothing = [pa.nulls(SLOT_BLOCKS, pa.int64())] * 5
            task = pa.array([TaskContext.get().partitionId()] * SLOT_BLOCKS, pa.int64())
            yield pa.RecordBatch.from_arrays([*nothing, task, pa.array(range(SLOT_BLOCKS), pa.int32()), pa.array(pieces, pa.binary())], schema=schema)

    return hashed.mapInArrow(run, ", ".join(f"{c} long" for c in longs) + ", task long, piece int, counts binary")


def rough_counts(surveyed: DataFrame) -> np.ndarray:
    """Sum of the tasks' counters; the driver gets a table of fixed size.

    Tables are added ``ADD_AT_ONCE`` at a time, so a group stays the same size however many tasks there were.
    """

    def add(table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(c.as_py(), "i8") for c in table.column("counts"))
        first = {c: table.column(c)[:1] for c in ("task", "piece")}
        return pa.table({**first, "counts": pa.array([total.tobytes()], pa.binary())})

    pieces = surveyed.filter(F.col("piece").isNotNull()).select("task", "piece", "counts")
    tasks = pieces.agg(F.max("task")).first()[0]
    while tasks is not None:
        pieces = pieces.withColumn("task", F.floor(F.col("task") / ADD_AT_ONCE))
        pieces = pieces.groupBy("piece", "task").applyInArrow(add, "task long, piece int, counts binary")
        tasks //= ADD_AT_ONCE
        if not tasks:
            break
        pieces = base.stage_table(pieces, "counters")
    counts = np.zeros((SLOT_BLOCKS, (1 << SLOT_BITS) // SLOT_BLOCKS), "i8")
    for row in pieces.collect() if tasks is not None else []:
        counts[row["piece"]] = np.frombuffer(row["counts"], "i8")
    return counts.reshape(-1)


def _hot_above(counts: np.ndarray) -> int:
    return int(max(HOT_LEAST, HOT_TIMES * counts.mean()))


def sieve(docs: DataFrame, counts: np.ndarray) -> DataFrame:
    """Classes that share enough of their prefix with other classes to be similar to one.

    The first prefix is sorted by rough count, then hash. A set similar to one of n shingles has at least
    ``least_overlap(n)`` of them and shows as many matches as that size asks for.
    """
    hot_above = _hot_above(counts)
    table = docs.sparkSession.sparkContext.broadcast(counts)  # of fixed size
    names = ["hash", "class", "wanted", "counted", "hot"]

    def make():
        rough = table.value

        def apply(batch: pa.RecordBatch) -> pa.RecordBatch:
            out: list[list[np.ndarray]] = [[np.empty(0, k)] for k in ("i8", "i8", "i8", "?", "?")]
            for text in batch.column(1).to_pylist():
                own = shingle_set(text)
                n = len(own)
                if not n:
                    continue
                count = rough[_slot(own)]
                spare = n - least_overlap(n)
                # the set is sorted by hash, so a stable sort leaves ties in that order
                first = np.argsort(count, kind="stable")[: spare + sift_matches(n)]
                wanted = sift_matches(least_overlap(n))
                size = len(first)
                row = own[first].view("i8"), np.full(size, _class_of(own)), np.full(size, wanted)
                for column, values in zip(out, (*row, np.arange(size) < spare + wanted, count[first] > hot_above)):
                    column.append(values)
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in out], names)

        return apply

    postings = base.map_batches(docs, make, "hash long, class long, wanted long, counted boolean, hot boolean")
    # a very frequent shingle counts as shared without gathering its rows
    spread = F.when(F.col("hot"), F.col("class")).otherwise(F.lit(0))
    same = Window.partitionBy("hash", "spread")
    found = (
        postings.withColumn("spread", spread)
        .withColumns({"least": F.min("class").over(same), "most": F.max("class").over(same)})
        .filter("(hot OR least < most) AND counted")
        .select("hash", "class", "wanted")
    )
    matches = found.groupBy("class").agg(F.count_distinct("hash").alias("matches"), F.first("wanted").alias("wanted"))
    return matches.filter("matches >= wanted").select("class")


def choose_length(n: int, frequencies: np.ndarray) -> tuple[int, int]:
    """(matches to ask for, shared shingles in that prefix) with the least estimated cost; (0, 0): no partner.

    ``frequencies`` are those of the shingles that other sets hold, too, in order; all others come first.
    """
    spare, alone = n - least_overlap(n), n - len(frequencies)
    if alone > spare:
        return 0, 0
    most = min(MOST_MATCHES, least_overlap(n))
    ends = spare - alone + np.arange(1, most + 1)
    postings = np.cumsum(frequencies - 1)[np.minimum(ends, len(frequencies)) - 1]
    matches = np.arange(1, most + 1)
    # a candidate uses up as many postings as it must share
    best = int(np.argmin(postings * (1 + VERIFY_COST * n / matches)))
    return best + 1, int(min(ends[best], len(frequencies)))


def _sets_of(texts: list[str], classes: list[int]) -> list[np.ndarray | None]:
    """Shingle sets of texts; None where the text is not of the class its id stands for (a repeated id)."""
    sets = [shingle_set(t) for t in texts]
    return [s if _class_of(s) == c else None for s, c in zip(sets, classes)]


def posting_lists(docs: DataFrame, counts: np.ndarray) -> DataFrame:
    """(hash, doc, n, matches) for the chosen prefix of every class; ``docs`` holds (doc_id: its class, text, class)."""
    hot_above = _hot_above(counts)
    table = docs.sparkSession.sparkContext.broadcast(counts)

    def make():
        rough = table.value

        def apply(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = _sets_of(batch.column("text").to_pylist(), batch.column("class").to_pylist())
            sets = [np.empty(0, "u8") if s is None else s for s in found]
            sizes = [len(s) for s in sets]
            flat = np.concatenate(sets)
            ids = np.repeat(batch.column("doc_id").to_numpy(), sizes)
            columns = [flat.view("i8"), ids, np.repeat(sizes, sizes), rough[_slot(flat)] > hot_above]
            return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["hash", "doc", "n", "hot"])

        return apply

    rows = base.map_batches(docs, make, "hash long, doc long, n long, hot boolean")
    very_often = 1 << 40
    spread = F.when(F.col("hot"), F.col("doc")).otherwise(F.lit(0))
    number = F.count(F.lit(1)).over(Window.partitionBy("hash", "spread"))
    counted = rows.withColumn("spread", spread).withColumn("often", F.when(F.col("hot"), very_often).otherwise(number))
    # the shared shingles of one document
    per_doc = (
        counted.filter("often > 1")
        .groupBy("doc", "n")
        .agg(F.array_sort(F.collect_set(F.struct("often", "hash"))).alias("shared"))
        .select("doc", "n", F.col("shared.often").alias("often"), F.col("shared.hash").alias("hashes"))
    )

    def make_choice():
        def apply(batch: pa.RecordBatch) -> pa.RecordBatch:
            out: list[list[np.ndarray]] = [[np.empty(0, "i8")] for _ in range(4)]
            for doc, n, often, hashes in zip(*[c.to_pylist() for c in batch.columns]):
                matches, length = choose_length(n, np.array(often, "i8"))
                if matches:
                    values = np.array(hashes[:length], "i8"), *(np.full(length, v, "i8") for v in (doc, n, matches))
                    for column, own in zip(out, values):
                        column.append(own)
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in out], ["hash", "doc", "n", "matches"])

        return apply

    return base.map_batches(per_doc, make_choice, "hash long, doc long, n long, matches long")


def short_pairs(lists: DataFrame) -> DataFrame:
    """Pairs (a, b) that share enough shingles of short lists."""
    left = lists.select("hash", F.col("doc").alias("a"), F.col("n").alias("n_a"), F.col("matches").alias("l_a"))
    right = lists.select("hash", F.col("doc").alias("b"), F.col("n").alias("n_b"), F.col("matches").alias("l_b"))
    sizes_fit = (100 * F.col("n_a") >= SIMILARITY * F.col("n_b")) & (100 * F.col("n_b") >= SIMILARITY * F.col("n_a"))
    pairs = left.join(right, "hash").filter((F.col("a") < F.col("b")) & sizes_fit)
    shared = pairs.groupBy("a", "b").agg(F.count(F.lit(1)).alias("shared"), F.first(F.least("l_a", "l_b")).alias("wanted"))
    return shared.filter("shared >= wanted").select("a", "b")


def verify_pairs(pairs: DataFrame, docs: DataFrame) -> DataFrame:
    """The pairs that are similar, checked on their texts: each text ``a`` is followed by its partners."""
    asked = pairs.select(F.col("a").alias("lead"), F.col("b").alias("doc_id"))
    asked = asked.unionAll(pairs.select(F.col("a").alias("lead"), F.col("a").alias("doc_id")).distinct())
    partner = F.col("lead") != F.col("doc_id")
    texts = docs.join(asked, "doc_id").select("lead", partner.alias("partner"), "doc_id", "text", "class")
    ordered = texts.repartition("lead").sortWithinPartitions("lead", "partner", "doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, own_lead = np.empty(0, "u8"), None
        for batch in batches:
            links = []
            leads, partners, docs_, texts_, classes = [c.to_pylist() for c in batch.columns]
            for lead, partner, doc, hashes in zip(leads, partners, docs_, _sets_of(texts_, classes)):
                if hashes is None:
                    continue
                if not partner:
                    own, own_lead = hashes, lead
                elif lead == own_lead:
                    shared = len(np.intersect1d(own, hashes, assume_unique=True))
                    if similar(shared, len(own), len(hashes)):
                        links.append((lead, doc))
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (zip(*links) if links else ([], []))], ["a", "b"])

    base.small_batches(docs.sparkSession)
    return ordered.mapInArrow(run, "a long, b long")


def spanning_links(sets: list[np.ndarray], sides: np.ndarray) -> list[tuple[int, int]]:
    """A spanning set of the links between the two sides (or inside one): positions, no cycle.

    Overlaps are a product of 0/1 matrices over the shingles that several sets hold, column by column.
    """
    sizes = np.array([len(s) for s in sets])
    flat, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes)
    _, column, often = np.unique(flat, return_inverse=True, return_counts=True)
    several = often[column] > 1
    number = np.cumsum(often > 1) - 1
    rows, columns = owner[several], number[column[several]]
    order = np.argsort(columns, kind="stable")
    rows, columns = rows[order], columns[order]
    overlap = np.zeros((len(sets), len(sets)), "f4")
    width = 4096
    for start in range(0, int(columns[-1]) + 1 if len(columns) else 0, width):
        low, high = np.searchsorted(columns, [start, start + width])
        held = np.zeros((len(sets), width), "f4")
        held[rows[low:high], columns[low:high] - start] = 1
        overlap += held @ held.T
    linked = similar(overlap.astype("f8"), sizes[:, None], sizes[None, :])
    linked &= (sides[:, None] != sides[None, :]) | (sides.max() == sides.min())
    parent = list(range(len(sets)))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    links = []
    for a, b in zip(*(k.tolist() for k in np.nonzero(np.triu(linked, 1)))):
        root_a, root_b = root(a), root(b)
        if root_a != root_b:
            parent[max(root_a, root_b)] = min(root_a, root_b)
            links.append((a, b))
    return links


def block_links(lists: DataFrame, docs: DataFrame) -> DataFrame:
    """Links (a, b) inside long lists; ``lists`` has (hash, doc, size).

    A list is dealt to blocks by document hash; each pair of blocks is a group of its own, of about twice
    ``BLOCK_DOCS`` documents, and verifies the links between the two blocks.
    """
    blocks = F.ceil(F.col("size") / BLOCK_DOCS).cast("int")
    own = F.pmod(F.xxhash64("doc"), F.col("blocks")).cast("int")
    # with one block it meets itself; with more every two blocks meet, each also alone with itself
    dealt = lists.withColumn("blocks", blocks).withColumn("own", own).select(
        "hash",
        F.col("doc").alias("doc_id"),
        "own",
        F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"),
    )
    groups = dealt.select(
        "hash", "doc_id", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), (F.col("own") > F.col("other")).alias("side")
    )
    texts = docs.join(groups, "doc_id").select("hash", "low", "high", "side", "doc_id", "text", "class")
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(table: pa.Table) -> pa.Table:
        found = _sets_of(table.column("text").to_pylist(), table.column("class").to_pylist())
        rows = [k for k, s in enumerate(found) if s is not None]
        ids, sides = (table.column(name).take(pa.array(rows, pa.int64())).to_pylist() for name in ("doc_id", "side"))
        if not rows:
            return schema.empty_table()
        found = spanning_links([found[k] for k in rows], np.array(sides))
        pairs = [(min(ids[a], ids[b]), max(ids[a], ids[b])) for a, b in found]
        return pa.Table.from_arrays([pa.array(c, pa.int64()) for c in (zip(*pairs) if pairs else ([], []))], schema=schema)

    return texts.groupBy("hash", "low", "high").applyInArrow(run, "a long, b long").distinct()


def link_groups(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: doc_id, text_a, text_b, n_shingles, class (of equal sets), group (least class
    reachable by links), component_id (smallest doc_id of the group)."""
    docs = base.id_and_text(df, doc_id, text)
    surveyed = base.stage_table(survey(docs), "survey")
    counts = rough_counts(surveyed)
    rows = surveyed.filter(F.col("n").isNotNull()).select("doc_id", "text_a", "text_b", "n", "class")
    members = rows.filter("doc_id IS NOT NULL AND n > 0")
    leads = base.stage_table(members.groupBy("class").agg(F.min("doc_id").alias("lead")), "leads")
    known = docs.filter(F.col("doc_id").isNotNull())
    sieved = base.stage_table(sieve(known, counts), "sieved")
    # a text per class; rows may repeat an id, so the class of a text is checked where it is read
    chosen = base.stage_table(leads.join(sieved, "class").select(F.col("lead").alias("doc_id"), "class"), "chosen")
    small = base.broadcast_if_small(chosen, chosen.count())
    texts = known.join(small, "doc_id").select(F.col("class").alias("doc_id"), "text", "class")
    lists = base.stage_table(posting_lists(texts, counts), "posting-lists")
    sizes = lists.groupBy("hash").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    sized = base.stage_table(lists.join(sizes, "hash"), "sized-lists")
    pairs = short_pairs(sized.filter(F.col("size") <= SHORT_LIST).drop("size"))
    long = sized.filter(F.col("size") > SHORT_LIST).select("hash", "doc", "size")
    links = base.stage_table(verify_pairs(pairs, texts).unionAll(block_links(long, texts)), "verified")
    linked = leads.join(components(links).withColumnsRenamed({"node": "class", "component": "group"}), "class")
    linked = base.stage_table(linked, "linked-classes")
    least = base.stage_table(linked.groupBy("group").agg(F.min("lead").alias("component_id")), "groups")
    named = linked.join(base.broadcast_if_small(least, least.count()), "group").select("class", "group", "component_id")
    single = leads.join(linked, "class", "left_anti").select("class", F.col("class").alias("group"), F.col("lead").alias("component_id"))
    joined = rows.join(named.unionByName(single), "class", "left")
    # texts without words are alone
    known_id = F.col("doc_id").isNotNull()
    return joined.select(
        "doc_id",
        "text_a",
        "text_b",
        F.col("n").alias("n_shingles"),
        "class",
        F.when(known_id, F.col("group")).alias("group"),
        F.when(known_id, F.coalesce("component_id", "doc_id")).alias("component_id"),
    )


def one_per_group(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``df``, of each group of linked documents only one: that with the smallest id.

    A document is an id with its text: another text under an id that goes stays unless it is in the group,
    too. Rows that repeat id and text stay once. Texts without words and rows without id all stay. The columns
    stay as they are, whatever their names.
    """
    identity = ["doc_id", "text_a", "text_b"]
    groups = base.stage_table(link_groups(df, doc_id, text), "groups").filter("n_shingles > 0 AND doc_id IS NOT NULL")
    # one row per document; rows repeated whole count once
    documents = groups.groupBy("group", *identity).agg(F.count(F.lit(1)).alias("copies"))
    documents = base.stage_table(documents, "group-documents")
    first = documents.groupBy("group").agg(F.min(F.struct(*identity)).alias("first"), F.count(F.lit(1)).alias("several"))
    first = base.stage_table(first.filter("several > 1").select("group", "first"), "first-of-groups")
    gone = documents.join(base.broadcast_if_small(first, first.count()), "group").filter(F.struct(*identity) != F.col("first"))
    gone = base.stage_table(gone.select(*identity), "gone")
    again = base.stage_table(documents.filter("copies > 1").select(*identity), "again")
    # the given columns travel in a struct, where no name can clash
    hashes = base.hash128(F.coalesce(F.col(f"`{text}`"), F.lit("")))
    keys = [F.col(f"`{doc_id}`").cast("long"), *hashes]
    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), *[k.alias(c) for c, k in zip(identity, keys)])
    left = rows.join(base.broadcast_if_small(gone, gone.count()), identity, "left_anti")
    repeated = again.count()
    if repeated:
        small = base.broadcast_if_small(again, repeated)
        once = left.join(small, identity, "left_semi").groupBy(*identity).agg(F.first("row").alias("row"))
        left = left.join(small, identity, "left_anti").select("row").unionByName(once.select("row"))
    return left.select("row.*")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_groups(base.read(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")
