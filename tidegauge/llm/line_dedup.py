"""Line deduplication with levelled sorted runs of line hashes.

A store holds the hashes of the repeated lines that were seen so far, as runs: tables partitioned and
sorted by hash. Documents come in batches. Each batch is merge-anti-joined with the runs: a repeated
line whose hash is there has been kept by an earlier batch and is dropped; of the others the copy in the
largest document stays, and their hashes become the batch's own run. When a level holds ``FAN_OUT``
runs they are compacted into one run of the next level, so a batch meets few runs however many batches
came before.

Which lines count as repeated is a statistic over all documents: keys of at least ``MIN_CHARS`` code
points in at least ``MIN_DOCS`` documents. Batches go from the largest ids to the smallest, so that the
copy in the largest document is the one that stays.

Defined results: a NULL or empty text is one empty line; a row without id keeps all its lines; rows
that repeat an id count as one document; an empty table gives an empty one; columns besides id and text
are carried along by ``clean``, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.llm import base

MIN_CHARS = 20
MIN_DOCS = 3
# Batches a whole table is dealt with in, and runs of a level that are compacted together.
BATCHES = 4
FAN_OUT = 2
_SPACE = " \t\n\u000b\f\r"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
HASH = ["hash_a", "hash_b"]
# A row's identity: rows may repeat an id with another text.
ROW = ["doc_id", "text_hash"]


def line_key(line: Column) -> Column:
    """The line without outer blanks and with A-Z in lower case."""
    bare = F.btrim(line, F.lit(_SPACE))
    # lower() is the same and much quicker where all characters are ASCII
    ascii_only = F.octet_length(bare) == F.char_length(bare)
    return F.when(ascii_only, F.lower(bare)).otherwise(F.translate(bare, _UPPER, _UPPER.lower()))


def split_lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


@dataclass
class RunStore:
    """Levels of sorted runs; a run is a table of (hash_a, hash_b), each hash once in the whole store."""

    fan_out: int = FAN_OUT
    levels: list[list[DataFrame]] = field(default_factory=list)

    def runs(self) -> list[DataFrame]:
        return [run for level in self.levels for run in level]

    def unseen(self, lines: DataFrame) -> DataFrame:
        """The batch's lines that no run holds: one merge anti join per run."""
        for run in self.runs():
            lines = lines.join(run.hint("merge"), HASH, "left_anti")
        return lines

    def add(self, hashes: DataFrame) -> None:
        """Store a batch's new hashes as a run and compact the levels that are full."""
        run, level = _sorted_run(hashes, "run"), 0
        while True:
            if level == len(self.levels):
                self.levels.append([])
            self.levels[level].append(run)
            if len(self.levels[level]) < self.fan_out:
                return
            merged = self.levels[level][0]
            for other in self.levels[level][1:]:
                merged = merged.unionAll(other)
            run, self.levels[level], level = _sorted_run(merged, "compacted"), [], level + 1


def _sorted_run(hashes: DataFrame, name: str) -> DataFrame:
    return base.stage_table(hashes.repartition(*HASH).sortWithinPartitions(*HASH), name)


def long_lines(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """(doc_id, text_hash, pos, hash_a, hash_b) of every line with a long enough key."""
    lines = docs.filter(F.col("doc_id").isNotNull()).select(
        *ROW, F.posexplode(F.transform(split_lines(F.col("text")), line_key)).alias("pos", "key")
    )
    hash_a, hash_b = base.hash128(F.col("key"))
    return lines.filter(F.char_length("key") >= min_chars).select(
        *ROW, "pos", hash_a.alias("hash_a"), hash_b.alias("hash_b")
    )


def repeated_lines(lines: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """The lines whose hash is in enough documents."""
    # counted per (hash, document) first: a line of a third of all documents is spread and summed early
    counts = lines.groupBy(*HASH).agg(F.count_distinct("doc_id").alias("docs"))
    # stored, so that the join has shuffles of its own on both sides and the planner may cut a hot hash
    often = base.stage_table(counts.filter(F.col("docs") >= min_docs).select(*HASH), "often")
    return lines.join(often, HASH, "left_semi")


def gone_lines(
    docs: DataFrame,
    min_chars: int = MIN_CHARS,
    min_docs: int = MIN_DOCS,
    batches: int = BATCHES,
    fan_out: int = FAN_OUT,
) -> DataFrame:
    """(doc_id, text_hash, pos) of the lines that go, decided batch by batch against the runs."""
    every = base.stage_table(long_lines(docs, min_chars), "long-lines")
    lines = base.stage_table(repeated_lines(every, min_docs), "repeated-lines")
    shares = [i / batches for i in range(1, batches)]
    cuts = lines.approxQuantile("doc_id", shares, 0.01) if shares else []
    borders = [None, *sorted({int(c) for c in cuts}), None]
    store = RunStore(fan_out)
    gone = []
    for low, high in reversed(list(zip(borders, borders[1:]))):
        batch = lines
        if low is not None:
            batch = batch.filter(F.col("doc_id") >= low)
        if high is not None:
            batch = batch.filter(F.col("doc_id") < high)
        # one row per hash before the joins: a line of very many documents is added up in the tasks that read it
        last = base.stage_table(batch.groupBy(*HASH).agg(F.max("doc_id").alias("doc_id")), "last-holders")
        kept = base.stage_table(store.unseen(last), "kept")
        store.add(kept.select(*HASH))
        gone.append(batch.join(kept, ["doc_id", *HASH], "left_anti").select(*ROW, "pos"))
    result = gone[0]
    for part in gone[1:]:
        result = result.unionAll(part)
    return result


def clean(
    df: DataFrame,
    min_chars: int = MIN_CHARS,
    min_docs: int = MIN_DOCS,
    batches: int = BATCHES,
    fan_out: int = FAN_OUT,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Drop repeated lines from every text.

    One row per input row: ``row`` (struct of the input's columns), ``kept`` (the text that stays; NULL
    only if the text is NULL), ``n_lines`` (before dropping), ``n_dropped``.
    """
    docs = df.select(
        F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"),
        F.col(f"`{doc_id}`").alias("doc_id"),
        F.col(f"`{text}`").alias("text"),
    ).withColumn("text_hash", F.xxhash64("text"))
    gone = gone_lines(docs.drop("row"), min_chars, min_docs, batches, fan_out)
    # positions of one document's own lines
    per_doc = gone.groupBy(*ROW).agg(F.array_sort(F.collect_set("pos")).alias("gone"))
    lines = split_lines(F.col("text"))
    found = (
        docs.drop("text")
        .join(per_doc, ROW, "left")
        .withColumn("text", F.col(f"row.`{text}`"))
        .withColumns({"n_lines": F.size(lines).cast("long"), "n_dropped": F.coalesce(F.array_size("gone"), F.lit(0)).cast("long")})
    )
    return found.select(
        "row",
        F.when(F.col("n_dropped") > 0, F.concat_ws("\n", _without(lines, F.col("gone")))).otherwise(F.col("text")).alias("kept"),
        "n_lines",
        "n_dropped",
    )


def _without(lines: Column, gone: Column) -> Column:
    """Lines between the gone positions, as slices: linear in the lines."""

    def between(i: Column) -> Column:
        start = F.when(i == 0, 0).otherwise(F.get(gone, i - 1) + 1)
        end = F.coalesce(F.get(gone, i), F.size(lines))
        return F.slice(lines, start + 1, end - start)

    return F.flatten(F.transform(F.sequence(F.lit(0), F.size(gone)), between))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = clean(base.read(spark, sf_dir, "documents"))
    return found.select(
        "row.doc_id",
        "n_lines",
        "n_dropped",
        F.sha2(F.coalesce("kept", F.lit("")).cast("binary"), 256).alias("kept_sha256"),
    )


SQL = f"""
WITH docs AS (
  SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
),
numbered AS (
  SELECT doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS pos FROM docs
),
keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    '{_UPPER}', '{_UPPER.lower()}') AS key
  FROM numbered
),
repeated AS (
  SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= {MIN_CHARS}
  GROUP BY key HAVING count(DISTINCT doc_id) >= {MIN_DOCS}
)
SELECT doc_id, count(*) AS n_lines,
  count(*) FILTER (WHERE keeper IS NOT NULL AND keeper <> doc_id) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE keeper IS NULL OR keeper = doc_id), ''))
    AS kept_sha256
FROM keyed LEFT JOIN repeated USING (key)
GROUP BY doc_id
"""
