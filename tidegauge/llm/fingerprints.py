"""Document fingerprints: threshold-scaled sketches.

A sketch holds every shingle hash below a fixed fraction of the hash range. Its size follows the
document, so the sketch of a union is the union of sketches, and containment can be told even between a
sentence and a book. A document with shingles but none below the threshold keeps its smallest hash; it
gives way as soon as a merge brings in a hash below the threshold.

A fingerprint is the base64 form of the sorted 64-bit hashes. Shingles are those of five words; texts
without words have the empty fingerprint. Likeness is the Jaccard similarity of the sketches, 1 for two
empty ones.

Defined results: NULL texts are empty; rows that repeat an id are ordered by text; a table of one row
is its own next document; an empty table gives an empty one; rows without id come first; other columns
are ignored, whatever their names.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.llm import base
from tidegauge.llm.shingles import distinct, shingle_hashes

# One in so many shingle hashes is kept.
SCALE = 4
THRESHOLD = (1 << 64) // SCALE
# Blocks per shuffle partition: several, so that hashing blocks to partitions evens out.
BLOCKS = 4
_NO_ID = -(1 << 63)


def retained(hashes: np.ndarray) -> np.ndarray:
    """The sketch of a set of hashes: sorted, without repeats."""
    below = distinct(hashes[hashes < THRESHOLD])
    return below if len(below) or not len(hashes) else hashes.min(keepdims=True)


def sketch(text: str) -> np.ndarray:
    return retained(shingle_hashes(text))


def merge(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The sketch of both documents together."""
    return retained(np.concatenate([a, b]))


def to_text(kept: np.ndarray) -> str:
    return base64.b64encode(kept.astype("<u8").tobytes()).decode()


def from_text(fingerprint: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(fingerprint), "<u8")


def _shared(a: np.ndarray, b: np.ndarray) -> int:
    return len(np.intersect1d(a, b, assume_unique=True))


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    both = _shared(a, b)
    union = len(a) + len(b) - both
    return both / union if union else 1.0


def containment(a: np.ndarray, b: np.ndarray) -> float:
    """Share of the first document that the second holds; 1 for an empty first one."""
    return _shared(a, b) / len(a) if len(a) else 1.0


def fingerprints(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: doc_id, fingerprint."""

    def make():
        def apply(batch: pa.RecordBatch) -> pa.RecordBatch:
            prints = [to_text(sketch(t)) for t in batch.column(1).to_pylist()]
            return pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints)], ["doc_id", "fingerprint"])

        return apply

    return base.map_batches(base.id_and_text(df, doc_id, text), make, "doc_id long, fingerprint string")


def compare(df: DataFrame, left: str, right: str) -> DataFrame:
    """Add ``likeness`` and ``containment`` (of the left in the right) of two fingerprint columns.

    A NULL fingerprint gives NULL.
    """

    def make():
        def apply(batch: pa.RecordBatch) -> pa.RecordBatch:
            near: list[float | None] = []
            within: list[float | None] = []
            for a, b in zip(batch.column(left).to_pylist(), batch.column(right).to_pylist()):
                known = a is not None and b is not None
                near.append(likeness(from_text(a), from_text(b)) if known else None)
                within.append(containment(from_text(a), from_text(b)) if known else None)
            added = [pa.array(near, pa.float64()), pa.array(within, pa.float64())]
            return pa.RecordBatch.from_arrays([*batch.columns, *added], [*batch.schema.names, "likeness", "containment"])

        return apply

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    return base.map_batches(df, make, f"{fields}, likeness double, containment double")


def _block_of(key: Column, firsts: list[int]) -> Column:
    """Number of the block whose first key is the last one not above ``key``: two short searches."""
    step = max(1, int(len(firsts) ** 0.5))
    rows = [firsts[i : i + step] for i in range(0, len(firsts), step)]
    row = F.size(F.filter(F.lit([r[0] for r in rows]), lambda b: b <= key)) - 1
    inside = F.get(F.array(*[F.lit(r) for r in rows]), row)
    return row * step + F.size(F.filter(inside, lambda b: b <= key)) - 1


def with_next(docs: DataFrame) -> DataFrame:
    """Blocks of neighbouring documents, each with a copy of the document after its last one.

    ``docs`` has doc_id and text. Block borders are quantiles of the ids (at most a few per shuffle
    partition reach the driver); the first document of a block is copied to the block before it, that of
    the first block to the last. Sorted by block, copies last.
    """
    spark = docs.sparkSession
    keyed = docs.withColumn("key", F.coalesce("doc_id", F.lit(_NO_ID)))
    blocks = BLOCKS * int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = keyed.approxQuantile("key", [i / blocks for i in range(blocks)], 1 / (4 * blocks))
    borders = sorted({_NO_ID, *map(int, cuts)})
    least = keyed.groupBy(_block_of(F.col("key"), borders).alias("block")).agg(F.min("key").alias("key"))
    firsts = sorted(r["key"] for r in least.collect())
    if not firsts:
        return keyed.select("doc_id", "text", F.lit(0).alias("block"), F.lit(False).alias("copy"))
    own = _block_of(F.col("key"), firsts)
    before = F.pmod(F.col("own") - 1, F.lit(len(firsts)))
    places = F.array(F.struct(F.col("own").alias("block"), F.lit(False).alias("copy")))
    both = F.array(
        F.struct(F.col("own").alias("block"), F.lit(False).alias("copy")),
        F.struct(before.cast("int").alias("block"), F.lit(True).alias("copy")),
    )
    placed = keyed.withColumn("own", own).select(
        "doc_id", "text", "key", F.inline(F.when(F.col("key").isin(firsts), both).otherwise(places))
    )
    return (
        placed.repartition("block")
        .sortWithinPartitions("block", "copy", "key", "text")
        .select("doc_id", "text", "block", "copy")
    )


def edited_likeness(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprint every text and its edited form.

    The edited text has its last floor(n / 4) code points replaced by the first as many of the next
    document, by ascending id; the last is followed by the first. One row per input row: doc_id, n_chars,
    edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.
    """
    base.small_batches(df.sparkSession)
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting = None  # the last document seen, with its sketch, in its block
        for batch in batches:
            rows = []
            for own_id, own_text, block, copy in zip(*[c.to_pylist() for c in batch.columns]):
                own = sketch(own_text)
                if waiting is not None and waiting[2] == block:
                    last_id, last_text, _, last = waiting
                    quarter = len(last_text) // 4
                    edited = last_text[: len(last_text) - quarter] + own_text[:quarter]
                    other = sketch(edited)
                    digest = hashlib.sha256(edited.encode()).hexdigest()
                    near = likeness(last, other), likeness(last, own)
                    rows.append((last_id, len(last_text), digest, to_text(last), to_text(other), *near))
                waiting = None if copy else (own_id, own_text, block, own)
            if rows:
                kinds = [pa.int64(), pa.int64(), *[pa.string()] * 3, pa.float64(), pa.float64()]
                columns = [pa.array(c, k) for c, k in zip(zip(*rows), kinds)]
                yield pa.RecordBatch.from_arrays(columns, names)

    schema = (
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double"
    )
    return with_next(base.id_and_text(df, doc_id, text)).mapInArrow(run, schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edited_likeness(base.read(spark, sf_dir, "documents"))
