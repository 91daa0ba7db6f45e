"""Packing by concatenating and cutting.

First pass: texts become token ids, and each row learns how many ids lie before it inside its
partition; the rows are written to the shared folder. Second pass: prefix sums over the partition
totals (one row per partition) give every document its global offset, and the endless row of ids is
cut at each multiple of the window. A document that crosses a border becomes several boundary records.
All sequences but the last are full, so padding is below one window in total.

Defined results: NULL and empty texts consist of the end id alone; repeated rows are packed each; an
empty table gives an empty one; other columns are ignored, whatever their names. The order of the
documents is the order in which the first pass stored them.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidegauge.llm import base

MODEL = "word_bpe_49k.json"
WINDOW = 4096
END_ID = 2
# Parts kept per worker in each of two generations: when the younger one is full it becomes the older one,
# from which only what is asked for again moves on. So memory is bounded and frequent parts stay.
KEPT_PARTS = 300_000
KEPT_LENGTH = 64
# Words asked for as one text.
JOINED = 1000
# Bytes of the texts that are tokenized at once; rows stay whole, so one may go beyond.
SLICE_BYTES = 1 << 23
_LETTERS = "[A-Za-zÀ-ÖØ-öø-ÿ]+"
_IS_WORD = re.compile(_LETTERS).fullmatch
# A word of plain letters and signs behind it, without apostrophes (they can start a contraction) and the
# signs of special strings: such words are split off by the vocabulary's pattern, whatever their case.
_WORD_AND_SIGNS = rf"^(?P<word>{_LETTERS})(?P<signs>[!-&(-;=-@\[-`{{}}~]*)\z"


class ChunkTokenizer:
    """The library's ids, asked for once per chunk between blanks.

    This vocabulary drops white space before it merges, so a text's ids are those of its chunks one
    after the other; special strings hold no white space and stay inside their chunk. Texts are split
    and their ids put together as Arrow arrays; only distinct words are looked up one by one.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks are the parallelism
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        for text in ("one  two", "one\ntwo", " one two "):
            if self._ids([text])[0] != b"".join(self._ids(["one", "two"])):
                raise ValueError("the tokenizer must drop white space")
        # words are asked for in lower case only where the vocabulary knows no other
        cased = self._ids(["Harbour", "ÉCOLE", "harbour", "école"])
        self._fold = cased[:2] == cased[2:]
        # whether a piece ends a word
        suffix = getattr(self._tokenizer.model, "end_of_word_suffix", None)
        vocabulary = self._tokenizer.get_vocab()
        self._ends = np.zeros(max(vocabulary.values()) + 1, "?")
        self._ends[[i for piece, i in vocabulary.items() if suffix and piece.endswith(suffix)]] = True
        self._young: dict[str, bytes] = {}
        self._old: dict[str, bytes] = {}

    def _ids(self, texts: list[str]) -> list[bytes]:
        found = self._tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, "<u4").tobytes() for e in found]

    def _word_ids(self, words: list[str]) -> list[bytes]:
        """Ids of words of plain letters: many are asked for as one text, which is cut where words end."""
        groups = [words[k : k + JOINED] for k in range(0, len(words), JOINED)]
        found = []
        for group, ids in zip(groups, self._ids([" ".join(g) for g in groups])):
            ends = 4 * (np.flatnonzero(self._ends[np.frombuffer(ids, "<u4")]) + 1)
            if len(ends) == len(group):
                ends = ends.tolist()
                found += [ids[low:high] for low, high in zip([0, *ends], ends)]
            else:  # a vocabulary that does not mark the ends of words
                found += self._ids(group)
        return found

    def _part_ids(self, parts: pa.Array) -> pa.Array:
        """Ids of each part: from memory, or from the library."""
        coded = parts.dictionary_encode()
        wanted = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        if len(self._young) >= KEPT_PARTS:
            self._old, self._young = self._young, {}
        young, old = self._young, self._old
        ids = list(map(young.get, wanted))
        words, others = [], []  # places of what no generation has
        for k, part in ((k, wanted[k]) for k, i in enumerate(ids) if i is None):
            if part in old:
                young[part] = ids[k] = old[part]
            else:
                (words if _IS_WORD(part) else others).append(k)
        for places, ask in ((words, self._word_ids), (others, self._ids)):
            for k, made in zip(places, ask([wanted[k] for k in places])):
                ids[k] = made
                if len(wanted[k]) <= KEPT_LENGTH:
                    young[wanted[k]] = made
        return pa.array(ids, pa.large_binary()).take(coded.indices)

    def _chunk_ids(self, chunks: pa.Array) -> pa.Array:
        """Ids of chunks; words are asked for in one case and without the signs behind them."""
        found = pc.extract_regex(chunks, _WORD_AND_SIGNS)
        words, signs = pc.struct_field(found, "word"), pc.struct_field(found, "signs")
        words = pc.coalesce(pc.utf8_lower(words) if self._fold else words, chunks)
        signs = pc.coalesce(signs, pa.scalar("", chunks.type))
        return pc.binary_join_element_wise(self._part_ids(words), self._part_ids(signs), pa.scalar(b"", pa.large_binary()))

    def encode_array(self, texts: pa.Array, end: bytes = b"") -> pa.Array:
        """Ids of each text as little-endian unsigned 32-bit integers, and ``end`` behind them; no text is NULL."""
        split = pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")
        coded = split.flatten().dictionary_encode()
        ids = pa.concat_arrays([self._chunk_ids(coded.dictionary), pa.array([end], pa.large_binary())])
        # each text's chunks, then its end
        stops = split.offsets.to_numpy()[1:]
        order = np.insert(coded.indices.to_numpy(), stops, len(ids) - 1)
        joined = ids.take(pa.array(order))
        places = np.concatenate([[0], np.cumsum(pc.binary_length(joined).to_numpy())])
        starts = places[np.concatenate([[0], stops + np.arange(1, len(texts) + 1)])]
        made = pa.Array.from_buffers(pa.large_binary(), len(texts), [None, pa.py_buffer(starts), joined.buffers()[2]])
        return made.cast(pa.binary())

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        return self.encode_array(pa.array(texts, pa.string())).to_pylist()


@lru_cache(maxsize=2)
def tokenizer(path: str) -> ChunkTokenizer:
    return ChunkTokenizer(path)


def slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The batch in pieces of some SLICE_BYTES of text, so that memory does not follow the length of texts."""
    filled = np.cumsum(pc.binary_length(batch.column(1)).to_numpy(), dtype="i8") // SLICE_BYTES
    cuts = [0, *(np.flatnonzero(np.diff(filled)) + 1).tolist(), batch.num_rows]
    for low, high in zip(cuts, cuts[1:]):
        if low < high:
            yield batch.slice(low, high - low)


def tokenized(df: DataFrame, path: str | None = None, doc_id: str = "doc_id", text: str = "text", end_id: int = END_ID) -> DataFrame:
    """Ids of each text and the end id, with each row's place inside its partition.

    doc_id, part (partition), before (ids before it in the partition), doc_tokens, ids binary.
    """
    path = path or public_tokenizers.path(MODEL)
    end = np.array([end_id], "<u4").tobytes()
    base.small_batches(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base.give_back()
        own, part, before = tokenizer(path), TaskContext.get().partitionId(), 0
        for piece in (p for batch in batches for p in slices(batch)):
            ids = own.encode_array(piece.column(1), end)
            sizes = pc.binary_length(ids).to_numpy().astype("i8") // 4
            starts = before + np.cumsum(sizes) - sizes
            before += int(sizes.sum())
            columns = [piece.column(0), pa.array(np.full(len(ids), part, "i4")), pa.array(starts), pa.array(sizes)]
            yield pa.RecordBatch.from_arrays([*columns, ids], ["doc_id", "part", "before", "doc_tokens", "ids"])

    schema = "doc_id long, part int, before long, doc_tokens long, ids binary"
    return base.id_and_text(df, doc_id, text).mapInArrow(run, schema)


def pack(df: DataFrame, window: int = WINDOW, path: str | None = None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Pieces of documents in sequences of ``window`` ids.

    One row per piece: doc_id, start (ids of its document before it), length, ids_crc32 (of the ids as
    little-endian unsigned 32-bit integers), doc_tokens, sequence_id, offset.
    """
    pieces = cut(tokenized(df, path, doc_id, text), window)
    return pieces.withColumn("ids_crc32", F.crc32("ids")).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"
    )


def cut(tokens: DataFrame, window: int = WINDOW) -> DataFrame:
    """Cut stored ids into windows; like ``pack``, with the piece's ids as binary."""
    stored = base.stage_table(tokens, "tokens", compression="zstd")
    totals = stored.groupBy("part").agg(F.sum("doc_tokens").alias("total"))
    # one row per partition of the first pass; the sums run over those rows only
    running = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("part", F.coalesce(F.sum("total").over(running), F.lit(0)).alias("part_start"))
    begin = F.col("part_start") + F.col("before")
    first, last = F.floor(begin / window), F.floor((begin + F.col("doc_tokens") - 1) / window)

    def piece(sequence_id):
        low = F.greatest(sequence_id * window, F.col("begin"))
        high = F.least((sequence_id + 1) * window, F.col("begin") + F.col("doc_tokens"))
        start = low - F.col("begin")
        return F.struct(
            start.alias("start"),
            (high - low).alias("length"),
            sequence_id.alias("sequence_id"),
            (low - sequence_id * window).alias("offset"),
            F.substring("ids", (4 * start + 1).cast("int"), (4 * (high - low)).cast("int")).alias("ids"),
        )

    # so the ids stay where they are
    small = base.broadcast_if_small(offsets, totals.count())
    placed = stored.join(small, "part").withColumns({"begin": begin, "windows": F.sequence(first, last)})
    return placed.select("doc_id", "doc_tokens", F.inline(F.transform("windows", piece)))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(base.read(spark, sf_dir, "documents"))
