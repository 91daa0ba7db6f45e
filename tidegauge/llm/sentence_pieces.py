"""SentencePiece encoding and decoding with vectorised merge rounds.

The parts of many texts that are not known yet are encoded together: one flat array of symbols, the
rank of each neighbouring pair beside it, and a row of part borders. Each round takes the smallest
rank inside every part (a segmented minimum), merges all its pairs at once from the left, and
compacts the arrays; parts without a pair leave. Merging all pairs of one rank at once equals the
library's one-by-one order unless a merge can bring up a pair of the same or a better rank; for such
pieces only the leftmost pair of a part is merged in a round. Decoding gathers the bytes of all
pieces into one flat array.

Defined results: NULL and empty texts give begin and end ids only; repeated rows are encoded each; an
empty table gives an empty one; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import heapq
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from tidegauge.llm import base
from tidegauge.llm.pieces import BLANK, NO_RANK, Pieces, load

MODEL = "piece_bpe_32k.model"
# Parts kept per worker; beyond that the memory starts anew.
KEPT_PARTS = 1_000_000
KEPT_LENGTH = 64
# Longer words are merged with a queue of pairs: a word of one repeated letter has as many rounds as letters.
ROUNDS_LENGTH = 256
_CODE_POINTS = 0x110000


class Codec:
    """Encoder and decoder of one vocabulary."""

    def __init__(self, pieces: Pieces):
        self.pieces = pieces
        self._kept: dict[str, bytes] = {}
        self._symbol = np.full(_CODE_POINTS, -1, "i4")
        for piece, i in pieces.id_of.items():
            if len(piece) == 1:
                self._symbol[ord(piece)] = i
        two = np.array(list(pieces.pairs), "i8")
        merged = np.array(list(pieces.pairs.values()), "i8")
        keys = two[:, 0] << 32 | two[:, 1]
        order = np.argsort(keys)
        self._pair_keys, self._pair_merged = keys[order], merged[order].astype("i4")
        rank = np.array(pieces.rank, "i4")
        self._pair_rank = rank[self._pair_merged]
        # A merge of this rank may go ahead everywhere at once: it brings up only later ranks.
        next_best = np.full(pieces.size, NO_RANK, "i4")
        for side in (0, 1):
            np.minimum.at(next_best, two[order, side], self._pair_rank)
        alone = np.bincount(rank[list(pieces.id_of.values())], minlength=int(self._pair_rank.max()) + 1) == 1
        self._at_once = np.zeros(len(alone), bool)
        made = np.unique(self._pair_merged)
        self._at_once[rank[made]] = (next_best[made] > rank[made]) & alone[rank[made]]
        surface = [self._bytes_of(i) for i in range(pieces.size)]
        self._surface = np.frombuffer(b"".join(surface), "u1")
        self._size = np.fromiter(map(len, surface), "i8", len(surface))
        self._start = np.cumsum(self._size) - self._size
        self._is_byte = np.array(pieces.is_byte)
        self._is_control = np.array(pieces.is_control)

    def _bytes_of(self, i: int) -> bytes:
        p = self.pieces
        if p.is_control[i]:
            return b""
        if i == p.unk:
            return " ⁇ ".encode()
        if p.is_byte[i]:
            return bytes([p.byte_id.index(i)])
        return p.surface[i].replace(BLANK, " ").encode()

    def _look_up(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and merged piece of neighbouring symbols."""
        keys = left.astype("i8") << 32 | right
        at = np.minimum(np.searchsorted(self._pair_keys, keys), len(self._pair_keys) - 1)
        known = self._pair_keys[at] == keys
        return np.where(known, self._pair_rank[at], NO_RANK), self._pair_merged[at]

    def _merge_long(self, symbols: list[int]) -> np.ndarray:
        """Tokens of one long word, in n log n steps: pairs wait in a heap by rank, then place.

        An entry counts only if the pair that stands at its place when it comes up has its rank.
        """
        pairs, rank = self.pieces.pairs, self.pieces.rank
        size = len(symbols)
        after, before = list(range(1, size + 1)), list(range(-1, size - 1))

        def entry(at: int) -> int | None:
            right = after[at]
            merged = pairs.get((symbols[at], symbols[right])) if right < size else None
            return None if merged is None else rank[merged] << 40 | at

        queue = [e for e in map(entry, range(size)) if e is not None]
        heapq.heapify(queue)
        while queue:
            first = heapq.heappop(queue)
            at = first & 0xFFFFFFFFFF
            # a symbol that was merged into another one is -1 and in no pair
            if entry(at) != first:
                continue
            right = after[at]
            symbols[at] = pairs[symbols[at], symbols[right]]
            symbols[right] = -1
            after[at] = after[right]
            if after[right] < size:
                before[after[right]] = at
            for place in (before[at], at):
                new = entry(place) if place >= 0 else None
                if new is not None:
                    heapq.heappush(queue, new)
        return np.array([s for s in symbols if s >= 0], "i4")

    def merged_words(self, words: list[str]) -> list[np.ndarray]:
        """Tokens of each word: in common rounds, or one by one if a word is very long."""
        short = [k for k, w in enumerate(words) if len(w) <= ROUNDS_LENGTH]
        result: list[np.ndarray] = [np.empty(0, "i4")] * len(words)
        for k, tokens in zip(short, self.merge_rounds([words[k] for k in short]) if short else []):
            result[k] = tokens
        for k in set(range(len(words))).difference(short):
            codes = np.frombuffer(words[k].encode("utf-32-le"), "<u4")
            result[k] = self._merge_long(self._symbol[codes].tolist())
        return result

    def merge_rounds(self, words: list[str]) -> list[np.ndarray]:
        """Tokens of each word; words are not empty and hold only characters that are pieces."""
        sizes = np.fromiter(map(len, words), "i8", len(words))
        symbols = self._symbol[np.frombuffer("".join(words).encode("utf-32-le"), "<u4")]
        starts = np.cumsum(sizes) - sizes
        which = np.arange(len(words))
        ranks, merged = np.full(len(symbols), NO_RANK, "i4"), np.zeros(len(symbols), "i4")
        ranks[:-1], merged[:-1] = self._look_up(symbols[:-1], symbols[1:])
        ranks[starts + sizes - 1] = NO_RANK
        result: list[np.ndarray] = [symbols] * len(words)
        while len(which):
            best = np.minimum.reduceat(ranks, starts)
            done = best == NO_RANK
            if done.any():
                for w, s, n in zip(which[done].tolist(), starts[done].tolist(), sizes[done].tolist()):
                    result[w] = symbols[s : s + n].copy()
                stay = np.repeat(~done, sizes)
                symbols, ranks, merged = symbols[stay], ranks[stay], merged[stay]
                which, sizes, best = which[~done], sizes[~done], best[~done]
                if not len(which):
                    break
                starts = np.cumsum(sizes) - sizes
            chosen = np.flatnonzero(ranks == np.repeat(best, sizes))
            word = np.searchsorted(starts, chosen, "right") - 1
            # in a row of overlapping pairs every second one, from the left
            first = np.flatnonzero(np.diff(chosen, prepend=-2) != 1)
            in_row = np.arange(len(chosen)) - np.repeat(first, np.diff(np.append(first, len(chosen))))
            leftmost = np.diff(word, prepend=-1) != 0
            go = np.where(self._at_once[best[word]], in_row % 2 == 0, leftmost)
            chosen, word = chosen[go], word[go]
            symbols[chosen] = merged[chosen]
            keep = np.ones(len(symbols), bool)
            keep[chosen + 1] = False
            sizes -= np.bincount(word, minlength=len(sizes))
            starts = np.cumsum(sizes) - sizes
            # the pair after a merged symbol, and the one before it, are new
            place = np.cumsum(keep) - 1
            symbols, ranks, merged = symbols[keep], ranks[keep], merged[keep]
            at = place[chosen]
            at = np.unique(np.concatenate([at, at[at > 0] - 1]))
            inner = at[at + 1 < len(symbols)]
            ranks[at] = NO_RANK
            ranks[inner], merged[inner] = self._look_up(symbols[inner], symbols[inner + 1])
            ranks[starts + sizes - 1] = NO_RANK
        return result

    def _encode_parts(self, parts: list[str]) -> list[bytes]:
        """Tokens of parts as little-endian bytes."""
        p, inside = self.pieces, self.pieces.inside
        words: list[str] = []
        plans: list[list[int | tuple[int, int]]] = []
        for part in parts:
            plain = inside.issuperset(part) and not part.startswith(BLANK * 2)
            plan = []
            for piece in [part] if plain else p.split_fully(part):
                if piece[0] not in inside:
                    plan += [("ids", [p.byte_id[b] for b in piece.encode()])]
                    continue
                blanks = len(piece) - len(piece.lstrip(BLANK))
                if blanks == len(piece) > 1:
                    plan.append(("ids", p.run_tokens(blanks)))
                else:
                    plan.append(("word", len(words), max(blanks - 1, 0)))
                    words.append(piece[blanks - 1 :] if blanks else piece)
            plans.append(plan)
        tokens = self.merged_words(words) if words else []
        return [b"".join(self._placed(step, tokens) for step in plan) for plan in plans]

    def _placed(self, step: tuple, tokens: list[np.ndarray]) -> bytes:
        """Tokens of one step; blanks in front join a lone blank that the word left over."""
        if step[0] == "ids":
            return np.array(step[1], "<u4").tobytes()
        ids, before = tokens[step[1]], step[2]
        if not before:
            return ids.astype("<u4").tobytes()
        lone = ids[0] == self.pieces.id_of[BLANK]
        run = self.pieces.run_tokens(before + 1 if lone else before)
        return np.concatenate([run, ids[1:] if lone else ids]).astype("<u4").tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, without begin and end, as little-endian unsigned 32-bit integers."""
        split = [self.pieces.parts(t) for t in texts]
        kept = self._kept
        if len(kept) >= KEPT_PARTS:
            kept.clear()
        new = list({p for parts in split for p in parts if p not in kept})
        long: dict[str, bytes] = {}
        for part, ids in zip(new, self._encode_parts(new)):
            (kept if len(part) <= KEPT_LENGTH else long)[part] = ids
        if long:
            return [b"".join([kept.get(p) or long[p] for p in parts]) for parts in split]
        return [b"".join(map(kept.__getitem__, parts)) for parts in split]

    def decode(self, ids: np.ndarray) -> str:
        """Text of ids: pieces side by side, the blank put in front taken away, bad bytes as U+FFFD."""
        shown = np.flatnonzero(~self._is_control[ids])
        if not len(shown):
            return ""
        ids = ids[shown[0] : shown[-1] + 1]
        if len(ids) > len(shown):
            return self._decode_broken(ids)  # a control id inside separates byte pieces
        sizes = self._size[ids]
        ends = np.cumsum(sizes)
        flat = self._surface[np.repeat(self._start[ids] - (ends - sizes), sizes) + np.arange(ends[-1])]
        data = flat.tobytes()
        if self.pieces.surface[int(ids[0])].startswith(BLANK):
            data = data[1:]
        try:
            return data.decode()
        except UnicodeDecodeError:
            return self._decode_broken(ids)

    def _decode_broken(self, ids: np.ndarray) -> str:
        """The same for ids whose byte pieces do not form UTF-8: each stray byte becomes U+FFFD."""
        out, run = [], b""
        for k, i in enumerate(ids.tolist()):
            if self._is_byte[i]:
                run += self._bytes_of(i)
                continue
            out += [_lenient(run), self._bytes_of(i)[1 if k == 0 and self.pieces.surface[i][0] == BLANK else 0 :]]
            run = b""
        return b"".join([*out, _lenient(run)]).decode()


def _lenient(run: bytes) -> bytes:
    out = b""
    while run:
        for n in (1, 2, 3, 4):
            try:
                run[:n].decode()
            except UnicodeDecodeError:
                continue
            if len(run) >= n:
                out, run = out + run[:n], run[n:]
                break
        else:
            out, run = out + "�".encode(), run[1:]
    return out


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    return Codec(load(path))


def encode(df: DataFrame, path: str | None = None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: doc_id, ids array<int> with begin and end ids."""
    path = path or public_tokenizers.path(MODEL)

    def make():
        own = codec(path)

        def apply(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = [_framed(own, ids) for ids in own.encode(batch.column(1).to_pylist())]
            ends = np.cumsum([0, *map(len, found)]).astype("i4")
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(found).astype("i4")))
            return pa.RecordBatch.from_arrays([batch.column(0), lists], ["doc_id", "ids"])

        return apply

    return base.map_batches(base.id_and_text(df, doc_id, text), make, "doc_id long, ids array<int>")


def decode(df: DataFrame, path: str | None = None, doc_id: str = "doc_id", ids: str = "ids") -> DataFrame:
    """One row per input row: doc_id, text. NULL ids, or a NULL among them, give a NULL text."""
    path = path or public_tokenizers.path(MODEL)

    def make():
        own = codec(path)

        def apply(batch: pa.RecordBatch) -> pa.RecordBatch:
            rows = batch.column(1).to_pylist()
            texts = [None if r is None or None in r else own.decode(np.array(r, "i8")) for r in rows]
            return pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

        return apply

    return base.map_batches(df.selectExpr(f"{doc_id} AS doc_id", f"{ids} AS ids"), make, "doc_id long, text string")


def round_trip(df: DataFrame, path: str | None = None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Encode and decode every text and keep the digests.

    One row per input row: doc_id, n_tokens (begin and end ids counted), ids_sha256, decoded_sha256.
    """
    path = path or public_tokenizers.path(MODEL)

    def make():
        own = codec(path)

        def apply(batch: pa.RecordBatch) -> pa.RecordBatch:
            n_tokens, ids_hex, text_hex = [], [], []
            for ids in own.encode(batch.column(1).to_pylist()):
                framed = _framed(own, ids)
                n_tokens.append(len(framed))
                ids_hex.append(hashlib.sha256(framed.tobytes()).hexdigest())
                text_hex.append(hashlib.sha256(own.decode(framed).encode()).hexdigest())
            columns = [batch.column(0), pa.array(n_tokens, pa.int64()), pa.array(ids_hex), pa.array(text_hex)]
            return pa.RecordBatch.from_arrays(columns, ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

        return apply

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return base.map_batches(base.id_and_text(df, doc_id, text), make, schema)


def _framed(own: Codec, ids: bytes) -> np.ndarray:
    return np.concatenate([[own.pieces.bos], np.frombuffer(ids, "<u4"), [own.pieces.eos]]).astype("<u4")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(base.read(spark, sf_dir, "documents"))
