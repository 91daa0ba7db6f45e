"""Token counts at every prefix of a text, by dynamic programming over prefixes.

For a prefix the table holds the number of tokens of exactly that prefix. The last token of a prefix
is the one piece ending there that stays apart from the last token of the prefix before it; the count
is then that prefix's count plus one. So a text is walked once, and every question about truncation
or budgets is a lookup. Parts of texts that no merge can cross are walked once per worker and kept.

Defined results: NULL and empty texts have no tokens; repeated rows are counted each; an empty table
gives an empty one; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from functools import lru_cache

import ahocorasick
import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.llm import base
from tidegauge.llm.pieces import BLANK, NO_RANK, Pieces, load

MODEL = "piece_bpe_32k.model"
LIMIT = 4096
# Parts and piece pairs kept per worker; beyond that the memory starts anew.
KEPT_PARTS = 1_000_000
KEPT_PAIRS = 2_000_000
# Counts of parts up to this length fit a byte: a code point has at most four tokens.
KEPT_LENGTH = 63


class PrefixCounter:
    """Prefix tables of texts for one vocabulary."""

    def __init__(self, pieces: Pieces):
        self.pieces = pieces
        self._kept: dict[str, bytes] = {}
        self._apart: dict[int, bool] = {}
        self._found = ahocorasick.Automaton()
        self._right: dict[int, list[tuple[int, int]]] = {}
        self._left: dict[int, list[tuple[int, int]]] = {}
        self._odd: set[int] = set()
        for piece, i in pieces.id_of.items():
            tokens, made = pieces.merge([pieces.id_of[c] for c in piece])
            if tokens != [i]:
                continue  # never the outcome of merging
            self._found.add_word(piece, i)
            self._right[i], self._left[i] = self._edge(i, made, 1), self._edge(i, made, 0)
            if any(pieces.rank[c] >= pieces.rank[n] for n, two in made.items() for c in two if c in made):
                self._odd.add(i)
        self._found.make_automaton()

    def _edge(self, node: int, made: dict[int, tuple[int, int]], side: int) -> list[tuple[int, int]]:
        """Nodes along one edge of a piece's merge tree, innermost first, with the rank that made them."""
        edge = [(node, self.pieces.rank[node])]
        while node in made:
            node = made[node][side]
            edge.append((node, self.pieces.rank[node]))
        return edge[::-1]

    def _stay_apart(self, left: int, right: int) -> bool:
        """Whether two tokens side by side are what merging their joint text gives.

        Merges run by rank, so the symbols at the border are known at each moment: the edges' nodes.
        The tokens fail to stay apart if a pair across the border comes up before the next inner merge.
        """
        pieces = self.pieces
        if left in self._odd or right in self._odd:
            text = pieces.surface[left] + pieces.surface[right]
            return pieces.merge([pieces.id_of[c] for c in text])[0] == [left, right]
        a, b, i, j = self._right[left], self._left[right], 0, 0
        while True:
            next_a = a[i + 1][1] if i + 1 < len(a) else NO_RANK
            next_b = b[j + 1][1] if j + 1 < len(b) else NO_RANK
            across = pieces.pairs.get((a[i][0], b[j][0]))
            if across is not None:
                rank = pieces.rank[across]
                if rank < next_a and rank <= next_b:
                    return False
            if next_a == next_b == NO_RANK:
                return True
            if next_a <= next_b:
                i += 1
            else:
                j += 1

    def _word(self, word: str) -> tuple[list[int], list[bool]]:
        """Counts at each prefix of a word, and whether its first token is a lone blank."""
        n = len(word)
        last, count, lone = [0] * (n + 1), [0] * (n + 1), [False] * (n + 1)
        length, apart = self.pieces.length, self._apart
        lone[1] = word[0] == BLANK
        for at, token in self._found.iter(word):
            end = at + 1
            if last[end]:
                continue
            start = end - length[token]
            if start:
                before = last[start]
                pair = before << 20 | token
                good = apart.get(pair)
                if good is None:
                    good = apart[pair] = self._stay_apart(before, token)
                if not good:
                    continue
                lone[end] = lone[start]
            last[end] = token
            count[end] = count[start] + 1
        if len(apart) > KEPT_PAIRS:
            apart.clear()
        if 0 in last[1:]:
            raise ValueError(f"no token ends a prefix of {word!r}")
        return count, lone

    def _counts(self, piece: str) -> list[int]:
        """Counts at each prefix of a fully split part."""
        if piece[0] not in self.pieces.inside:
            return [len(piece.encode("utf-8"))]
        blanks = len(piece) - len(piece.lstrip(BLANK))
        if blanks < 2:
            return self._word(piece)[0][1:]
        runs = [len(self.pieces.run_tokens(k)) for k in range(blanks + 1)]
        count, lone = self._word(piece[blanks - 1 :])
        return runs[1:] + [
            runs[blanks] + c - 1 if alone else runs[blanks - 1] + c for c, alone in zip(count[2:], lone[2:])
        ]

    def _part(self, part: str) -> list[int]:
        """Counts at each prefix of a part."""
        if self.pieces.inside.issuperset(part) and not part.startswith(BLANK * 2):
            return self._word(part)[0][1:]
        counts, base = [], 0
        for piece in self.pieces.split_fully(part):
            counts += [base + c for c in self._counts(piece)]
            base = counts[-1]
        return counts

    def _keep(self, part: str) -> bytes:
        """The same as bytes, kept for later texts."""
        if len(self._kept) >= KEPT_PARTS:
            self._kept.clear()
        found = self._kept[part] = bytes(self._part(part))
        return found

    def _concatenated(self, parts: list[str], lengths: np.ndarray) -> np.ndarray:
        """Counts of all parts, one after the other, each from its own start."""
        kept, keep = self._kept.get, self._keep
        if lengths.max() <= KEPT_LENGTH:
            return np.frombuffer(b"".join([kept(p) or keep(p) for p in parts]), "u1")
        return np.concatenate(
            [
                np.frombuffer(kept(p) or keep(p), "u1") if len(p) <= KEPT_LENGTH else np.array(self._part(p), "i4")
                for p in parts
            ]
        )

    def table(self, text: str) -> np.ndarray:
        """Token count of the first 0, 1, 2, ... code points of a text."""
        if not text:
            return np.zeros(1, "i4")
        parts = self.pieces.parts(text)
        lengths = np.fromiter(map(len, parts), "i8", len(parts))
        counts = self._concatenated(parts, lengths)
        totals = counts[np.cumsum(lengths) - 1].astype("i4")
        table = np.repeat(np.cumsum(totals, dtype="i4") - totals, lengths)
        table += counts
        table[0] = 0  # the blank put in front is no prefix of its own
        return table


@lru_cache(maxsize=2)
def counter(path: str) -> PrefixCounter:
    return PrefixCounter(load(path))


def with_prefix_counts(df: DataFrame, path: str | None = None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Store the table: ``prefix_counts`` has the token count of the first i code points at index i.

    One row per input row: doc_id, prefix_counts array<int> (code points + 1 entries).
    """
    path = path or public_tokenizers.path(MODEL)

    def make():
        tables = counter(path)

        def apply(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = [tables.table(t) for t in batch.column(1).to_pylist()]
            ends = np.cumsum([0, *map(len, found)]).astype("i4")
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(found)))
            return pa.RecordBatch.from_arrays([batch.column(0), lists], ["doc_id", "prefix_counts"])

        return apply

    return base.map_batches(base.id_and_text(df, doc_id, text), make, "doc_id long, prefix_counts array<int>")


def count_at(prefix_counts: Column, chars: Column) -> Column:
    """Tokens of the first ``chars`` code points (all, if there are fewer)."""
    return F.element_at(prefix_counts, F.least(chars + 1, F.size(prefix_counts)).cast("int"))


def longest_within(prefix_counts: Column, budget: int) -> Column:
    """Most code points from the start that take at most ``budget`` tokens."""
    places = F.transform(prefix_counts, lambda c, i: F.when(c <= budget, i))
    return F.coalesce(F.array_max(places), F.lit(0))


def count_tokens(
    df: DataFrame, limit: int = LIMIT, path: str | None = None, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Answer the usual questions from each text's prefix table without storing it.

    One row per input row: doc_id, n_bytes (UTF-8), n_tokens, over_limit (n_tokens > limit), fit_chars
    (most code points from the start within the limit).
    """
    path = path or public_tokenizers.path(MODEL)

    def make():
        tables = counter(path)

        def apply(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = batch.column(1).to_pylist()
            n_tokens, fits = [], []
            for t in texts:
                table = tables.table(t)
                total = int(table[-1])
                n_tokens.append(total)
                fits.append(len(t) if total <= limit else int(np.flatnonzero(table <= limit)[-1]))
            tokens = np.array(n_tokens, "i8")
            n_bytes = np.fromiter((len(t.encode("utf-8")) for t in texts), "i8", len(texts))
            columns = [batch.column(0), n_bytes, tokens, tokens > limit, np.array(fits, "i8")]
            return pa.RecordBatch.from_arrays(
                [columns[0], *map(pa.array, columns[1:])],
                ["doc_id", "n_bytes", "n_tokens", "over_limit", "fit_chars"],
            )

        return apply

    schema = "doc_id long, n_bytes long, n_tokens long, over_limit boolean, fit_chars long"
    return base.map_batches(base.id_and_text(df, doc_id, text), make, schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(base.read(spark, sf_dir, "documents"))
