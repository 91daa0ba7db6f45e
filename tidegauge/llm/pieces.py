"""A SentencePiece BPE vocabulary as tables: ranks, pairs, and the exact split of texts into parts.

The library gives the pieces and their scores; merging is done here. A text is escaped (blank to
``▁``, one ``▁`` in front) and split at places no merge can cross, because no piece of the vocabulary
holds them: before a run of ``▁`` and around characters without a piece. Such characters become the
byte pieces of their UTF-8 form.
"""

from __future__ import annotations

import re
from functools import lru_cache

import sentencepiece

BLANK = "▁"
NO_RANK = 1 << 30
_COARSE = re.compile(f"{BLANK}+[^{BLANK}\n]*|[^{BLANK}\n]+|\n").findall


class Pieces:
    """Tables of one model file. Ranks grow as scores fall; equal scores share a rank."""

    def __init__(self, path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.vocab_size()
        self.size = size
        self.bos, self.eos, self.unk = model.bos_id(), model.eos_id(), model.unk_id()
        self.surface = [model.id_to_piece(i) for i in range(size)]
        self.is_byte = [model.is_byte(i) for i in range(size)]
        self.is_control = [model.is_control(i) for i in range(size)]
        self.byte_id = [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        special = {i for i in range(size) if self.is_byte[i] or self.is_control[i] or i == self.unk}
        self.id_of = {p: i for i, p in enumerate(self.surface) if i not in special}
        scores = {i: model.get_score(i) for i in self.id_of.values()}
        order = {s: r for r, s in enumerate(sorted(set(scores.values()), reverse=True))}
        self.rank = [NO_RANK] * size
        for i, s in scores.items():
            self.rank[i] = order[s]
        self.length = [len(p) for p in self.surface]
        self._check(model)
        # (left id, right id) -> merged id, for every way to cut a piece in two pieces
        self.pairs: dict[tuple[int, int], int] = {}
        for piece, i in self.id_of.items():
            for cut in range(1, len(piece)):
                left, right = self.id_of.get(piece[:cut]), self.id_of.get(piece[cut:])
                if left is not None and right is not None:
                    self.pairs[left, right] = i
        self.inside = {p for p in self.id_of if len(p) == 1}
        inside = "".join(re.escape(p) for p in self.inside if p != BLANK)
        self.split_fully = re.compile(f"{BLANK}+[{inside}]*|[{inside}]+|.", re.S).findall
        self.run_period = max(len(p) for p in self.id_of if set(p) == {BLANK})
        self._runs = [self.merge([self.id_of[BLANK]] * n)[0] for n in range(3 * self.run_period)]
        longest = self.id_of[BLANK * self.run_period]
        for n in range(self.run_period, len(self._runs)):
            if self._runs[n] != [longest, *self._runs[n - self.run_period]]:
                raise ValueError("runs of blanks do not repeat in this vocabulary")

    def _check(self, model) -> None:
        """What the split relies on; another vocabulary fails here rather than giving other tokens."""
        if model.encode(" a  b ", out_type=str)[0][0] != BLANK or model.encode("a b\n") == model.encode("a  b\n"):
            raise ValueError("the model must keep blanks and add one in front")
        if any(re.search(f"[^{BLANK}]{BLANK}|{BLANK}{BLANK}[^{BLANK}]", p) for p in self.id_of):
            raise ValueError("a piece crosses a word border")
        if any("\n" in p for p in self.id_of):
            raise ValueError("a piece holds a line end")
        if any(c not in self.id_of for p in self.id_of for c in p):
            raise ValueError("a character of a piece is no piece")
        runs = [self.rank[i] for p, i in self.id_of.items() if len(p) > 1 and set(p) == {BLANK}]
        rest = [self.rank[i] for p, i in self.id_of.items() if len(p) > 1 and set(p) != {BLANK}]
        if runs and min(runs) <= max(rest):
            raise ValueError("blanks must merge after everything else")

    def merge(self, symbols: list[int]) -> tuple[list[int], dict[int, tuple[int, int]]]:
        """Plain one-at-a-time merging, best rank first, leftmost on ties; and how nodes were made.

        Meant for short inputs: single pieces, runs of blanks.
        """
        symbols, made = list(symbols), {}
        while len(symbols) > 1:
            options = [
                (self.rank[self.pairs[p]], k)
                for k, p in enumerate(zip(symbols, symbols[1:]))
                if p in self.pairs
            ]
            if not options:
                break
            _, k = min(options)
            node = self.pairs[symbols[k], symbols[k + 1]]
            made[node] = (symbols[k], symbols[k + 1])
            symbols[k : k + 2] = [node]
        return symbols, made

    def run_tokens(self, n: int) -> list[int]:
        """Tokens of n blanks without a word after them."""
        if n < len(self._runs):
            return self._runs[n]
        whole, rest = divmod(n, self.run_period)
        return [self.id_of[BLANK * self.run_period]] * whole + self._runs[rest]

    def parts(self, text: str) -> list[str]:
        """The text's independent parts; their tokens, one after the other, are the text's tokens.

        This split is quick and only looks at blanks and line ends; ``split_fully`` cuts a part further
        around characters without a piece.
        """
        return _COARSE(BLANK + text.replace(" ", BLANK)) if text else []


@lru_cache(maxsize=4)
def load(path: str) -> Pieces:
    return Pieces(path)
