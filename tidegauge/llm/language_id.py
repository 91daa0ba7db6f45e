"""Language identification with a string kernel.

The kernel of two texts is the number of character n-grams (two to four, blended) that both hold,
over the geometric mean of the numbers each holds: presence, not frequency. A bounded sample of
labelled rows gives landmarks (Nyström); one-versus-rest kernel ridge regression on the landmarks gives
a weight per landmark and language. A batch of texts is scored by a matrix product of n-gram presence,
landmark presence and weights; the last two factors are multiplied once, when the model is made.
N-grams are hashed to ``SLOTS`` slots.

Outputs only compare the learned languages with each other. Whether a text is in any of them is told by the
share of its n-grams, repeats included, that some landmark holds: it must not lie clearly below that of the
labelled sample. That works for one language as for many, and for texts of any length.

The sample has at most ``SAMPLE_PER_LANG`` rows per language and ``SAMPLE_ROWS`` in all, taken by a hash
of the id from the whole table; only their n-gram slots reach the driver, never texts.

Defined results: NULL texts and texts without a letter are ``und`` with score 0; without any labelled
row every text is ``und``, and the filter keeps all texts with a letter; a row without id is not held out and
never learned from; repeated rows are predicted each; an empty table gives an empty one; the language column
is read for learning only. Columns with the names of the prediction are replaced by it, others stay.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidegauge.llm import base

ORDERS = (2, 3, 4)
SLOT_BITS = 18
SLOTS = 1 << SLOT_BITS
SAMPLE_PER_LANG = 200
SAMPLE_ROWS = 1600
LANDMARKS_PER_LANG = 60
RIDGE = 1e-3
UNKNOWN = "und"
SHARPNESS = 3.0
# A score is shared among so many best outputs, and outputs are scaled by their root mean square, so it
# means the same however many languages are learned: a well-told text has 0.99 with 4 and with 100.
RIVALS = 4
# Two languages with equal outputs have at most 0.5 each; below this score no language stands out.
MIN_SCORE = 0.4
# A text is in none of the learned languages if its share of known n-grams is below this part of what all but
# FOREIGN_SHARE of the sampled texts have, by more than chance explains.
FOREIGN_TIMES = 0.75
FOREIGN_SHARE = 0.02
# Texts of one matrix product.
SCORED_AT_ONCE = 64
_LETTER = re.compile(r"[^\W\d_]").search
_FACTORS = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F], "u4")
_SHIFT = np.uint32(32 - SLOT_BITS)


class Presence:
    """Slots of the n-grams a text holds; keeps one table of flags for reuse."""

    def __init__(self) -> None:
        self._seen = np.zeros(SLOTS, bool)

    @staticmethod
    def all_slots(text: str) -> list[np.ndarray]:
        """Slots of all n-grams, repeats included, an array for each order."""
        codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4")
        found = []
        total = codes * _FACTORS[0]
        for n in range(2, max(ORDERS) + 1):
            if len(codes) < n:
                break
            # each order is the one before and one more character; the order itself is mixed in
            total = total[:-1] + codes[n - 1 :] * _FACTORS[n - 1]
            if n in ORDERS:
                mixed = (total ^ (total >> np.uint32(15))) * np.uint32(0x2C1B3C6D) + np.uint32(n * 0x9E3779B1 & 0xFFFFFFFF)
                found.append((mixed ^ (mixed >> np.uint32(13))) * np.uint32(0x297A2D39) >> _SHIFT)
        return found

    def distinct(self, orders: list[np.ndarray]) -> np.ndarray:
        for own in orders:
            self._seen[own] = True
        found = np.flatnonzero(self._seen)
        self._seen[found] = False
        return found

    def slots(self, text: str) -> np.ndarray:
        return self.distinct(self.all_slots(text))


def share_known(orders: list[np.ndarray], known: np.ndarray) -> tuple[float, int]:
    """(share of n-grams whose slot is known, number of n-grams)."""
    number = sum(map(len, orders))
    return sum(int(np.count_nonzero(known[own])) for own in orders) / max(1, number), number


@dataclass
class Model:
    """Languages, the slots any landmark holds, the weight of each such slot for each language, and the
    share of known n-grams that a text in one of them has at least."""

    languages: list[str]
    slots: np.ndarray
    weights: np.ndarray
    least_known: float = 0.0

    def outputs(self, held: list[np.ndarray]) -> np.ndarray:
        """Regression outputs of texts given by their distinct slots: (texts x slots) @ (slots x languages)."""
        column = np.full(SLOTS, -1, "i4")
        column[self.slots] = np.arange(len(self.slots))
        values = np.zeros((len(held), len(self.languages)))
        presence = np.zeros((min(SCORED_AT_ONCE, len(held)), len(self.slots)), "f4")
        for start in range(0, len(held), SCORED_AT_ONCE):
            block = held[start : start + SCORED_AT_ONCE]
            columns = [at[at >= 0] for at in (column[own] for own in block)]
            for row, at in enumerate(columns):
                presence[row, at] = len(block[row]) ** -0.5
            values[start : start + len(block)] = presence[: len(block)] @ self.weights
            for row, at in enumerate(columns):
                presence[row, at] = 0
        return values

    def _scored(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """(language, score, whether the text is in a learned language at all) of each text."""
        flags = Presence()
        known_slots = np.zeros(SLOTS, bool)
        known_slots[self.slots] = True
        known = np.array([bool(t and _LETTER(t)) and bool(self.languages) for t in texts], bool)
        held, near = [], np.zeros(len(texts), bool)
        for k in np.flatnonzero(known):
            orders = flags.all_slots(texts[k])
            held.append(flags.distinct(orders))
            share, number = share_known(orders, known_slots)
            # a short text may have fewer by chance
            near[k] = share >= self.least_known - max(1, number) ** -0.5
        names = np.full(len(texts), UNKNOWN, object)
        scores = np.zeros(len(texts))
        if held:
            values = self.outputs([own if len(own) else np.zeros(1, int) for own in held])
            names[known] = np.array(self.languages, object)[values.argmax(axis=1)]
            # a soft maximum of the best outputs, whatever their size: long texts have small ones
            sizes = np.maximum(np.sqrt((values * values).mean(axis=1, keepdims=True)), 1e-12)
            powers = np.exp(SHARPNESS * np.sort(values / sizes, axis=1)[:, -RIVALS:])
            scores[known] = powers.max(axis=1) / powers.sum(axis=1)
        return names.tolist(), scores, near

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        return self._scored(texts)[:2]

    def told(self, texts: list[str | None], min_score: float) -> np.ndarray:
        """Flags of the texts whose language can be told; of all with a letter if no language was learned."""
        if not self.languages:
            return np.array([bool(t and _LETTER(t)) for t in texts], bool)
        names, scores, near = self._scored(texts)
        return np.array([n != UNKNOWN for n in names], bool) & near & (scores >= min_score)


def fit(samples: list[tuple], landmarks_per_lang: int = LANDMARKS_PER_LANG, ridge: float = RIDGE) -> Model:
    """Kernel ridge regression on landmarks; ``samples`` has (language, slots) of labelled texts, and
    optionally how often each slot occurs."""
    samples = [(lang, own, rest[0] if rest else np.ones(len(own))) for lang, own, *rest in samples if len(own)]
    languages = sorted({lang for lang, *_ in samples})
    if not languages:
        return Model([], np.empty(0, "i8"), np.empty((0, 0), "f4"))
    chosen, count = [], dict.fromkeys(languages, 0)
    for k, (lang, *_) in enumerate(samples):
        if count[lang] < landmarks_per_lang:
            count[lang] += 1
            chosen.append(k)
    slots = np.unique(np.concatenate([samples[k][1] for k in chosen]))
    place = np.full(SLOTS, -1)
    place[slots] = np.arange(len(slots))
    held = np.zeros((len(chosen), len(slots)), "f4")  # landmarks by slots
    for row, k in enumerate(chosen):
        held[row, place[samples[k][1]]] = 1 / len(samples[k][1]) ** 0.5
    kernel = np.zeros((len(samples), len(chosen)))
    for row, (_, own, _) in enumerate(samples):
        at = place[own]
        kernel[row] = held[:, at[at >= 0]].sum(axis=1) / len(own) ** 0.5
    target = np.array([[1.0 if lang == own else -1.0 for lang in languages] for own, *_ in samples])
    inner = kernel[chosen]
    normal = kernel.T @ kernel + ridge * len(samples) * inner + 1e-9 * np.eye(len(chosen))
    dual = np.linalg.lstsq(normal, kernel.T @ target, rcond=None)[0]
    return Model(languages, slots, (held.T @ dual).astype("f4"), _least_known(samples, chosen, slots))


def _least_known(samples: list[tuple], chosen: list[int], slots: np.ndarray) -> float:
    """What share of known n-grams to ask for, from the sampled texts that are no landmarks.

    With landmarks only, each counts by the n-grams that another landmark holds, too.
    """
    often = np.zeros(SLOTS, "i4")
    for k in chosen:
        often[samples[k][1]] += 1
    landmarks = set(chosen)
    others = [k for k in range(len(samples)) if k not in landmarks]
    if not others and len(chosen) < 2:
        return 0.0
    shares = [(times[often[own] > (0 if others else 1)].sum() / times.sum()) for _, own, times in (samples[k] for k in others or chosen)]
    return FOREIGN_TIMES * float(np.quantile(shares, FOREIGN_SHARE))


def held_out(doc_id: Column) -> Column:
    """The fold that nothing is learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def learn(df: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> Model:
    """Fit the classifier on labelled rows that are not held out."""
    rows = df.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{lang}`").alias("lang"), F.col(f"`{text}`").alias("text"))
    labelled = rows.filter(F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & ~held_out(F.col("doc_id")))
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    ranked = labelled.select("doc_id", "lang", F.row_number().over(order).alias("rank"))
    picked = ranked.filter(F.col("rank") <= SAMPLE_PER_LANG).orderBy("rank", "lang").limit(SAMPLE_ROWS).collect()
    wanted = {(r["doc_id"], r["lang"]): k for k, r in enumerate(picked)}
    base.small_batches(df.sparkSession)

    def run(batches):
        presence = Presence()
        for batch in batches:
            slots, times = [], []
            for text in batch.column("text").to_pylist():
                orders = presence.all_slots(text or "")
                own, often = np.unique(np.concatenate(orders) if orders else np.empty(0, "u4"), return_counts=True)
                slots.append(own.astype("<i4").tobytes())
                times.append(often.astype("<i4").tobytes())
            columns = [batch.column("doc_id"), batch.column("lang"), pa.array(slots, pa.binary()), pa.array(times, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "lang", "slots", "times"])

    ids = sorted({d for d, _ in wanted})
    sample = labelled.filter(F.col("doc_id").isin(ids)) if ids else labelled.limit(0)
    schema = f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, lang string, slots binary, times binary"
    found = {
        wanted[r["doc_id"], r["lang"]]: (r["lang"], np.frombuffer(r["slots"], "<i4"), np.frombuffer(r["times"], "<i4"))
        for r in sample.mapInArrow(run, schema).dropDuplicates(["doc_id", "lang"]).collect()
        if (r["doc_id"], r["lang"]) in wanted
    }
    return fit([found[k] for k in sorted(found)])


def identify(df: DataFrame, model: Model, text: str = "text", columns: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """Add the predicted language and its score; all other columns stay, those with these names go."""
    kept = [c for c in df.columns if c.lower() not in {n.lower() for n in columns}]
    packed = df.select(F.struct(F.lit(0).alias("_"), *[F.col(f"`{c}`") for c in kept]).alias("row"), F.col(f"`{text}`").alias("text"))

    def make():
        def apply(batch: pa.RecordBatch) -> pa.RecordBatch:
            languages, scores = model.predict(batch.column(1).to_pylist())
            return pa.RecordBatch.from_arrays([batch.column(0), pa.array(languages, pa.string()), pa.array(scores)], ["row", "lang", "score"])

        return apply

    kind = packed.schema["row"].dataType.simpleString()
    told = base.map_batches(packed, make, f"row {kind}, lang string, score double")
    return told.select(*[F.col(f"row.`{c}`") for c in kept], F.col("lang").alias(columns[0]), F.col("score").alias(columns[1]))


def with_known_language(df: DataFrame, model: Model, min_score: float = MIN_SCORE, text: str = "text") -> DataFrame:
    """The rows whose language can be told: not ``und`` and a score of at least ``min_score``.

    A model without languages tells none from another: then all texts with a letter stay. The columns
    stay as they are, whatever their names.
    """
    packed = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), F.col(f"`{text}`").alias("text"))

    def make():
        return lambda batch: batch.filter(pa.array(model.told(batch.column(1).to_pylist(), min_score)))

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in packed.schema)
    return base.map_batches(packed, make, fields).select("row.*")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = base.read(spark, sf_dir, "documents")
    model = learn(docs)
    rows = identify(docs.select("doc_id", "text"), model)
    return rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
