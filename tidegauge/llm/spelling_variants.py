"""Spelling variants of a corpus' words, one edit apart, found by asymmetric q-chunks.

Words that differ by one inserted, deleted or replaced code point are near. Of two near words the shorter
(either, at one length) contributes two disjoint chunks, its halves; the other contributes positional
grams of the halves' lengths. One edit lies in one half and leaves the other whole, at its place or shifted
by one, so near words always share a chunk. Of all positional grams only those are emitted that lie within
shift one of a place where a chunk can stand, which loses no match.

A chunk that very many words share would make a quadratic list. Such a list is not joined: the half in
which the edit lies (``lo`` to ``hi``) is itself cut into two chunks, one of which must be preserved as well,
and so on down to one code point. The lists that are joined hold at most ``LIST_PAIRS`` candidates or differ
at one place only. Every candidate is verified on the whole words.

Every word then points to its most frequent near word, where that is much more frequent; pointers are
followed to the end by doubling.

Defined results: NULL texts have no words; rows repeated whole count again; a row without id counts as if
its id were the empty string; ties go to the smallest word in code-point order; an empty table gives an
empty one; other columns are ignored, whatever their names. A text of any length is read as a stream of runs.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from operator import itemgetter

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.llm import base

LEAST_CHARS = 6
LEAST_COUNT = 5
# A form is at least so many times as frequent as its variant.
FORM_TIMES = 5
# A run loses a code point when its checksum is a multiple of this.
NOISE_EVERY = 199
# Most candidates of a list that is joined as it is.
LIST_PAIRS = 1024
# Distinct words a task holds before it hands its counts on.
HELD_WORDS = 200_000

_RUN = re.compile(r"[a-zÀ-ÿ]{%d,}" % LEAST_CHARS)
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def runs_of(doc_id: int | None, text: str, noise_every: int = NOISE_EVERY) -> Counter:
    """Counted runs of a text in lower case (A-Z only), some of them without one code point.

    The noise is that of the contract: a checksum of the id and the run picks the run and the place.
    """
    found = Counter(map(itemgetter(0), _RUN.finditer(text.encode().translate(_LOWER).decode())))
    if not noise_every:
        return found
    head = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    changed: Counter = Counter()
    for run, n in found.items():
        check = zlib.crc32(run.encode(), head)
        if check % noise_every == 0:
            place = check % len(run)
            changed[run[:place] + run[place + 1 :]] += n
            changed[run] -= n
    found.update(changed)
    return +found


def word_counts(df: DataFrame, noise_every: int = NOISE_EVERY, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(word, n) of all runs of at least ``LEAST_CHARS``; tasks add up before anything is shuffled."""
    names = ["word", "n"]

    def batch_of(held: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        for batch in batches:
            for one, content in zip(batch.column(0), batch.column(1)):
                held.update(runs_of(one.as_py(), content.as_py(), noise_every))
                if len(held) > HELD_WORDS:
                    yield batch_of(held)
                    held.clear()
        yield batch_of(held)

    parts = base.id_and_text(df, doc_id, text).mapInArrow(run, "word string, n long")
    return parts.filter(F.char_length("word") >= LEAST_CHARS).groupBy("word").agg(F.sum("n").alias("n"))


def _open_interval(lo: Column, hi: Column, extra: Column) -> list[Column]:
    """The row of one word whose edit lies in [lo, hi) of the shorter word: its key covers all the rest.

    ``extra`` is how much longer this word is than the shorter one; what follows the edit is shifted by it.
    """
    before = F.substring(F.col("word"), F.lit(1), lo)
    after = F.substring(F.col("word"), hi + extra + 1, F.char_length("word"))
    size = F.char_length("word") - extra
    return [F.xxhash64(size, lo, hi, before, after).alias("key"), lo.alias("lo"), hi.alias("hi")]


def chunk_rows(words: DataFrame) -> DataFrame:
    """The two chunks of every word (``gram`` false) and its grams for shorter words and those of its length."""
    size = F.char_length("word")
    half, half_shorter = F.floor(size / 2).cast("int"), F.floor((size - 1) / 2).cast("int")

    def pick(gram: bool, extra: int, lo: Column, hi: Column) -> Column:
        return F.struct(F.lit(gram).alias("gram"), F.lit(extra).alias("extra"), lo.alias("lo"), hi.alias("hi"))

    zero = F.lit(0)
    picks = [pick(gram, 0, *ends) for gram in (False, True) for ends in ((zero, half), (half, size))]
    picks += [pick(True, 1, zero, half_shorter), pick(True, 1, half_shorter, size - 1)]
    rows = words.select("word", "n", F.explode(F.array(*picks)).alias("p")).select("word", "n", "p.*")
    return rows.select("word", "n", "gram", "extra", *_open_interval(F.col("lo"), F.col("hi"), F.col("extra")))


def halved(rows: DataFrame) -> DataFrame:
    """Each row as two, with the first and the second half of its open interval."""
    middle = F.floor((F.col("lo") + F.col("hi")) / 2).cast("int")
    parts = F.array(F.struct(F.col("lo"), middle.alias("hi")), F.struct(middle.alias("lo"), F.col("hi")))
    cut = rows.select("word", "n", "gram", "extra", F.explode(parts).alias("p")).select("word", "n", "gram", "extra", "p.*")
    return cut.select("word", "n", "gram", "extra", *_open_interval(F.col("lo"), F.col("hi"), F.col("extra")))


def candidate_lists(words: DataFrame, list_pairs: int = LIST_PAIRS) -> DataFrame:
    """Chunk and gram rows by key, long lists cut again until they are short or differ at one place."""
    rows = base.stage_table(chunk_rows(words), "chunks")
    short = []
    while True:
        grams = F.sum(F.col("gram").cast("long"))
        sizes = rows.groupBy("key").agg(grams.alias("grams"), (F.count(F.lit(1)) - grams).alias("chunks"), F.max(F.col("hi") - F.col("lo")).alias("width"))
        matched = F.col("grams") * F.col("chunks")
        # a long list without a chunk, or without a gram, holds no candidate at all
        alone = (matched == 0) & (F.col("grams") + F.col("chunks") > list_pairs)
        long = sizes.select("key", alone.alias("alone"), ((matched > list_pairs) & (F.col("width") > 1)).alias("cut"))
        long = base.stage_table(long.filter("alone OR cut"), "long-lists")
        number = long.count()
        if not number:
            break
        hinted = base.broadcast_if_small(long, number)
        short.append(rows.join(hinted, "key", "left_anti"))
        rows = base.stage_table(halved(rows.join(hinted.filter("cut").select("key"), "key", "left_semi")), "chunks")
    for part in short:
        rows = rows.unionByName(part)
    return rows


def near_pairs(words: DataFrame, list_pairs: int = LIST_PAIRS) -> DataFrame:
    """(word, n, near, near_n), each pair of near words once."""
    lists = candidate_lists(words, list_pairs)
    chunks = lists.filter(~F.col("gram")).select("key", F.col("word").alias("word"), "n")
    grams = lists.filter("gram").select("key", F.col("word").alias("near"), F.col("n").alias("near_n"), "extra")
    pairs = chunks.join(grams, "key").filter((F.col("extra") == 1) | (F.col("word") < F.col("near")))
    near = pairs.filter(F.levenshtein("word", "near", 1) == 1)
    # a pair can share several chunks, as when a letter is doubled
    return near.select("word", "n", "near", "near_n").distinct()


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) for pointers (word, form): each round doubles the steps a pointer spans.

    A form is several times as frequent as its variant, so there are no cycles and paths are short.
    """
    now = base.stage_table(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        further = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = base.stage_table(now.join(further, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "roots")
        if moved.filter("moved").isEmpty():
            return moved.select("word", "root")
        now = moved.select("word", "root")


def variants(words: DataFrame, form_times: int = FORM_TIMES, list_pairs: int = LIST_PAIRS) -> DataFrame:
    """One row per row of ``words`` (word, n): word, form, root, n, n_near, form_n."""
    pairs = base.stage_table(near_pairs(words, list_pairs), "near")
    turned = pairs.select(F.col("near").alias("word"), F.col("near_n").alias("n"), F.col("word").alias("near"), F.col("n").alias("near_n"))
    best = pairs.unionByName(turned).groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("minus"), F.col("near"))).alias("best")
    )
    seen = words.join(best, "word", "left")
    clear = -F.col("best.minus") >= form_times * F.col("n")
    told = base.stage_table(
        seen.select(
            "word",
            F.when(clear, F.col("best.near")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
            F.when(clear, -F.col("best.minus")).alias("form_n"),
        ),
        "forms",
    )
    ends = roots(told.filter("form IS NOT NULL"))
    joined = told.join(ends, "word", "left")
    return joined.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def variant_groups(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Spelling variants among the frequent words of a table of texts."""
    counted = word_counts(df, NOISE_EVERY, doc_id, text).filter(F.col("n") >= LEAST_COUNT)
    return variants(base.stage_table(counted, "words"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variant_groups(base.read(spark, sf_dir, "documents"))


# The checksum is folded from the bytes; near words meet by place and rest of one deleted code point.
SQL = f"""
WITH step AS (
  SELECT range AS n, list_reduce(list_prepend(range, range(8)),
    lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v
  FROM range(256)
),
crc AS (SELECT list(v ORDER BY n) AS t FROM step),
texts AS (
  SELECT coalesce(doc_id::VARCHAR, '') AS id,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
  FROM documents
),
runs AS (
  SELECT id, run, count(*) AS n
  FROM (SELECT id, unnest(regexp_extract_all(text, '[a-zÀ-ÿ]+')) AS run FROM texts)
  WHERE length(run) >= {LEAST_CHARS} GROUP BY ALL
),
bytes AS (
  SELECT run, n, list_transform(regexp_extract_all(hex(encode(id || ':' || run)), '..'), lambda h: ('0x' || h)::BIGINT) AS b
  FROM runs
),
checked AS (
  SELECT run, n, xor(list_reduce(list_prepend(4294967295::BIGINT, b),
    lambda c, x: xor(t[(xor(c, x) & 255) + 1], c >> 8)), 4294967295) AS h
  FROM bytes, crc
),
spelled AS (
  SELECT CASE WHEN h % {NOISE_EVERY} = 0
    THEN substring(run, 1, h % length(run)) || substring(run, h % length(run) + 2, length(run)) ELSE run END AS word, n
  FROM checked
),
words AS (
  SELECT word, sum(n)::BIGINT AS n FROM spelled WHERE length(word) >= {LEAST_CHARS}
  GROUP BY word HAVING sum(n) >= {LEAST_COUNT}
),
shorter AS (
  SELECT word, n, i, length(word) AS size, substring(word, 1, i - 1) || substring(word, i + 1, length(word)) AS rest
  FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)
),
pairs AS (
  SELECT a.word, b.word AS near, b.n AS near_n FROM shorter a JOIN shorter b USING (i, size, rest) WHERE a.word <> b.word
  UNION SELECT s.word, w.word, w.n FROM shorter s JOIN words w ON s.rest = w.word
  UNION SELECT w.word, s.word, s.n FROM shorter s JOIN words w ON s.rest = w.word
),
ranked AS (
  SELECT word, near, near_n, count(*) OVER (PARTITION BY word) AS n_near,
    row_number() OVER (PARTITION BY word ORDER BY near_n DESC, near) AS place
  FROM pairs
),
told AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near,
    CASE WHEN near_n >= {FORM_TIMES} * w.n THEN near END AS form, CASE WHEN near_n >= {FORM_TIMES} * w.n THEN near_n END AS form_n
  FROM words w LEFT JOIN ranked r ON w.word = r.word AND place = 1
),
chains AS (
  WITH RECURSIVE steps AS (
    SELECT word, word AS at FROM told
    UNION ALL SELECT s.word, t.form FROM steps s JOIN told t ON s.at = t.word WHERE t.form IS NOT NULL
  )
  SELECT s.word, s.at AS root FROM steps s JOIN told t ON s.at = t.word WHERE t.form IS NULL
)
SELECT word, form, root, n, n_near, form_n FROM told JOIN chains USING (word)
"""
