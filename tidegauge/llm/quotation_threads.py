"""Conversations from messages that quote each other.

A line's quote level is the number of ``>`` in front of it. Quoted lines are normalised (lower case,
runs of blanks as one) and hashed, and joined by hash to the latest earlier message of the conversation
whose own lines hold the same passage. A message answers the message that most of its first-level
passages come from (of deeper levels, if no first-level passage is found; the later one on ties).
Following answers back gives the thread's first message; a conversation is ordered by thread, then turn,
so that an answer stands with what it answers. Bodies hold no quotes.

Every passage has one source, found by one window over (conversation, hash), never by pairs. A hot
conversation is spread by hash, and its order comes from a range sort.

Defined results: NULL texts are empty; a row without conversation or turn is never linked; rows that
repeat a turn are one message for linking and stay rows of their own; an empty table gives an empty one;
other columns are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidegauge.llm import base
from tidegauge.operators.ordering import with_row_index

_MARK = "^((?:> ?)+)"
# Doublings of the distance walked back; threads of 2**40 answers are beyond any table.
MOST_ROUNDS = 40


def quote_level(line: Column) -> Column:
    return F.length(F.replace(F.regexp_extract(line, _MARK, 1), F.lit(" "), F.lit("")))


def normalised(line: Column) -> Column:
    """The line without quote marks, in lower case, with runs of blanks as one."""
    bare = F.regexp_replace(line, _MARK, "")
    return F.btrim(F.regexp_replace(F.lower(bare), "[ \\t\\r\\u000b\\f]+", " "))


def _messages(df: DataFrame, conv_id: str, turn: str, role: str, text: str) -> DataFrame:
    lines = F.split(F.coalesce(F.col("text"), F.lit("")), "\n", -1)
    named = df.select(
        F.col(f"`{conv_id}`").alias("conv_id"),
        F.col(f"`{turn}`").cast("long").alias("turn"),
        F.col(f"`{role}`").alias("role"),
        F.col(f"`{text}`").alias("text"),
    )
    return named.withColumn("lines", lines).drop("text")


def passages(messages: DataFrame) -> DataFrame:
    """(conv_id, turn, level, hash_a, hash_b) of all lines with content, once per message and level."""
    lines = messages.filter("conv_id IS NOT NULL AND turn IS NOT NULL").select(
        "conv_id", "turn", F.explode("lines").alias("line")
    )
    keyed = lines.select("conv_id", "turn", quote_level(F.col("line")).alias("level"), normalised(F.col("line")).alias("key"))
    hash_a, hash_b = base.hash128(F.col("key"))
    return keyed.filter("key <> ''").select("conv_id", "turn", "level", hash_a.alias("hash_a"), hash_b.alias("hash_b")).distinct()


def sources(lines: DataFrame) -> DataFrame:
    """(conv_id, turn, level, source) for each quoted passage with an earlier original."""
    before = Window.partitionBy("conv_id", "hash_a", "hash_b").orderBy("turn").rangeBetween(Window.unboundedPreceding, -1)
    own = F.when(F.col("level") == 0, F.col("turn"))
    found = lines.withColumn("source", F.max(own).over(before))
    return found.filter("level > 0 AND source IS NOT NULL").select("conv_id", "turn", "level", "source")


def answers(found: DataFrame) -> DataFrame:
    """(conv_id, turn, reply_to) of the messages that quote an earlier one."""
    counts = found.groupBy("conv_id", "turn", "level", "source").agg(F.count(F.lit(1)).alias("passages"))
    best = F.max_by("source", F.struct(-F.col("level"), "passages", "source"))
    return counts.groupBy("conv_id", "turn").agg(best.alias("reply_to"))


def thread_starts(replies: DataFrame) -> DataFrame:
    """(conv_id, turn, reply_to, thread): the message each chain of answers goes back to."""
    walked = base.stage_table(replies.withColumn("thread", F.col("reply_to")), "answers")
    for _ in range(MOST_ROUNDS):
        ahead = walked.select("conv_id", F.col("turn").alias("thread"), F.col("thread").alias("further"))
        step = walked.join(ahead, ["conv_id", "thread"], "left")
        if step.filter(F.col("further").isNotNull()).isEmpty():
            break
        walked = base.stage_table(
            step.select("conv_id", "turn", "reply_to", F.coalesce("further", "thread").alias("thread")), "answers"
        )
    return walked


def threads(
    df: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """One row per message: conv_id, turn, role, body (own lines), quoted_lines, quote_depth, reply_to,
    thread (turn of the thread's first message), position (0, 1, ... in the conversation's order)."""
    messages = _messages(df, conv_id, turn, role, text)
    levels = F.transform("lines", quote_level)
    bodies = messages.select(
        "conv_id",
        "turn",
        "role",
        F.btrim(F.concat_ws("\n", F.filter("lines", lambda x: quote_level(x) == 0)), F.lit(" \t\r\n\u000b\f")).alias("body"),
        F.size(F.filter(levels, lambda n: n > 0)).cast("long").alias("quoted_lines"),
        F.array_max(levels).cast("long").alias("quote_depth"),
    )
    linked = thread_starts(answers(sources(passages(messages))))
    joined = bodies.join(linked, ["conv_id", "turn"], "left").withColumn("thread", F.coalesce("thread", "turn"))
    return with_row_index(joined, ("thread", "turn", "role", "body"), ("conv_id",), "position")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = threads(base.read(spark, sf_dir, "conversations"))
    return found.select(
        "conv_id", "turn", "role", "quoted_lines", "quote_depth", "reply_to", "thread", "position",
        F.sha2(F.col("body").cast("binary"), 256).alias("body_sha256"),
    )


_SQL_KEY = r"trim(regexp_replace(lower(regexp_replace(line, '^((?:> ?)+)', '')), '[ \t\r\v\f]+', ' ', 'g'))"
SQL = f"""
WITH RECURSIVE messages AS (
  SELECT conv_id, turn::BIGINT AS turn, role, string_split(coalesce(text, ''), chr(10)) AS lines FROM conversations
),
lines AS (
  SELECT conv_id, turn, line, length(replace(regexp_extract(line, '^((?:> ?)+)', 1), ' ', '')) AS level
  FROM (SELECT conv_id, turn, unnest(lines) AS line FROM messages)
),
passages AS (
  SELECT DISTINCT conv_id, turn, level, {_SQL_KEY} AS key FROM lines WHERE {_SQL_KEY} <> ''
),
sources AS (
  SELECT q.conv_id, q.turn, q.level, q.key, max(o.turn) AS source
  FROM passages q JOIN passages o ON o.conv_id = q.conv_id AND o.key = q.key AND o.level = 0 AND o.turn < q.turn
  WHERE q.level > 0 GROUP BY ALL
),
counts AS (SELECT conv_id, turn, level, source, count(*) AS n FROM sources GROUP BY ALL),
answers AS (
  SELECT conv_id, turn, first(source ORDER BY level, n DESC, source DESC) AS reply_to FROM counts GROUP BY conv_id, turn
),
walk AS (
  SELECT conv_id, turn, reply_to AS thread FROM answers
  UNION ALL
  SELECT w.conv_id, w.turn, a.reply_to FROM walk w JOIN answers a ON a.conv_id = w.conv_id AND a.turn = w.thread
),
starts AS (SELECT conv_id, turn, min(thread) AS thread FROM walk GROUP BY conv_id, turn),
bodies AS (
  SELECT conv_id, turn, role,
    trim(array_to_string(list_filter(lines, lambda x: NOT regexp_matches(x, '^>')), chr(10)),
      ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS body,
    len(list_filter(lines, lambda x: regexp_matches(x, '^>'))) AS quoted_lines,
    list_max(list_transform(lines, lambda x: length(replace(regexp_extract(x, '^((?:> ?)+)', 1), ' ', '')))) AS quote_depth
  FROM messages
)
SELECT conv_id, turn, role, quoted_lines, quote_depth, reply_to, coalesce(thread, turn) AS thread,
  row_number() OVER (PARTITION BY conv_id ORDER BY coalesce(thread, turn), turn, role, body) - 1 AS position,
  sha256(body) AS body_sha256
FROM bodies LEFT JOIN answers USING (conv_id, turn) LEFT JOIN starts USING (conv_id, turn)
"""
