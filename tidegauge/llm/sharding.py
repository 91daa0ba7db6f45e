"""Sharding by proportional stratified interleaving.

Rows are ranked in a seeded random order inside their source; a row's fractional rank is its rank over
the number of rows of its source. Sorted by fractional rank the sources lie interleaved in proportion,
so equal cuts of that order give shards of equal row counts that all hold the mixture.

Nothing is sorted as a whole. Both orders are split into fine buckets, whose row counts are summed up
before the rows are ranked inside their bucket: a source with most of the rows is many buckets, and the
result is a function of the data alone, so lost tasks may run again.

Defined results: a NULL source is a source of its own; a NULL text has no bytes and the size 1; rows
that are repeated whole are placed each; an empty table gives an empty one; other columns are ignored,
whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidegauge.llm import base

SHARDS = 8
SEED = 20240229
# Rows that a bucket of either order holds on average.
BUCKET_ROWS = 4096
# The random order uses the first 15 hex digits of an MD5 digest.
_HEX_DIGITS = 15
_ORDER_RANGE = 16**_HEX_DIGITS


def random_order(doc_id: Column, seed: int) -> Column:
    """A 60-bit pseudo-random number of the row."""
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), doc_id.cast("string")).cast("binary"))
    return F.conv(F.substring(digest, 1, _HEX_DIGITS), 16, 10).cast("long")


def _placed_before(counts: DataFrame, keys: list[str], bucket: str) -> DataFrame:
    """Rows in the buckets before each bucket, per key."""
    before = Window.partitionBy(*keys).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumn("_before", F.coalesce(F.sum("_rows").over(before), F.lit(0)))


def fractional_ranks(rows: DataFrame, buckets: int) -> DataFrame:
    """Add ``rank`` (0, 1, ... in random order inside the source) and ``source_rows``."""
    keys = ["source", "bucket"]
    width = -(-_ORDER_RANGE // buckets)
    bucketed = rows.withColumn("bucket", F.expr(f"random_rank div {width}L"))
    counts = bucketed.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    starts = _placed_before(counts, ["source"], "bucket").withColumn(
        "source_rows", F.sum("_rows").over(Window.partitionBy("source"))
    )
    inside = Window.partitionBy(*keys).orderBy("random_rank", "doc_id", "size", "text_crc32")
    ranked = bucketed.withColumn("_inside", F.row_number().over(inside) - 1)
    other = starts.select(
        F.col("source").alias("_source"), F.col("bucket").alias("_bucket"), "_before", "source_rows"
    )
    same = F.col("source").eqNullSafe(F.col("_source")) & (F.col("bucket") == F.col("_bucket"))
    return (
        ranked.join(other, same)
        .withColumn("rank", F.col("_before") + F.col("_inside"))
        .drop("_source", "_bucket", "bucket", "_before", "_inside")
    )


def interleaved(ranked: DataFrame, buckets: int) -> DataFrame:
    """Add ``position``: the place in the order by fractional rank, then source, then rank."""
    # (2 rank + 1) / (2 source_rows) lies between 0 and 1; the bucket is exact integer arithmetic
    bucketed = ranked.withColumn(
        "slice", F.expr(f"((2 * rank + 1) * {buckets}L) div (2 * source_rows)")
    )
    counts = bucketed.groupBy("slice").agg(F.count(F.lit(1)).alias("_rows"))
    # one row per slice, thousands of documents each
    starts = _placed_before(counts, [], "slice").drop("_rows")
    fraction = (2 * F.col("rank") + 1) / (2 * F.col("source_rows"))
    inside = Window.partitionBy("slice").orderBy(fraction, "source", "rank")
    return (
        bucketed.withColumn("_inside", F.row_number().over(inside) - 1)
        .join(starts, "slice")
        .withColumn("position", F.col("_before") + F.col("_inside"))
        .drop("slice", "_before", "_inside")
    )


def shard(
    df: DataFrame,
    shards: int = SHARDS,
    seed: int = SEED,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """Give every row a shard and a place in it; row counts of shards differ by one at most.

    One row per input row: doc_id, source, size (UTF-8 bytes of the text plus 1), text_crc32, shard,
    slot (0, 1, ... inside the shard).
    """
    rows = df.select(
        F.col(doc_id).alias("doc_id"),
        F.col(source).alias("source"),
        F.coalesce(F.octet_length(text).cast("long"), F.lit(0)).alias("bytes"),
        F.crc32(F.coalesce(F.col(text), F.lit("")).cast("binary")).alias("text_crc32"),
        random_order(F.coalesce(F.col(doc_id).cast("string"), F.lit("")), seed).alias("random_rank"),
    ).select("doc_id", "source", (F.col("bytes") + 1).alias("size"), "text_crc32", "random_rank")
    total = df.count()
    buckets = max(1, total // bucket_rows)
    placed = interleaved(fractional_ranks(rows, buckets), buckets)
    number = F.expr(f"(position * {shards}L) div {max(total, 1)}L")
    first = F.expr(f"(shard * {max(total, 1)}L + {shards - 1}L) div {shards}L")
    return (
        placed.withColumn("shard", number)
        .withColumn("slot", F.col("position") - first)
        .select("doc_id", "source", "size", "text_crc32", F.col("shard").cast("int").alias("shard"), "slot")
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = shard(base.read(spark, sf_dir, "documents"))
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


# The twin of everything but the checksum, which DuckDB lacks as a function: it is folded from the bytes.
SQL = f"""
WITH step AS (
  SELECT range AS n, list_reduce(list_prepend(range, range(8)),
    lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v
  FROM range(256)
),
crc AS (SELECT list(v ORDER BY n) AS t FROM step),
bytes AS (
  SELECT doc_id, source, coalesce(strlen(text), 0) + 1 AS size,
    ('0x' || substr(md5('{SEED}:' || coalesce(doc_id::VARCHAR, '')), 1, {_HEX_DIGITS}))::BIGINT AS random_rank,
    list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda h: ('0x' || h)::BIGINT) AS b
  FROM documents
),
rows AS (
  SELECT doc_id, source, size, random_rank,
    xor(list_reduce(list_prepend(4294967295::BIGINT, b), lambda c, x: xor(t[(xor(c, x) & 255) + 1], c >> 8)), 4294967295)
      AS text_crc32
  FROM bytes, crc
),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY random_rank, doc_id) - 1 AS rank,
    count(*) OVER (PARTITION BY source) AS source_rows, count(*) OVER () AS total
  FROM rows
),
placed AS (
  SELECT *, row_number() OVER (
    ORDER BY (2 * rank + 1)::DOUBLE / (2 * source_rows), source NULLS FIRST, rank) - 1 AS position
  FROM ranked
)
SELECT doc_id, size, text_crc32, 'rows' AS law, (position * {SHARDS} // total)::INT AS shard,
  position - ((position * {SHARDS} // total) * total + {SHARDS - 1}) // {SHARDS} AS slot,
  CAST(NULL AS INT) AS grown_shard
FROM placed
"""
