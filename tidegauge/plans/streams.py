"""Queries that run a stream over the tables, and lake round trips."""

from __future__ import annotations

import time
import uuid
from pyspark.sql import functions as F

from tidegauge.functions.anyvalue import last_match
from tidegauge.operators import filters
from tidegauge.operators.clean import count_rows, drop_null_rows
from tidegauge.plans import decoding, filtering, grid, tables
from tidegauge.session import checkpoint_root
from tidegauge.sources import lake, topics
from tidegauge.streaming import flush, ingest


def _run_root(spark, name):
    """A folder of its own for every run, so that no earlier checkpoint is picked up."""
    return f"{checkpoint_root(spark)}/tidegauge/runs/{name}-{uuid.uuid4().hex}"


# Messages of one file, and bytes of files that a micro-batch takes for each core.
FILE_MESSAGES, BATCH_BYTES = 4096, 32_000_000
# Rows of one slice of a stream in time order; a batch takes a slice for each core.
SLICE_ROWS = 1 << 17
# How many batches or slices even a small table is cut in, and how many batches a large one, since each costs some
# seconds whatever it holds.
LEAST_BATCHES, MOST_BATCHES, LEAST_SLICES = 3, 48, 3


def _message_files(texts, root):
    """Files by size, so that a batch has as many tasks and a stream as many batches as there are messages for."""
    texts.select("value").write.mode("append").option("maxRecordsPerFile", FILE_MESSAGES).text(root)
    return root


def _bytes_of(spark, root):
    """Bytes of all files in a folder."""
    place = spark._jvm.org.apache.hadoop.fs.Path(root)
    files = place.getFileSystem(spark._jsc.hadoopConfiguration())
    return files.getContentSummary(place).getLength() if files.exists(place) else 0


def _batch_bytes(spark, files):
    """Bytes of a micro-batch: work for every core, since batches follow one another, within the numbers of batches."""
    total = _bytes_of(spark, files)
    every_core = BATCH_BYTES * spark.sparkContext.defaultParallelism
    return max(1, min(max(every_core, -(-total // MOST_BATCHES)), -(-total // LEAST_BATCHES)))


def _ended(query, batches: int = 0):
    """Wait for a stream that takes what is there, and make sure that it went on in micro-batches."""
    query.awaitTermination()
    taken = sum(progress.numInputRows > 0 for progress in query.recentProgress)
    if taken < batches:
        raise RuntimeError(f"the stream took {taken} batches, not {batches}")


def _mixed_ingest(spark, sf_dir, root):
    """Metric and log messages in one stream of files, into both tables."""
    texts = tables.otlp_messages(spark, sf_dir).select("value").unionByName(
        tables.otlp_log_messages(spark, sf_dir).select("value")
    )
    files = _message_files(texts, f"{root}/messages")
    stream = topics.read_message_files(spark, files, max_bytes=_batch_bytes(spark, files))
    sink = ingest.LakeSink(f"{root}/lake", metric_steps=[lambda df: drop_null_rows(df, "value")])
    _ended(ingest.ingest(stream, sink, f"{root}/offsets"))


def stream_ingest(spark, sf_dir):
    """Message files streamed into the lake in several micro-batches; the metrics read back."""
    root = _run_root(spark, "ingest")
    _mixed_ingest(spark, sf_dir, root)
    rows = lake.read_rows(spark, f"{root}/lake/metrics")
    attributes = F.col("attributes")
    return rows.select(
        F.unix_micros("timestamp").alias("ts_us"),
        F.col("__name__").alias("name"),
        tables.shown("value").alias("value"),
        "service_name",
        F.date_format(lake.DAY, "yyyy-MM-dd").alias("day"),
        last_match(attributes, "n").alias("n"),
    )


STREAM_INGEST_SQL = f"""
WITH lake AS ({decoding.OTLP_METRICS_LAKE_SQL})
SELECT ts_us, name, value, service_name, strftime(make_timestamp(ts_us), '%Y-%m-%d') AS day, n
FROM lake WHERE value IS NOT NULL
"""


def stream_ingest_logs(spark, sf_dir):
    """The logs of the same stream."""
    root = _run_root(spark, "ingest-logs")
    _mixed_ingest(spark, sf_dir, root)
    rows = lake.read_rows(spark, f"{root}/lake/logs", "logs")
    return rows.select(F.unix_micros("timestamp").alias("ts_us"), "line", "service_name", "host", "env")


# Bytes that a flush of a lane gathers, those of a trigger for each lane, and how long a remainder waits.
FLUSH_BYTES, TRIGGER_BYTES, WAIT_MS = 3_000_000, 1_000_000, 2_000
# Flushes of one lane; more messages go over more lanes, so that the number of triggers does not grow with them.
LANE_FLUSHES = 8


def stream_flushed(spark, sf_dir):
    """Messages that come in small triggers, gathered to flushes of ``FLUSH_BYTES`` a lane; the metrics read back."""
    root = _run_root(spark, "flushed")
    texts = tables.otlp_messages(spark, sf_dir)
    files = _message_files(texts, f"{root}/messages")
    lanes = max(1, -(-_bytes_of(spark, files) // (FLUSH_BYTES * LANE_FLUSHES)))
    stream = topics.read_message_files(spark, files, max_bytes=TRIGGER_BYTES * lanes)
    sink = ingest.LakeSink(f"{root}/lake", metric_steps=[lambda df: drop_null_rows(df, "value")])
    query = flush.ingest_by_size(
        stream, sink, f"{root}/offsets", FLUSH_BYTES, WAIT_MS, lanes=lanes, interval="100 milliseconds"
    )
    flush.drain(query, WAIT_MS)
    rows = lake.read_rows(spark, f"{root}/lake/metrics")
    return rows.select(
        F.unix_micros("timestamp").alias("ts_us"), F.col("__name__").alias("name"), tables.shown("value").alias("value")
    )


STREAM_FLUSHED_SQL = f"""
WITH lake AS ({decoding.OTLP_METRICS_LAKE_SQL}) SELECT ts_us, name, value FROM lake WHERE value IS NOT NULL
"""

STREAM_INGEST_LOGS_SQL = f"""
WITH lake AS ({decoding.OTLP_LOGS_SQL}) SELECT ts_us, line, service_name, host, env FROM lake
"""


def stream_records(spark, sf_dir):
    """Message files mapped to flat stream records, written as JSON and read back."""
    root = _run_root(spark, "records")
    texts = tables.otlp_messages(spark, sf_dir).select("value")
    files = _message_files(texts, f"{root}/messages")
    stream = topics.read_message_files(spark, files, max_bytes=_batch_bytes(spark, files))
    records = ingest.stream_metrics(stream, decoding.RULES)
    query = (
        topics.as_messages(records)
        .writeStream.format("text")
        .option("checkpointLocation", f"{root}/offsets")
        .trigger(availableNow=True)
        .start(f"{root}/records")
    )
    _ended(query)
    out = spark.read.text(f"{root}/records")
    return out.select(
        F.get_json_object("value", "$.timestamp").cast("bigint").alias("ts_ns"),
        F.get_json_object("value", "$.__name__").alias("name"),
        tables.shown(F.get_json_object("value", "$.value").cast("double")).alias("value"),
        F.get_json_object("value", "$.count").cast("bigint").alias("n_count"),
        F.get_json_object("value", "$.host").alias("host"),
    )


STREAM_RECORDS_SQL = f"""
WITH r AS ({decoding.OTLP_METRICS_STREAM_SQL}) SELECT ts_ns, name, value, n_count, host FROM r
"""


def _in_time_order(spark, rows, root, slice_rows=SLICE_ROWS):
    """Rows written once as one file for each slice of time; a file stream takes the files in that order.

    The source goes by the time a file was changed, so the files are dated in the order of their slices. Rows of
    one time are in one slice.
    """
    number = max(LEAST_SLICES, -(-rows.count() // slice_rows))
    rows.repartitionByRange(number, "timestamp").sortWithinPartitions("timestamp").write.mode("append").parquet(root)
    place = spark._jvm.org.apache.hadoop.fs.Path(root)
    files = place.getFileSystem(spark._jsc.hadoopConfiguration())
    found = sorted(s.getPath().getName() for s in files.listStatus(place) if s.getPath().getName().startswith("part-"))
    start = int(time.time()) - len(found)
    for k, name in enumerate(found):
        files.setTimes(spark._jvm.org.apache.hadoop.fs.Path(f"{root}/{name}"), (start + k) * 1000, -1)
    return len(found)


def stream_training_aggregate(spark, sf_dir):
    """The training aggregate over a stream of metric rows in time order, a few slices of the time a batch.

    No row is behind the watermark, since a batch holds slices that follow one another. State is bounded: only buckets within the
    lateness are kept. Each batch writes the means of the buckets it touched; the latest batch of a bucket counts.
    """
    root = _run_root(spark, "aggregate")
    rows = tables.metric_rows(spark, sf_dir).drop("event_id").withColumns(
        {c: F.lit(None).cast("string") for c in ("k8s_namespace_name", "cluster_name", "host", "env")}
    )
    slices = _in_time_order(spark, rows, f"{root}/metrics")
    together = max(1, min(spark.sparkContext.defaultParallelism, slices // LEAST_SLICES))
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", str(together)).parquet(f"{root}/metrics")
    aggregate = ingest.running_training_aggregate(stream)
    query = (
        aggregate.writeStream.outputMode("update")
        .foreachBatch(ingest.means_writer(f"{root}/means"))
        .option("checkpointLocation", f"{root}/offsets")
        .trigger(availableNow=True)
        .start()
    )
    _ended(query)
    written = spark.read.schema(aggregate.schema.add(ingest.MEANS_BATCH, "long")).parquet(f"{root}/means")
    means = ingest.latest_means(written)
    return means.select(
        F.col("timestamp").alias("bucket_ms"),
        F.col("__name__").alias("name"),
        last_match(F.col("attributes"), "k").alias("k"),
        last_match(F.col("resource_attributes"), "user").alias("user_id"),
        tables.shown("value").alias("value"),
    )


STREAM_TRAINING_SQL = grid.TRAINING_SQL.replace(
    "WHERE ts > TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 7 DAY", ""
)


def lake_recent(spark, sf_dir):
    """Metric rows appended to the lake, recent days read with partition pruning."""
    root = _run_root(spark, "lake")
    rows = tables.metric_rows(spark, sf_dir).drop("event_id")
    lake.append_rows(rows, root)
    recent = lake.read_recent(spark, root, 7, tables.AS_OF)
    return recent.select(
        F.unix_micros("timestamp").alias("ts_us"),
        F.col("__name__").alias("name"),
        "value",
        "host",
        F.date_format(lake.DAY, "yyyy-MM-dd").alias("day"),
    )


LAKE_RECENT_SQL = """
SELECT epoch_us(ts) AS ts_us, event_type AS name, value, CAST(NULL AS VARCHAR) AS host,
       strftime(ts, '%Y-%m-%d') AS day
FROM events WHERE ts > TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 7 DAY
"""


def _batched_rows(spark, sf_dir, root, hold="false"):
    """All rows, written as three batches but for those to hold back."""
    rows = tables.metric_rows(spark, sf_dir)
    for k in range(3):
        lake.write_batch(rows.filter((F.col("event_id") % 3 == k) & ~F.expr(hold)).drop("event_id"), root, f"b-{k}")
    return rows


def _lake_rows(spark, root):
    return lake.read_rows(spark, root).select(
        F.unix_micros("timestamp").alias("ts_us"),
        F.col("__name__").alias("name"),
        "value",
        F.date_format(lake.DAY, "yyyy-MM-dd").alias("day"),
    )


def lake_compacted(spark, sf_dir):
    """Three batches, then each day compacted but the last two: the rows stay, the partitions go.

    A batch of the first compacted day comes late; the replaced batches of every other day are deleted.
    """
    root = _run_root(spark, "compacted")
    rows = _batched_rows(spark, sf_dir, root, hold="event_id % 50 = 7")
    days = [r[0] for r in rows.select(F.to_date("timestamp")).dropna().distinct().orderBy(1).collect()]
    for number, day in enumerate(days[:-2] or days):
        if lake.compact(spark, root, day) < 1 or len(lake.batches_of(spark, root, day)) != 1:
            raise RuntimeError(f"nothing to compact on {day}")
        if number % 2:
            lake.drop_replaced(spark, root, day)
    lake.write_batch(rows.filter(F.col("event_id") % 50 == 7).drop("event_id"), root, "late")
    for day in days[:1]:
        lake.compact(spark, root, day)
    return _lake_rows(spark, root)


def lake_replayed(spark, sf_dir):
    """One of three batches written twice, as after a lost driver; it counts once."""
    root = _run_root(spark, "replayed")
    rows = _batched_rows(spark, sf_dir, root)
    lake.write_batch(rows.filter(F.col("event_id") % 3 == 1).drop("event_id"), root, "b-1")
    return _lake_rows(spark, root)


LAKE_ROWS_SQL = """
SELECT epoch_us(ts) AS ts_us, event_type AS name, value, strftime(ts, '%Y-%m-%d') AS day FROM events
"""


_CHAIN = [lake.Migration(1, {"zone": "STRING"}), lake.Migration(2, {"weight": "DOUBLE"})]


def lake_tables(spark, sf_dir):
    """Catalog tables created, filled, migrated by two versions and filled again; then dropped from the
    catalog, and their files read by path."""
    root = _run_root(spark, "tables")
    namespace = f"lake_{uuid.uuid4().hex}"
    lake.create_tables(spark, namespace, location=root)
    rows = tables.metric_rows(spark, sf_dir)
    old, new = rows.filter(F.col("__name__") != "view"), rows.filter(F.col("__name__") == "view")
    lake.append_table(old.drop("event_id"), namespace, "metrics")
    lake.migrate(spark, namespace, "metrics", _CHAIN[:1])
    lake.migrate(spark, namespace, "metrics", _CHAIN)
    if lake.migrate(spark, namespace, "metrics", _CHAIN) or lake.applied_version(spark, namespace, "metrics") != len(_CHAIN):
        raise RuntimeError("migrations were not applied once each")
    lake.append_table(new.drop("event_id").withColumns({"zone": F.lit("z"), "weight": F.col("value") / 2}), namespace, "metrics")
    schema = spark.table(f"{namespace}.metrics").schema
    for name in lake.TABLES:
        lake.drop_table(spark, namespace, name, purge=False)
    lake.drop_namespace(spark, namespace)
    stored = spark.read.schema(schema).parquet(f"{root}/metrics")
    return stored.select(
        F.unix_micros("timestamp").alias("ts_us"),
        F.col("__name__").alias("name"),
        "value",
        "zone",
        "weight",
        F.date_format(lake.DAY, "yyyy-MM-dd").alias("day"),
    )


LAKE_TABLES_SQL = """
SELECT epoch_us(ts) AS ts_us, event_type AS name, value, CASE WHEN event_type = 'view' THEN 'z' END AS zone,
       CASE WHEN event_type = 'view' THEN value / 2 END AS weight,
       strftime(ts, '%Y-%m-%d') AS day
FROM events
"""


def row_counters(spark, sf_dir):
    """Rows seen, kept and filtered by the include rules, counted while the rows pass."""
    rows = tables.metric_rows(spark, sf_dir)
    counted, seen = count_rows(rows, "include", kept=filters.include_predicate(filtering.INCLUDE))
    counted.write.format("noop").mode("overwrite").save()
    found = seen.get
    return spark.createDataFrame(
        [(found["rows"], found["kept_rows"], found["filtered_rows"])],
        "n_rows bigint, kept_rows bigint, filtered_rows bigint",
    )


ROW_COUNTERS_SQL = f"""
WITH kept AS ({filtering.METRIC_INCLUDE_SQL}), n AS (SELECT count(*) AS n FROM events), k AS (SELECT count(*) AS k FROM kept)
SELECT n AS n_rows, k AS kept_rows, n - k AS filtered_rows FROM n, k
"""


QUERIES = {
    "lake_tables": (lake_tables, LAKE_TABLES_SQL),
    "row_counters": (row_counters, ROW_COUNTERS_SQL),
    "stream_ingest": (stream_ingest, STREAM_INGEST_SQL),
    "stream_ingest_logs": (stream_ingest_logs, STREAM_INGEST_LOGS_SQL),
    "stream_flushed": (stream_flushed, STREAM_FLUSHED_SQL),
    "stream_records": (stream_records, STREAM_RECORDS_SQL),
    "stream_training_aggregate": (stream_training_aggregate, STREAM_TRAINING_SQL),
    "lake_compacted": (lake_compacted, LAKE_ROWS_SQL),
    "lake_replayed": (lake_replayed, LAKE_ROWS_SQL),
    "lake_recent": (lake_recent, LAKE_RECENT_SQL),
}
