from __future__ import annotations

import json
import time
from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F

from check import compare
from tests.otlp import logs_message, metric, metrics_message, point
from tidegauge.operators import aggregates, decode
from tidegauge.operators.clean import count_rows
from tidegauge.plans import streams
from tidegauge.sources import lake, topics
from tidegauge.streaming import flush, ingest


def messages(n=6):
    out = []
    for i in range(n):
        m = json.loads(
            metrics_message(
                {"service.namespace": "a", "service.name": f"s{i % 2}"},
                [metric("cpu", "gauge", [point(1_700_000_000_000_000_000 + i * 10**11, asDouble=float(i), attributes={"i": i})])],
            )
        )
        m |= json.loads(logs_message({"service.name": "s"}, [{"timeUnixNano": str(i + 1), "body": {"stringValue": f"l{i}"}}]))
        out.append(json.dumps(m))
    return out


def write(folder, texts):
    folder.mkdir(parents=True, exist_ok=True)
    for i, text in enumerate(texts):
        (folder / f"part-{i:03d}.txt").write_text(text + "\n")
    return str(folder)


def run(spark, tmp_path, texts, max_bytes=None, **options):
    source = write(tmp_path / "in", texts)
    sink = ingest.LakeSink(str(tmp_path / "lake"), **options)
    stream = topics.read_message_files(spark, source, max_bytes)
    query = ingest.ingest(stream, sink, str(tmp_path / "offsets"))
    query.awaitTermination()
    return query


def test_stream_equals_batch(spark, tmp_path):
    texts = messages()
    query = run(spark, tmp_path, texts, max_bytes=700)
    assert len([p for p in query.recentProgress if p.numInputRows]) > 1
    batch = decode.parse_messages(spark.createDataFrame([(t,) for t in texts], "value string"))
    stored = lake.read_rows(spark, str(tmp_path / "lake/metrics")).drop(lake.DAY)
    assert stored.exceptAll(decode.flatten_metrics(batch)).isEmpty() and stored.count() == 6
    logs = lake.read_rows(spark, str(tmp_path / "lake/logs"), "logs")
    assert sorted(r["line"] for r in logs.collect()) == [f"l{i}" for i in range(6)]


def test_restart_takes_only_new_messages(spark, tmp_path):
    run(spark, tmp_path, messages(3))
    write(tmp_path / "in", messages(5))
    run(spark, tmp_path, messages(5)[:0] or messages(5))
    assert lake.read_rows(spark, str(tmp_path / "lake/metrics")).count() == 5


def test_failed_batch_runs_again_without_duplicates(spark, tmp_path):
    failing = {"left": 1}

    def fail_once(rows):
        if failing["left"]:
            failing["left"] -= 1
            raise RuntimeError("log table is away")
        return rows

    with pytest.raises(Exception, match="log table is away"):
        run(spark, tmp_path, messages(4), log_steps=[fail_once])
    run(spark, tmp_path, messages(4), log_steps=[fail_once])
    assert lake.read_rows(spark, str(tmp_path / "lake/metrics")).count() == 4
    assert lake.read_rows(spark, str(tmp_path / "lake/logs"), "logs").count() == 4


def test_replayed_batch_replaces_its_rows(spark, tmp_path):
    sink = ingest.LakeSink(str(tmp_path / "lake"))
    texts = spark.createDataFrame([(t,) for t in messages(4)], "value string")
    sink.write(texts, 0)
    sink.write(texts, 0)
    sink.write(texts.limit(1), 1)
    assert lake.read_rows(spark, str(tmp_path / "lake/metrics")).count() == 5


def test_bad_message_stops_or_is_set_aside(spark, tmp_path):
    texts = [*messages(2), "{broken"]
    with pytest.raises(Exception):
        run(spark, tmp_path / "fail", texts)
    run(spark, tmp_path / "aside", texts, on_error="quarantine")
    assert lake.read_rows(spark, str(tmp_path / "aside/lake/metrics")).count() == 2
    assert [r["value"] for r in spark.read.parquet(str(tmp_path / "aside/lake/rejected")).collect()] == ["{broken"]


def test_include_rules_and_steps(spark, tmp_path):
    keep_late = lambda rows: rows.filter("value >= 4")
    run(spark, tmp_path, messages(), include=[{"name": "cpu"}], metric_steps=[keep_late])
    assert lake.read_rows(spark, str(tmp_path / "lake/metrics")).count() == 2
    nothing = tmp_path / "nothing"
    run(spark, nothing, messages(), include=[{"name": "absent"}])
    assert not (nothing / "lake/metrics").exists()


def memory(spark, df, name, mode="append"):
    query = df.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.table(name)


def test_stream_records_equal_batch(spark, tmp_path):
    texts = messages()
    rules = [{"service.namespace": "a", "service.name": "s1"}]
    stream = topics.read_message_files(spark, write(tmp_path / "in", texts))
    got = memory(spark, topics.as_messages(ingest.stream_metrics(stream, rules)), "records")
    values = sorted(json.loads(r["value"])["value"] for r in got.collect())
    assert values == [1.0, 3.0, 5.0]
    logs = memory(spark, ingest.stream_logs(stream, "quarantine"), "log_rows")
    assert logs.count() == 6


def test_running_aggregate_equals_batch(spark, tmp_path):
    run(spark, tmp_path, messages(12))
    root = str(tmp_path / "lake/metrics")
    rows = lake.read_rows(spark, root)
    stream = spark.readStream.schema(rows.schema).parquet(root)
    got = memory(spark, ingest.running_training_aggregate(stream), "means", "complete")
    batch = aggregates.training_aggregate(rows, days=100_000)
    key = lambda df: sorted((r["timestamp"], r["__name__"], r["value"]) for r in df.collect())
    assert key(got) == key(batch)


@pytest.mark.parametrize(
    "kept, months",
    [("true", 2), ("true", 14), ("event_id < 2", 1), ("event_id < 1", 1), ("event_id < 0", 1)],
)
def test_stream_over_months_drops_no_row(spark, tmp_path, kept, months):
    moved = F.expr(f"ts + make_interval(0, cast(event_id % {months} AS int))")
    given = spark.read.parquet("/root/testdata/sf0.001/events.parquet").filter(kept)
    given.withColumn("ts", moved).write.parquet(str(tmp_path / "events.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM '{tmp_path}/events.parquet/*.parquet'")
    good, text = compare(streams.stream_training_aggregate(spark, str(tmp_path)), con, streams.STREAM_TRAINING_SQL)
    assert good, text


def test_counters_reach_the_listener(spark, tmp_path):
    listener = ingest.CounterListener()
    spark.streams.addListener(listener)
    try:
        stream = topics.read_message_files(spark, write(tmp_path / "in", messages(3)))
        rows = ingest.stream_metrics(stream, [{"service.namespace": "a"}])
        counted = rows.observe("points", F.count(F.lit(1)).alias("rows"))
        memory(spark, counted, "counted")
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    finally:
        spark.streams.removeListener(listener)
    assert sum(c["rows"] for name, _, c in listener.counters if name == "points") == 3
    df, seen = count_rows(spark.range(3), "three")
    df.collect()
    assert seen.get == {"rows": 3}


def test_kafka_source_is_declared(spark):
    with pytest.raises(Exception, match="(?i)kafka"):
        topics.read_topics(spark, "localhost:9092", max_messages=10)


def tiny_tables(spark, folder, rows):
    """The given tables cut to so many rows."""
    for path in Path("/root/testdata/sf0.001").glob("*.parquet"):
        spark.read.parquet(str(path)).limit(rows).write.parquet(str(folder / path.name))
    con = duckdb.connect()
    for path in folder.glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}/*.parquet'")
    return str(folder), con


@pytest.mark.parametrize("rows", [0, 1, 3])
def test_stream_queries_on_small_tables(spark, tmp_path, rows):
    sf_dir, con = tiny_tables(spark, tmp_path / "sf", rows)
    for name in ("stream_records", "stream_ingest", "stream_ingest_logs", "stream_training_aggregate", "lake_compacted"):
        run_query, sql = streams.QUERIES[name]
        good, text = compare(run_query(spark, sf_dir), con, sql)
        assert good, (name, text)


def test_slices_follow_the_rows(spark, tmp_path):
    rows = spark.range(1000).select(F.timestamp_seconds(F.pmod(F.hash("id"), F.lit(5000))).alias("timestamp"), "id")
    streams._in_time_order(spark, rows, str(tmp_path / "rows"), slice_rows=100)
    files = sorted((tmp_path / "rows").glob("part-*"), key=lambda p: p.stat().st_mtime)
    spans = [spark.read.parquet(str(p)).agg(F.min("timestamp"), F.max("timestamp")).first() for p in files]
    assert len(files) == 10 and all(a[1] < b[0] for a, b in zip(spans, spans[1:]))


def flushed(spark, tmp_path, flush_bytes, wait_ms=1500, lanes=1):
    stream = topics.read_message_files(spark, str(tmp_path / "in"), max_files=4)
    sink = ingest.LakeSink(str(tmp_path / "lake"))
    return flush.ingest_by_size(stream, sink, str(tmp_path / "offsets"), flush_bytes, wait_ms, lanes, "100 milliseconds")


def lake_batches(tmp_path):
    return {p.name for p in (tmp_path / "lake/metrics").glob("timestamp_day=*/ingest_batch=*")}


def test_flush_by_size_and_remainder(spark, tmp_path):
    texts = messages(40)
    write(tmp_path / "in", texts)
    size = sum(len(t.encode()) for t in texts)
    query = flushed(spark, tmp_path, size // 3)
    flush.drain(query, 1500, patience=90)
    # two flushes and the remainder, of ten triggers with messages
    assert query.lastProgress.batchId >= 10 and 2 <= len(lake_batches(tmp_path)) <= 4
    assert lake.read_rows(spark, str(tmp_path / "lake/metrics")).count() == 40


def test_restart_keeps_the_messages_that_wait(spark, tmp_path):
    texts = messages(24)
    write(tmp_path / "in", texts[:12])
    query = flushed(spark, tmp_path, 10**9, wait_ms=600_000, lanes=2)
    deadline = time.monotonic() + 60
    while sum(p.numInputRows for p in query.recentProgress) < 12 and time.monotonic() < deadline:
        time.sleep(0.2)
    query.stop()
    assert not (tmp_path / "lake/metrics").exists()
    write(tmp_path / "in", texts)
    size = sum(len(t.encode()) for t in texts)
    query = flushed(spark, tmp_path, size // 8, lanes=2)
    flush.drain(query, 1500, patience=90)
    stored = lake.read_rows(spark, str(tmp_path / "lake/metrics"))
    assert sorted(r["value"] for r in stored.collect()) == sorted(set(range(24)))


def progress_of(monkeypatch):
    """Collects how many rows each batch of the streams to come takes."""
    taken = []
    ended = streams._ended

    def noted(query, batches=0):
        ended(query, batches)
        taken.append([p.numInputRows for p in query.recentProgress if p.numInputRows])

    monkeypatch.setattr(streams, "_ended", noted)
    return taken


def test_batches_do_not_grow_in_number_with_the_messages(spark, monkeypatch):
    """Files of 40 messages and the smallest batches: a file for each batch before."""
    monkeypatch.setattr(streams, "FILE_MESSAGES", 40)
    monkeypatch.setattr(streams, "BATCH_BYTES", 1)
    monkeypatch.setattr(streams, "MOST_BATCHES", 4)
    taken = progress_of(monkeypatch)
    rows = streams.stream_ingest(spark, "/root/testdata/sf0.001").count()
    found = spark.read.parquet("/root/testdata/sf0.001/events.parquet").count()
    assert 2 <= len(taken[0]) <= 6 and sum(taken[0]) > found and rows > found


def test_a_batch_takes_a_slice_for_each_core(spark, monkeypatch):
    in_order = streams._in_time_order
    monkeypatch.setattr(streams, "_in_time_order", lambda s, rows, root: in_order(s, rows, root, slice_rows=50))
    taken = progress_of(monkeypatch)
    con = duckdb.connect()
    con.execute("CREATE VIEW events AS SELECT * FROM '/root/testdata/sf0.001/events.parquet'")
    good, text = compare(streams.stream_training_aggregate(spark, "/root/testdata/sf0.001"), con, streams.STREAM_TRAINING_SQL)
    slices = -(-con.execute("SELECT count(*) FROM events").fetchone()[0] // 50)
    assert good, text
    assert 3 <= len(taken[0]) <= -(-slices // min(4, slices // 3))


def test_state_has_no_more_partitions_than_lanes(spark, tmp_path):
    write(tmp_path / "in", messages(8))
    query = flushed(spark, tmp_path, 10, lanes=2)
    flush.drain(query, 1500, patience=90)
    assert query.lastProgress.stateOperators[0].numShufflePartitions == 2
    assert spark.conf.get("spark.sql.shuffle.partitions") == "4"
    assert lake.read_rows(spark, str(tmp_path / "lake/metrics")).count() == 8


def test_more_messages_go_over_more_lanes(spark, monkeypatch):
    lanes = []
    by_size = flush.ingest_by_size

    def noted(*given, **options):
        lanes.append(options["lanes"])
        return by_size(*given, **options)

    monkeypatch.setattr(flush, "ingest_by_size", noted)
    monkeypatch.setattr(streams, "FLUSH_BYTES", 300_000)
    monkeypatch.setattr(streams, "TRIGGER_BYTES", 300_000)
    monkeypatch.setattr(streams, "FILE_MESSAGES", 100)
    monkeypatch.setattr(streams, "LANE_FLUSHES", 2)
    con = duckdb.connect()
    con.execute("CREATE VIEW events AS SELECT * FROM '/root/testdata/sf0.001/events.parquet'")
    good, text = compare(streams.stream_flushed(spark, "/root/testdata/sf0.001"), con, streams.STREAM_FLUSHED_SQL)
    assert good, text
    assert lanes[0] > 1
