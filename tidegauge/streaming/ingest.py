"""Structured Streaming jobs: messages to lake tables, messages to flat records, running means."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from tidegauge.functions.anyvalue import kv_map
from tidegauge.operators.decode import (
    flatten_logs,
    flatten_metrics,
    flatten_stream_metrics,
    parse_messages,
    split_bad,
)
from tidegauge.sources.lake import write_batch

MEANS_BATCH = "means_batch"
RowStep = Callable[[DataFrame], DataFrame]


@dataclass
class LakeSink:
    """Where the rows of an ingest stream go, and which steps they pass on the way.

    ``root`` holds ``metrics``, ``logs`` and, with ``on_error='quarantine'``, ``rejected``.
    ``stream_id`` names the stream in the batch partitions: keep it with the checkpoint.
    """

    root: str
    stream_id: str = "ingest"
    include: list[dict] | None = None
    on_error: str = "fail"
    metric_steps: list[RowStep] = field(default_factory=list)
    log_steps: list[RowStep] = field(default_factory=list)

    def write(self, texts: DataFrame, batch_id: int) -> None:
        """Decode one micro-batch and write both tables.

        The texts are kept for the batch, so the source is read once for both sinks. Each write
        replaces its own batch partition, so a batch that failed half-way can simply run again.
        """
        batch = f"{self.stream_id}-{batch_id}"
        parsed = parse_messages(texts, self.on_error).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            good = parsed
            if self.on_error == "quarantine":
                good, bad = split_bad(parsed)
                if not bad.isEmpty():
                    rejected = bad.withColumn("ingest_batch", F.lit(batch))
                    (
                        rejected.write.mode("overwrite")
                        .option("partitionOverwriteMode", "dynamic")
                        .partitionBy("ingest_batch")
                        .parquet(f"{self.root}/rejected")
                    )
            metrics = _run(flatten_metrics(good, self.include), self.metric_steps)
            logs = _run(flatten_logs(good), self.log_steps)
            for rows, table in ((metrics, "metrics"), (logs, "logs")):
                if not rows.isEmpty():
                    write_batch(rows, f"{self.root}/{table}", batch)
        finally:
            parsed.unpersist()


def _run(rows: DataFrame, steps: list[RowStep]) -> DataFrame:
    for step in steps:
        rows = rows.transform(step)
    return rows


def ingest(
    texts: DataFrame,
    sink: LakeSink,
    checkpoint: str,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Run the message stream into the lake.

    Offsets are committed after both tables are written. The default trigger takes everything
    available and stops; batches are sized by the rate limit of the source.
    """
    return (
        texts.writeStream.foreachBatch(sink.write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def stream_metrics(texts: DataFrame, rules: list[dict], on_error: str = "fail") -> DataFrame:
    """Message texts to flat metric records, one message to many, no state."""
    parsed = parse_messages(texts, on_error)
    good = split_bad(parsed)[0] if on_error == "quarantine" else parsed
    return flatten_stream_metrics(good, rules)


def stream_logs(texts: DataFrame, on_error: str = "fail") -> DataFrame:
    """Message texts to flat log rows."""
    parsed = parse_messages(texts, on_error)
    good = split_bad(parsed)[0] if on_error == "quarantine" else parsed
    return flatten_logs(good)


def running_training_aggregate(
    metrics: DataFrame, bucket: str = "5 minutes", lateness: str = "10 minutes"
) -> DataFrame:
    """The training aggregate on a stream; a bucket's state goes once it is past the lateness.

    Meant for the append mode, which emits a bucket then, or the update mode with
    :func:`means_writer`, which emits it with every batch that touches it. Attribute maps are grouped as sorted pair lists, which a streaming state can use as a key.
    """

    def pairs(column: str):
        return F.array_sort(F.map_entries(kv_map(F.col(column))))

    rows = metrics.withWatermark("timestamp", lateness).select(
        "timestamp",
        "__name__",
        "value",
        pairs("attributes").alias("attributes"),
        pairs("resource_attributes").alias("resource_attributes"),
    )
    grouped = rows.groupBy(
        F.window("timestamp", bucket), "__name__", "attributes", "resource_attributes"
    ).agg(F.avg("value").alias("value"))
    return grouped.select(
        F.col("window.start").alias("bucket"),
        "__name__",
        "value",
        "attributes",
        "resource_attributes",
        F.unix_millis("window.start").alias("timestamp"),
    )


def means_writer(root: str) -> Callable[[DataFrame, int], None]:
    """Batch function for the update mode: each batch has a partition of its own, replaced on replay."""

    def write(means: DataFrame, batch_id: int) -> None:
        (
            means.withColumn(MEANS_BATCH, F.lit(batch_id).cast("long"))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(MEANS_BATCH)
            .parquet(root)
        )

    return write


def latest_means(written: DataFrame) -> DataFrame:
    """Of each bucket the mean of the last batch that touched it."""
    keys = [c for c in written.columns if c not in ("value", MEANS_BATCH)]
    return written.groupBy(*keys).agg(F.max_by("value", MEANS_BATCH).alias("value"))


class CounterListener(StreamingQueryListener):
    """Keeps the observed counters of every micro-batch, by counter name."""

    def __init__(self) -> None:
        self.counters: list[tuple[str, int, dict]] = []

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        for name, row in progress.observedMetrics.items():
            self.counters.append((name, progress.batchId, row.asDict()))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass
