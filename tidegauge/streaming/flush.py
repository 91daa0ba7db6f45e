"""Message streams gathered until there is enough to write.

A topic's triggers are cut by time or by messages, so small messages make small batches and small files. Here
messages wait in the state of the stream until a lane holds as many bytes as a flush asks for; a timer lets the
remainder go when nothing filled it up in time. State and offsets are committed together, so a restart neither
loses nor repeats a message that waits.
"""

from __future__ import annotations

import time
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

from tidegauge.streaming.ingest import LakeSink

# Bytes of a flush: 3 MB, in the unit of the settings' ``batch_size``.
FLUSH_BYTES = 3_000_000
WAIT_MS = 60_000
# Messages handed on at once.
_CHUNK = 10_000
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_PARTITIONS = "spark.sql.shuffle.partitions"
FLUSHED = "lane int, flush long, value string"


class SizeFlush(StatefulProcessor):
    """Holds the messages of a lane: how many bytes, the number of the next flush, and the texts."""

    def __init__(self, flush_bytes: int, wait_ms: int) -> None:
        self.flush_bytes, self.wait_ms = flush_bytes, wait_ms

    def init(self, handle) -> None:
        self.handle = handle
        self.held = handle.getValueState("held", "bytes long, flush long")
        self.texts = handle.getListState("texts", "value string")

    def _let_go(self, lane: int, flush: int) -> Iterator[pd.DataFrame]:
        chunk: list[str] = []
        for (text,) in self.texts.get():
            chunk.append(text)
            if len(chunk) == _CHUNK:
                yield pd.DataFrame({"lane": lane, "flush": flush, "value": chunk})
                chunk = []
        if chunk:
            yield pd.DataFrame({"lane": lane, "flush": flush, "value": chunk})
        self.texts.clear()

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        held, flush = self.held.get() if self.held.exists() else (0, 0)
        waiting = held > 0
        for frame in rows:
            self.texts.appendList([(text,) for text in frame["value"]])
            held += int(frame["bytes"].sum())
            if held >= self.flush_bytes:
                yield from self._let_go(key[0], flush)
                held, flush = 0, flush + 1
                waiting = False
        if not waiting:
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
            if held:
                self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.wait_ms)
        self.held.update((held, flush))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        held, flush = self.held.get() if self.held.exists() else (0, 0)
        if held:
            yield from self._let_go(key[0], flush)
            self.held.update((0, flush + 1))

    def close(self) -> None:
        pass


def flush_by_size(
    texts: DataFrame, flush_bytes: int = FLUSH_BYTES, wait_ms: int = WAIT_MS, lanes: int = 1
) -> DataFrame:
    """Message texts (``value``) as (lane, flush, value), a lane's flush once it holds ``flush_bytes``.

    ``lanes`` spreads the messages over as many groups by their hash; each fills up by itself. A group takes
    the messages of one lane that wait, so memory and state are bounded by ``flush_bytes`` and one trigger.
    """
    lane = F.pmod(F.xxhash64("value"), F.lit(lanes)).cast("int")
    sized = texts.select(lane.alias("lane"), F.octet_length("value").cast("long").alias("bytes"), "value")
    return sized.groupBy("lane").transformWithStateInPandas(
        SizeFlush(flush_bytes, wait_ms), outputStructType=FLUSHED, outputMode="append", timeMode="processingTime"
    )


def ingest_by_size(
    texts: DataFrame,
    sink: LakeSink,
    checkpoint: str,
    flush_bytes: int = FLUSH_BYTES,
    wait_ms: int = WAIT_MS,
    lanes: int = 1,
    interval: str = "1 second",
) -> StreamingQuery:
    """Run the message stream into the lake, a batch for each flush of enough bytes.

    The state has no more partitions than lanes: each is opened and committed in every trigger, also an empty
    one. A trigger in which no lane is full writes nothing. The stream goes on until it is stopped (its timers keep it
    from ever being idle); a finite source ends with :func:`drain`.
    """

    def write(flushed: DataFrame, batch_id: int) -> None:
        ready = flushed.select("value").persist()
        try:
            if not ready.isEmpty():
                sink.write(ready, batch_id)
        finally:
            ready.unpersist()

    spark = texts.sparkSession
    partitions = min(lanes, int(spark.conf.get(_PARTITIONS)))
    # timers and lists need this store; a stream keeps the settings it was started with
    needed = {_PROVIDER: _ROCKS, _PARTITIONS: str(partitions)}
    before = {name: spark.conf.get(name, None) for name in needed}
    for name, value in needed.items():
        spark.conf.set(name, value)
    try:
        writer = flush_by_size(texts, flush_bytes, wait_ms, lanes).writeStream.foreachBatch(write)
        return writer.option("checkpointLocation", checkpoint).trigger(processingTime=interval).start()
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def drain(query: StreamingQuery, wait_ms: int = WAIT_MS, patience: float = 3600.0) -> None:
    """Wait until a finite source is read and the remainder had its time to go; then stop the stream."""
    deadline = time.monotonic() + patience
    quiet = None
    while time.monotonic() < deadline:
        if not query.isActive:
            query.awaitTermination()  # hands on what went wrong
            return
        progress = query.lastProgress
        if progress is None or progress.numInputRows or query.status["isDataAvailable"]:
            quiet = None
        elif quiet is None:
            quiet = time.monotonic(), progress.batchId
        elif time.monotonic() - quiet[0] > 1 + wait_ms / 1000 and progress.batchId > quiet[1]:
            # the timers were due; a trigger that starts from now on lets the remainder go
            due = progress.batchId
            while query.isActive and query.lastProgress.batchId < due + 2 and time.monotonic() < deadline:
                time.sleep(0.1)
            query.stop()
            return
        time.sleep(0.2)
    query.stop()
    raise TimeoutError("the stream did not come to rest")
