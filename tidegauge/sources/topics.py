"""Topics of OTLP JSON messages, read and written."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_topics(
    spark: SparkSession,
    brokers: str,
    topics: tuple[str, ...] = ("metrics", "logs"),
    max_messages: int | None = None,
    options: dict[str, str] | None = None,
) -> DataFrame:
    """Stream of message texts from the earliest offset on (needs the Kafka connector)."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", brokers)
        .option("subscribe", ",".join(topics))
        .option("startingOffsets", "earliest")
        .options(**(options or {}))
    )
    if max_messages is not None:
        reader = reader.option("maxOffsetsPerTrigger", max_messages)
    return message_texts(reader.load())


def read_message_files(
    spark: SparkSession, path: str, max_bytes: int | None = None, max_files: int | None = None
) -> DataFrame:
    """Stream of message texts from files with one message per line; batches by bytes or files."""
    reader = spark.readStream.format("text")
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", str(max_files))
    if max_bytes is not None:
        reader = reader.option("maxBytesPerTrigger", str(max_bytes))
    return message_texts(reader.load(path))


def message_texts(df: DataFrame) -> DataFrame:
    """The ``value`` column as text, without NULL messages."""
    return df.select(F.col("value").cast("string").alias("value")).filter("value IS NOT NULL")


def as_messages(records: DataFrame) -> DataFrame:
    """Flat records as JSON texts in ``value``, ready for a topic."""
    return records.select(F.to_json(F.struct(*records.columns)).alias("value"))


def write_topic(texts: DataFrame, brokers: str, topic: str, checkpoint: str | None = None):
    """Write a ``value`` column to a topic, as a batch or as a stream (needs the Kafka connector)."""
    if not texts.isStreaming:
        writer = texts.write.format("kafka").option("kafka.bootstrap.servers", brokers)
        return writer.option("topic", topic).save()
    writer = texts.writeStream.format("kafka").option("kafka.bootstrap.servers", brokers)
    return writer.option("topic", topic).option("checkpointLocation", checkpoint).start()
