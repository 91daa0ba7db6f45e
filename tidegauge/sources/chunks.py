"""Daily chunks of a wide frame: one partition ``chunk_date=YYYYMMDD`` per UTC day."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.functions.calendar import day_key, from_millis, parse_day_key
from tidegauge.operators.clean import require_clean

CHUNK = "chunk_date"


def with_chunk_date(df: DataFrame, ts: str = "timestamp") -> DataFrame:
    return df.withColumn(CHUNK, day_key(from_millis(F.col(ts))))


def write_chunks(df: DataFrame, root: str, ts: str = "timestamp", gate: bool = True) -> None:
    """Write sorted chunks, replacing only the days the frame holds.

    The gate refuses frames with NULL or NaN. Rows are range-partitioned by day and time, which
    sorts the files and also cuts a large day into several. Gate, range sampling and write each
    read the frame, so it is kept on the executors' disks meanwhile.
    """
    dated = with_chunk_date(df, ts).persist(StorageLevel.DISK_ONLY)
    try:
        if gate:
            require_clean(dated)
        (
            dated.repartitionByRange(CHUNK, ts)
            .sortWithinPartitions(CHUNK, ts)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(CHUNK)
            .option("compression", "snappy")
            .parquet(root)
        )
    finally:
        dated.unpersist()


def _read(spark: SparkSession, root: str) -> DataFrame:
    # Keys look like numbers; keep them as text.
    frame = spark.read.option("mergeSchema", "false").parquet(root)
    return frame.withColumn(CHUNK, F.col(CHUNK).cast("string"))


def read_chunk(spark: SparkSession, root: str, date: str) -> DataFrame:
    """One day; other partitions are not listed into the scan."""
    return _read(spark, root).filter(F.col(CHUNK) == parse_day_key(date)).drop(CHUNK)


def recent_dates(days: int, as_of: datetime | None = None) -> list[str]:
    """Keys of ``as_of``'s day and the days before it, oldest first."""
    today = (as_of or datetime.now(timezone.utc)).date()
    return [(today - timedelta(days=i)).strftime("%Y%m%d") for i in reversed(range(days))]


def read_recent_chunks(
    spark: SparkSession, root: str, days: int = 3, as_of: datetime | None = None
) -> DataFrame:
    """The last days together; a missing day is simply no rows.

    Row order is not part of the result: row-based operators sort by timestamp themselves.
    """
    dates = recent_dates(days, as_of)
    return _read(spark, root).filter(F.col(CHUNK).between(dates[0], dates[-1])).drop(CHUNK)
