"""Small helpers shared by the operators on texts: reading, batches, stage tables."""

from __future__ import annotations

import ctypes
import gc
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.session import checkpoint_root

# Rows of one Arrow batch: with very long texts a batch stays a few tens of MB.
BATCH_ROWS = 1024


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def small_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Bound the Arrow batches handed to Python by rows; texts can be long."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def id_and_text(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Only the two columns an operator works on, so that no other name can clash; NULL text is ''."""
    return df.select(
        F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text")
    )


def give_back() -> None:
    """Hand memory that is no longer used back to the system: Python workers are reused by later stages."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim is not None:
        trim(0)


def map_batches(
    df: DataFrame, make: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch]], schema: str
) -> DataFrame:
    """Apply a batch function made once per task, so that models load once per worker."""
    small_batches(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        apply = make()
        for batch in batches:
            if batch.num_rows:
                yield apply(batch)
        del apply
        give_back()

    return df.mapInArrow(run, schema)


def stage_table(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write a frame to the shared folder and read it back: cuts lineage and survives lost executors.

    Every call takes a folder of its own. The folders lie under ``spark.checkpoint.dir`` and may be
    removed once the results that read them are stored.
    """
    spark = df.sparkSession
    path = f"{checkpoint_root(spark)}/tidegauge-llm/{name}-{uuid.uuid4().hex}"
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def broadcast_if_small(df: DataFrame, rows: int, limit: int = 2_000_000) -> DataFrame:
    """Broadcast hint behind a check of the counted rows (narrow rows of a few longs); else no hint."""
    return F.broadcast(df) if rows <= limit else df


def hash128(column: Column) -> list[Column]:
    """Two 64-bit hashes with different seeds."""
    return [F.xxhash64(column), F.xxhash64(F.lit("second"), column)]
