"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def prepare(spark: SparkSession) -> SparkSession:
    """Pin the settings results depend on; everything else stays as the cluster set it."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for checkpoints and stage tables.

    A cluster names it in ``spark.checkpoint.dir``. Only a local session may fall back to a
    temporary folder, since no other machine has to see it.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if root is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        root = tempfile.mkdtemp(prefix="tidegauge-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(root)
    return root


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows written once and read again, for what is read many times."""
    spark = df.sparkSession
    path = f"{checkpoint_root(spark)}/tidegauge/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
