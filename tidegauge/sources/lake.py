"""Day-partitioned lake tables of flat metric and log rows."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import date, datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegauge import schemas
from tidegauge.operators.filters import recent_window

DAY = "timestamp_day"
BATCH = "ingest_batch"
TABLES = {"metrics": schemas.METRIC, "logs": schemas.LOG}


def _quoted(*parts: str) -> str:
    return ".".join(f"`{p}`" for p in parts)


def create_tables(
    spark: SparkSession, namespace: str, provider: str = "parquet", location: str | None = None
) -> None:
    """Create the namespace and both tables unless they exist.

    ``iceberg`` partitions by ``days(timestamp)`` itself; ``parquet`` keeps the day as a column.
    """
    # Dropping a namespace may delete its own folder, so tables with a location stay outside of it.
    home = f" LOCATION '{location}/_namespace'" if location else ""
    spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {_quoted(namespace)}{home}")
    for name, schema in TABLES.items():
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        if provider == "iceberg":
            layout = f"({columns}) USING iceberg PARTITIONED BY (days(timestamp))"
            options = " TBLPROPERTIES ('write.parquet.compression-codec'='zstd')"
        else:
            layout = f"({columns}, {DAY} DATE) USING {provider} PARTITIONED BY ({DAY})"
            options = " OPTIONS ('compression'='zstd')"
        where = f" LOCATION '{location}/{name}'" if location else ""
        spark.sql(f"CREATE TABLE IF NOT EXISTS {_quoted(namespace, name)} {layout}{options}{where}")


def add_columns(spark: SparkSession, namespace: str, table: str, columns: dict[str, str]) -> list[str]:
    """Add the columns the table lacks; old rows read as NULL. Returns what was added."""
    present = set(spark.table(_quoted(namespace, table)).columns)
    missing = {name: kind for name, kind in columns.items() if name not in present}
    if missing:
        added = ", ".join(f"`{name}` {kind}" for name, kind in missing.items())
        spark.sql(f"ALTER TABLE {_quoted(namespace, table)} ADD COLUMNS ({added})")
    return list(missing)


VERSION = "tidegauge.version"


@dataclass(frozen=True)
class Migration:
    """One numbered step of a table: columns to add and, for anything else, a function of (spark, table name).

    A step that stops half-way runs again as a whole, so its function must bear that.
    """

    version: int
    columns: dict[str, str] = field(default_factory=dict)
    run: Callable[[SparkSession, str], None] | None = None


def applied_version(spark: SparkSession, namespace: str, table: str) -> int:
    """The version a table says it has; 0 before any migration."""
    rows = spark.sql(f"SHOW TBLPROPERTIES {_quoted(namespace, table)}").collect()
    return int(next((r["value"] for r in rows if r["key"] == VERSION), 0))


def migrate(spark: SparkSession, namespace: str, table: str, chain: list[Migration]) -> list[int]:
    """Apply the steps a table lacks, in order, and note each version with the table; returns what was applied.

    The chain is the whole history, numbered 1, 2, 3, ... without a gap. A table that is ahead of the chain
    was migrated by newer code and is refused.
    """
    numbers = [step.version for step in chain]
    if numbers != list(range(1, len(chain) + 1)):
        raise ValueError(f"migrations must be numbered 1, 2, 3, ... in order, not {numbers}")
    now = applied_version(spark, namespace, table)
    if now > len(chain):
        raise ValueError(f"the table has version {now}, the chain ends with {len(chain)}")
    name = _quoted(namespace, table)
    applied = []
    for step in chain[now:]:
        add_columns(spark, namespace, table, step.columns)
        if step.run is not None:
            step.run(spark, name)
        spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('{VERSION}' = '{step.version}')")
        applied.append(step.version)
    return applied


def drop_table(spark: SparkSession, namespace: str, table: str, purge: bool = True) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {_quoted(namespace, table)}{' PURGE' if purge else ''}")


def drop_namespace(spark: SparkSession, namespace: str, cascade: bool = False) -> None:
    spark.sql(f"DROP NAMESPACE IF EXISTS {_quoted(namespace)}{' CASCADE' if cascade else ''}")


def with_day(rows: DataFrame) -> DataFrame:
    return rows.withColumn(DAY, F.to_date("timestamp"))


def append_table(rows: DataFrame, namespace: str, table: str) -> None:
    """Append rows to a catalog table, by column name."""
    name = _quoted(namespace, table)
    columns = rows.sparkSession.table(name).columns
    dated = with_day(rows) if DAY in columns else rows
    missing = {c: F.lit(None) for c in columns if c not in dated.columns}
    full = dated.withColumns(missing) if missing else dated
    balanced = _balanced(full) if DAY in columns else full
    balanced.select(*columns).write.insertInto(name)


def _balanced(rows: DataFrame) -> DataFrame:
    """Few files per day without sending a whole day to one task.

    The hint lets the planner join small partitions and cut large ones after the shuffle.
    """
    return rows.hint("rebalance", DAY)


def append_rows(rows: DataFrame, root: str) -> None:
    """Append rows to a path-based table."""
    (
        _balanced(with_day(rows))
        .write.mode("append")
        .partitionBy(DAY)
        .option("compression", "zstd")
        .parquet(root)
    )


def write_batch(rows: DataFrame, root: str, batch: str) -> None:
    """Write the rows of one micro-batch under its own partition.

    Writing a batch again replaces what its first attempt left, so a replay does not duplicate.
    """
    (
        _balanced(with_day(rows))
        .withColumn(BATCH, F.lit(batch))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(DAY, BATCH)
        .option("compression", "zstd")
        .parquet(root)
    )


def _files(spark: SparkSession, path: str):
    """The file system of a path, and the path in its terms."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def _names(spark: SparkSession, path: str) -> list[str]:
    """What a folder holds; nothing if there is no such folder."""
    files, place = _files(spark, path)
    return sorted(s.getPath().getName() for s in files.listStatus(place)) if files.exists(place) else []


def _delete(spark: SparkSession, path: str) -> None:
    files, place = _files(spark, path)
    files.delete(place, True)


def _day_folder(root: str, day: date) -> str:
    return f"{root}/{DAY}={day:%Y-%m-%d}"


def _stored_batches(spark: SparkSession, root: str, day: date) -> list[str]:
    names = _names(spark, _day_folder(root, day))
    return [n.split("=", 1)[1] for n in names if n.startswith(f"{BATCH}=")]


# Beside the day folders; Spark passes over names that start with an underscore.
_LEDGER, _STAGED = "_ledger", "_compacting"


def _write_entry(spark: SparkSession, root: str, day: date, name: str, replaced: list[str]) -> None:
    """The entry says which batches the partition ``name`` stands for; it appears whole or not at all."""
    folder = f"{root}/{_LEDGER}/{day:%Y-%m-%d}"
    files, draft = _files(spark, f"{folder}/.{name}")
    stream = files.create(draft, True)
    try:
        stream.write(bytearray("\n".join(replaced).encode()))
    finally:
        stream.close()
    if not files.rename(draft, _files(spark, f"{folder}/{name}")[1]):
        raise OSError(f"could not write the ledger entry {name}")


def _entry(spark: SparkSession, root: str, day: date, name: str) -> set[str]:
    files, place = _files(spark, f"{root}/{_LEDGER}/{day:%Y-%m-%d}/{name}")
    stream = files.open(place)
    try:
        return set(bytes(stream.readAllBytes()).decode().split("\n"))
    finally:
        stream.close()


def _entries(spark: SparkSession, root: str, day: date) -> dict[str, set[str]]:
    """Ledger entries of a day: compacted partition to the batches it stands for."""
    names = [n for n in _names(spark, f"{root}/{_LEDGER}/{day:%Y-%m-%d}") if not n.startswith(".")]
    return {name: _entry(spark, root, day, name) for name in names}


def hidden_batches(spark: SparkSession, root: str, since: date | None = None) -> dict[date, set[str]]:
    """Stored batches, by day, whose rows a compacted partition holds as well.

    An entry counts from the moment its partition is in place, which is one rename. Until the replaced
    batches are deleted, and whenever one of them is written again by a late replay, readers pass over them.
    """
    hidden = {}
    for text in _names(spark, f"{root}/{_LEDGER}"):
        day = date.fromisoformat(text)
        if since is not None and day < since:
            continue
        stored = set(_stored_batches(spark, root, day))
        replaced = {b for name, old in _entries(spark, root, day).items() if name in stored for b in old}
        if replaced & stored:
            hidden[day] = replaced & stored
    return hidden


def batches_of(spark: SparkSession, root: str, day: date) -> list[str]:
    """Batch partitions that a day consists of."""
    stored = _stored_batches(spark, root, day)
    hidden = hidden_batches(spark, root, day).get(day, set()) if stored else set()
    return [b for b in stored if b not in hidden]


def compact(spark: SparkSession, root: str, day: date) -> int:
    """Write the batches of a day again as one partition that replaces them; returns how many there were.

    The partition is staged, the ledger notes exactly which batches it stands for, and one rename puts
    it in place: from then on readers see it instead of those batches, before that the batches. A batch
    that comes in meanwhile is in no entry and stays. A run that stops at any point changes nothing or is
    complete; the next call starts anew. Replaced batches stay on disk for readers that have begun, until
    :func:`drop_replaced`. The file system must rename folders as one step.
    """
    home = _day_folder(root, day)
    _forget_unfinished(spark, root, day)
    old = batches_of(spark, root, day)
    if not old or (len(old) == 1 and old[0].startswith("compacted-")):
        return 0
    name = f"compacted-{day:%Y%m%d}-{uuid.uuid4().hex[:12]}"
    staged = f"{root}/{_STAGED}/{name}"
    parts = [f"{home}/{BATCH}={b}" for b in old]
    rows = spark.read.option("mergeSchema", True).parquet(*parts)
    rows.hint("rebalance").write.option("compression", "zstd").parquet(staged)
    # what an older compacted partition stands for must stay hidden after it is gone itself
    entries = _entries(spark, root, day)
    inherited = {b for o in old if o in entries for b in entries[o]}
    _write_entry(spark, root, day, name, sorted({*old, *inherited}))
    files, ready = _files(spark, staged)
    if not files.rename(ready, _files(spark, f"{home}/{BATCH}={name}")[1]):
        raise OSError(f"could not move {staged} into the table")
    return len(old)


def _forget_unfinished(spark: SparkSession, root: str, day: date) -> None:
    """Remove what runs left that stopped before their partition was in place."""
    stored = set(_stored_batches(spark, root, day))
    for name in _entries(spark, root, day):
        if name not in stored and not _replaced_by_another(spark, root, day, name):
            _delete(spark, f"{root}/{_LEDGER}/{day:%Y-%m-%d}/{name}")
    for name in _names(spark, f"{root}/{_STAGED}"):
        if name.startswith(f"compacted-{day:%Y%m%d}-"):
            _delete(spark, f"{root}/{_STAGED}/{name}")


def _replaced_by_another(spark: SparkSession, root: str, day: date, name: str) -> bool:
    return any(name in old for other, old in _entries(spark, root, day).items() if other != name)


def drop_replaced(spark: SparkSession, root: str, day: date) -> int:
    """Delete the batches of a day that a compacted partition stands for; returns how many there were.

    For a time when no reader that began before the compaction is still running.
    """
    gone = hidden_batches(spark, root, day).get(day, set())
    for batch in sorted(gone):
        _delete(spark, f"{_day_folder(root, day)}/{BATCH}={batch}")
    return len(gone)


def read_rows(spark: SparkSession, root: str, kind: str = "metrics", since: date | None = None) -> DataFrame:
    """Read a path-based table in the current row layout; columns a file lacks read as NULL.

    Batches that a compacted partition stands for are passed over, by a filter on the partition columns.
    ``since`` limits how far back the ledger is read, for a reader that limits its days as well. A table
    nothing was written to yet is empty.
    """
    fields = [*TABLES[kind].fields, T.StructField(DAY, T.DateType())]
    files, place = _files(spark, root)
    if not files.exists(place):
        return spark.createDataFrame([], T.StructType(fields))
    hidden = hidden_batches(spark, root, since)
    stored = [*fields, T.StructField(BATCH, T.StringType())] if hidden else fields
    rows = spark.read.schema(T.StructType(stored)).parquet(root)
    for day, batches in hidden.items():
        rows = rows.filter(F.col(BATCH).isNull() | (F.col(DAY) != F.lit(day)) | ~F.col(BATCH).isin(sorted(batches)))
    return rows.select(*[f.name for f in fields])


def read_recent(
    spark: SparkSession, root: str, days: int = 7, as_of: datetime | None = None, kind: str = "metrics"
) -> DataFrame:
    """Recent rows; the limit prunes day partitions and is pushed into the files."""
    since = (as_of or datetime.now(timezone.utc)).date() - timedelta(days=days + 1)
    return recent_window(read_rows(spark, root, kind, since), days, as_of, day=DAY)
