from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tidegauge import schemas
from tidegauge.operators.clean import QualityError
from tidegauge.sources import chunks, lake


def metrics(spark, times, value=1.0):
    data = [(t, "m", value) for t in times]
    df = spark.createDataFrame(data, "t string, name string, value double")
    named = df.select(F.to_timestamp("t").alias("timestamp"), F.col("name").alias("__name__"), "value")
    missing = [f for f in schemas.METRIC.fields if f.name not in named.columns]
    return named.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in missing])


def test_catalog_tables(spark):
    lake.create_tables(spark, "obs")
    lake.create_tables(spark, "obs")
    lake.append_table(metrics(spark, ["2024-01-01 10:00:00", "2024-01-02 10:00:00"]), "obs", "metrics")
    table = spark.table("obs.metrics")
    assert table.count() == 2 and table.columns == [*schemas.METRIC.names, lake.DAY]
    assert lake.add_columns(spark, "obs", "metrics", {"zone": "STRING"}) == ["zone"]
    assert lake.add_columns(spark, "obs", "metrics", {"zone": "STRING"}) == []
    assert spark.table("obs.metrics").filter("zone IS NULL").count() == 2
    lake.append_table(metrics(spark, ["2024-01-03 10:00:00"]).withColumn("zone", F.lit("z")), "obs", "metrics")
    lake.append_table(metrics(spark, ["2024-01-04 10:00:00"]), "obs", "metrics")
    assert spark.table("obs.metrics").filter("zone = 'z'").count() == 1
    days = [r[0] for r in spark.sql("SHOW PARTITIONS obs.metrics").collect()]
    assert "timestamp_day=2024-01-03" in days and len(days) == 4
    assert spark.table("obs.logs").columns == [*schemas.LOG.names, lake.DAY]
    lake.drop_table(spark, "obs", "metrics")
    assert not spark.catalog.tableExists("obs.metrics")
    lake.drop_namespace(spark, "obs", cascade=True)
    assert not spark.catalog.databaseExists("obs")


def test_migrations_in_order_and_once(spark):
    lake.create_tables(spark, "moved")
    calls = []

    def fail_once(session, name):
        calls.append(name)
        if len(calls) == 1:
            raise RuntimeError("stopped")

    chain = [lake.Migration(1, {"zone": "STRING"}), lake.Migration(2, {"weight": "DOUBLE"}, fail_once)]
    lake.append_table(metrics(spark, ["2024-01-01 10:00:00"]), "moved", "metrics")
    assert lake.applied_version(spark, "moved", "metrics") == 0
    with pytest.raises(RuntimeError, match="stopped"):
        lake.migrate(spark, "moved", "metrics", chain)
    assert lake.applied_version(spark, "moved", "metrics") == 1
    assert lake.migrate(spark, "moved", "metrics", chain) == [2] and lake.migrate(spark, "moved", "metrics", chain) == []
    assert len(calls) == 2 and spark.table("moved.metrics").filter("zone IS NULL AND weight IS NULL").count() == 1
    with pytest.raises(ValueError, match="numbered"):
        lake.migrate(spark, "moved", "metrics", [chain[0], lake.Migration(3)])
    with pytest.raises(ValueError, match="version 2"):
        lake.migrate(spark, "moved", "metrics", chain[:1])
    lake.drop_namespace(spark, "moved", cascade=True)


def test_recent_rows_prune_days(spark, tmp_path):
    root = str(tmp_path / "metrics")
    lake.append_rows(metrics(spark, [f"2024-01-{d:02d} 12:00:00" for d in range(1, 11)]), root)
    recent = lake.read_recent(spark, root, 3, datetime(2024, 1, 11))
    assert recent.count() == 3
    plan = recent.select("value")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(timestamp_day" in plan and "2024-01-08" in plan
    assert "PushedFilters: [IsNotNull(timestamp), GreaterThan(timestamp" in plan
    assert "ReadSchema: struct<timestamp:timestamp,value:double>" in plan
    files = list((tmp_path / "metrics").rglob("*.zstd.parquet"))
    assert len(files) == 10


def test_batches_can_be_replayed(spark, tmp_path):
    root = str(tmp_path / "metrics")
    first = metrics(spark, ["2024-01-01 01:00:00", "2024-01-02 01:00:00"])
    lake.write_batch(first, root, "s-0")
    lake.write_batch(metrics(spark, ["2024-01-01 02:00:00"]), root, "s-1")
    lake.write_batch(first, root, "s-0")
    assert lake.read_rows(spark, root).count() == 3


def wide(spark, rows):
    return spark.createDataFrame(rows, "timestamp long, a double")


DAY_MS = 86_400_000
D0 = 1_704_067_200_000


def test_chunks_replace_only_their_days(spark, tmp_path):
    root = str(tmp_path / "chunks")
    chunks.write_chunks(wide(spark, [(D0 + 5, 2.0), (D0, 1.0), (D0 + DAY_MS, 3.0)]), root)
    chunks.write_chunks(wide(spark, [(D0 + DAY_MS + 1, 4.0)]), root)
    assert [r["a"] for r in chunks.read_chunk(spark, root, "20240101").collect()] == [1.0, 2.0]
    assert [r["a"] for r in chunks.read_chunk(spark, root, "20240102").collect()] == [4.0]
    assert chunks.read_chunk(spark, root, "20240103").count() == 0
    recent = chunks.read_recent_chunks(spark, root, 3, datetime(2024, 1, 3))
    assert sorted(r["a"] for r in recent.collect()) == [1.0, 2.0, 4.0]
    assert recent.columns == ["timestamp", "a"]
    plan = chunks.read_chunk(spark, root, "20240101")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(chunk_date" in plan
    with pytest.raises(ValueError):
        chunks.read_chunk(spark, root, "2024-01-01")
    assert (tmp_path / "chunks" / "chunk_date=20240101").is_dir()
    assert list((tmp_path / "chunks").rglob("*.snappy.parquet"))


def test_gate_stops_a_dirty_chunk(spark, tmp_path):
    root = tmp_path / "chunks"
    with pytest.raises(QualityError):
        chunks.write_chunks(wide(spark, [(D0, None)]), str(root))
    assert not root.exists()


def test_recent_dates():
    assert chunks.recent_dates(3, datetime(2024, 3, 1)) == ["20240228", "20240229", "20240301"]


def stored_rows(spark, root):
    return sorted(map(str, lake.read_rows(spark, root).collect()))


def test_compaction(spark, tmp_path):
    root, day = str(tmp_path / "lake"), date(2024, 5, 6)
    for k in range(3):
        lake.write_batch(metrics(spark, [f"2024-05-06 0{k}:00:00", "2024-05-07 00:00:00"], float(k)), root, f"b-{k}")
    before = stored_rows(spark, root)
    assert lake.compact(spark, root, day) == 3
    (name,) = lake.batches_of(spark, root, day)
    assert name.startswith("compacted-20240506") and len(lake.batches_of(spark, root, date(2024, 5, 7))) == 3
    assert stored_rows(spark, root) == before
    assert lake.drop_replaced(spark, root, day) == 3 and lake.drop_replaced(spark, root, day) == 0
    assert stored_rows(spark, root) == before
    assert lake.compact(spark, root, day) == 0 and lake.compact(spark, root, date(2020, 1, 1)) == 0


def test_compaction_again_with_late_and_replayed_batches(spark, tmp_path):
    root, day = str(tmp_path / "lake"), date(2024, 5, 6)
    batch = {k: metrics(spark, [f"2024-05-06 0{k}:00:00"], float(k)) for k in range(4)}
    for k in range(2):
        lake.write_batch(batch[k], root, f"b-{k}")
    assert lake.compact(spark, root, day) == 2
    lake.write_batch(batch[2], root, "b-2")
    assert lake.read_rows(spark, root).count() == 3
    assert lake.compact(spark, root, day) == 2 and lake.drop_replaced(spark, root, day) == 4
    # a batch compacted twice over is replayed, as after a lost driver
    lake.write_batch(batch[0], root, "b-0")
    lake.write_batch(batch[3], root, "b-3")
    assert sorted(r["value"] for r in lake.read_rows(spark, root).collect()) == [0.0, 1.0, 2.0, 3.0]
    assert lake.compact(spark, root, day) == 2
    assert sorted(r["value"] for r in lake.read_rows(spark, root).collect()) == [0.0, 1.0, 2.0, 3.0]
    assert sorted(r["value"] for r in lake.read_recent(spark, root, 7, datetime(2024, 5, 7)).collect()) == [0.0, 1.0, 2.0, 3.0]


@pytest.mark.parametrize("step", ["staging", "entry", "before the rename", "after the rename", "deleting"])
def test_compaction_stopped_at_each_step(spark, tmp_path, monkeypatch, step):
    """A run stops, a late batch of the day is written, the next call goes on: no row is lost or doubled."""

    class Stop(Exception):
        pass

    def stop(*_):
        raise Stop

    root, day = str(tmp_path / "lake"), date(2024, 5, 6)
    rows = metrics(spark, [f"2024-05-06 0{k}:00:00" for k in range(9)])
    for k in range(3):
        lake.write_batch(rows.filter(F.hour("timestamp") % 3 == k), root, f"b-{k}")
    before = stored_rows(spark, root)
    with monkeypatch.context() as patch, pytest.raises(Stop):
        if step == "staging":
            lake._files(spark, f"{root}/_compacting/compacted-20240506-dead")[0].mkdirs(lake._files(spark, f"{root}/_compacting/compacted-20240506-dead")[1])
            patch.setattr(lake, "_entries", stop)
        elif step == "entry":
            patch.setattr(lake, "_write_entry", stop)
        elif step == "before the rename":
            real = lake._write_entry
            patch.setattr(lake, "_write_entry", lambda *a: (real(*a), stop()))
        else:
            lake.compact(spark, root, day)
            if step == "deleting":
                real_delete, calls = lake._delete, []
                patch.setattr(lake, "_delete", lambda *a: stop() if calls else (calls.append(1), real_delete(*a)))
                lake.drop_replaced(spark, root, day)
            raise Stop
        lake.compact(spark, root, day)
    assert stored_rows(spark, root) == before
    lake.write_batch(metrics(spark, ["2024-05-06 20:00:00"]), root, "late")
    after = stored_rows(spark, root)
    assert len(after) == 10
    lake.compact(spark, root, day)
    assert stored_rows(spark, root) == after and len(lake.batches_of(spark, root, day)) == 1
    lake.drop_replaced(spark, root, day)
    assert stored_rows(spark, root) == after and len(lake._stored_batches(spark, root, day)) == 1
    assert lake._names(spark, f"{root}/_compacting") == []


def test_reader_that_began_before_a_compaction(spark, tmp_path):
    root, day = str(tmp_path / "lake"), date(2024, 5, 6)
    for k in range(3):
        lake.write_batch(metrics(spark, [f"2024-05-06 0{k}:00:00"]), root, f"b-{k}")
    early = lake.read_rows(spark, root)
    lake.compact(spark, root, day)
    late = lake.read_rows(spark, root)
    assert early.count() == late.count() == 3
    plan = late._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and lake.BATCH in plan.split("PartitionFilters")[1]
    assert lake.read_rows(spark, str(tmp_path / "nothing")).count() == 0


def test_compaction_keeps_columns_of_single_batches(spark, tmp_path):
    root, day = str(tmp_path / "lake"), date(2024, 5, 6)
    lake.write_batch(metrics(spark, ["2024-05-06 01:00:00"]), root, "b-0")
    lake.write_batch(metrics(spark, ["2024-05-06 02:00:00"]).withColumn("zone", F.lit("z")), root, "b-1")
    lake.compact(spark, root, day)
    lake.drop_replaced(spark, root, day)
    assert spark.read.parquet(f"{root}/{lake.DAY}=2024-05-06").filter("zone = 'z'").count() == 1
    assert lake.read_rows(spark, root).count() == 2
