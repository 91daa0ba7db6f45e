from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tidegauge.operators import ordering


def test_row_index_with_a_hot_series_and_a_hot_timestamp(spark):
    rng = random.Random(2)
    rows = []
    for i in range(3000):
        key = "hot" if i % 3 else rng.choice(["a", "b", None])
        t = 0 if i % 5 == 0 else rng.randrange(-1000, 1000)
        rows.append((i, key, t))
    df = spark.createDataFrame(rows, "id long, k string, timestamp long")
    whole = {r["id"]: r["row_idx"] for r in ordering.with_row_index(df, ("timestamp", "id"), partitions=7).collect()}
    ranked = sorted(rows, key=lambda r: (r[2], r[0]))
    assert whole == {r[0]: i for i, r in enumerate(ranked)}
    keyed = {r["id"]: r["row_idx"] for r in ordering.with_row_index(df, ("timestamp", "id"), ("k",), partitions=7).collect()}
    counts: dict = {}
    for i, k, _ in ranked:
        assert keyed[i] == counts.get(k, 0)
        counts[k] = counts.get(k, 0) + 1


def test_row_index_spreads_a_hot_series(spark):
    df = spark.range(9000).select(
        F.col("id").alias("timestamp"), F.when(F.col("id") % 3 > 0, "hot").otherwise("cold").alias("k")
    )
    plan = df.repartitionByRange(6, "k", "timestamp").withColumn("p", F.spark_partition_id())
    assert plan.filter("k = 'hot'").select("p").distinct().count() > 2


@pytest.mark.parametrize(
    "rows, test, val, sizes",
    [(100, 0.15, 0.15, (70, 15, 15)), (10, 0.2, 0.1, (7, 1, 2)), (0, 0.15, 0.15, (0, 0, 0)), (1, 0.15, 0.15, (0, 0, 1))],
)
def test_split_sizes(spark, rows, test, val, sizes):
    df = spark.range(rows).select((F.col("id") * 60000).alias("timestamp"))
    parts = ordering.split_by_time(df, test, val)
    assert tuple(p.count() for p in parts) == sizes
    if rows == 100:
        assert parts[0].agg(F.max("timestamp")).first()[0] == 69 * 60000
        assert parts[2].agg(F.min("timestamp")).first()[0] == 85 * 60000


@pytest.mark.parametrize("tie", ["id", None])
def test_split_inside_a_hot_timestamp(spark, tie):
    rng = random.Random(4)
    rows = [(i, 50 if i % 3 == 0 else rng.randrange(100)) for i in range(600)]
    df = spark.createDataFrame(rows, "id long, timestamp long")
    parts = ordering.split_by_time(df, 0.3, 0.3, tie=tie)
    assert [p.count() for p in parts] == [239, 181, 180]  # int(600 * (1 - 0.3 - 0.3)) is 239
    ids = [{r["id"] for r in p.collect()} for p in parts]
    assert len(set().union(*ids)) == 600
    ranked = [i for i, _ in sorted(rows, key=lambda r: (r[1], r[0]))]
    if tie:
        assert ids[0] == set(ranked[:239]) and ids[2] == set(ranked[420:])
    else:  # rows of the border timestamp follow a hash: the same in every run
        times = dict(rows)
        assert max(times[i] for i in ids[0]) <= min(times[i] for i in ids[1])
        assert max(times[i] for i in ids[1]) <= min(times[i] for i in ids[2])
        again = ordering.split_by_time(df.repartition(5), 0.3, 0.3)
        assert [{r["id"] for r in p.collect()} for p in again] == ids


def test_split_counts_nulls_as_first(spark):
    df = spark.createDataFrame([(None,), (1,), (2,), (3,)], "timestamp long")
    train, val, test = ordering.split_by_time(df, 0.25, 0.25)
    assert [r[0] for r in train.orderBy("timestamp").collect()] == [None, 1]
    assert (val.count(), test.count()) == (1, 1)
    nulls = spark.createDataFrame([(None,), (None,), (None,), (3,)], "timestamp long")
    assert [p.count() for p in ordering.split_by_time(nulls, 0.25, 0.25)] == [2, 1, 1]


def test_ties_must_be_unique(spark):
    df = spark.createDataFrame([(1, 1)] * 10, "timestamp long, id long")
    with pytest.raises(ValueError, match="apart"):
        ordering.split_by_time(df, 0.3, 0.3, tie="id")


def test_split_label(spark):
    df = spark.range(20).select(F.col("id").alias("timestamp"))
    counts = {r["split"]: r["count"] for r in ordering.split_label(df, 0.2, 0.1).groupBy("split").count().collect()}
    assert counts == {"train": 14, "val": 2, "test": 4}


@pytest.mark.parametrize("block_rows", [1, 1000])
def test_sequences(spark, block_rows):
    df = spark.range(25).select(F.col("id").alias("timestamp"), F.col("id").cast("double").alias("a"), (-F.col("id")).cast("double").alias("y0"))
    indexed = ordering.with_row_index(df, partitions=3)
    got = ordering.sequences(indexed, ["a", "timestamp"], "y0", 4, block_rows=block_rows).orderBy("start_idx").collect()
    assert len(got) == 21
    assert got[3]["x"] == [[float(i), float(i)] for i in range(3, 7)] and got[3]["y"] == -7.0
    assert ordering.sequences(indexed, ["a"], "y0", 25).count() == 0


def test_preview(spark):
    assert ordering.preview(spark.range(10)).count() == 5


def test_hot_timestamps_are_cut(spark):
    """Nine rows of ten share one timestamp, and still no partition of the sort holds most rows."""
    df = spark.range(20_000).select("id", F.when(F.col("id") % 10 != 0, 5).otherwise(F.col("id")).alias("timestamp"))
    indexed = ordering.with_row_index(df, partitions=8)
    assert [r[0] for r in indexed.orderBy("row_idx").select("row_idx").collect()] == list(range(20_000))
    sizes = [r["count"] for r in indexed.groupBy(F.spark_partition_id()).count().collect()]
    assert max(sizes) < 6_000


def test_rows_with_maps_are_indexed_and_split(spark):
    df = spark.range(40).select(F.lit(7).cast("long").alias("timestamp"), F.create_map(F.lit("k"), F.col("id")).alias("m"))
    parts = ordering.split_by_time(df)
    assert [p.count() for p in parts] == [28, 6, 6]
    assert {r["m"]["k"] for p in parts for r in p.collect()} == set(range(40))


@pytest.mark.parametrize("keys,length,block_rows", [((), 4, 7), (("k",), 3, 5), ((), 30, 16), (("k",), 40, 16)])
def test_sequence_blocks_hold_the_same_sequences(spark, tmp_path, keys, length, block_rows):
    rows = [("a" if i % 3 else None, i, float(i) / 3, None if i % 11 == 5 else i * 1.5) for i in range(150)]
    df = spark.createDataFrame(rows, "k string, timestamp long, a double, b double").repartition(3)
    indexed = ordering.with_row_index(df, keys=keys)
    want = ordering.sequences(indexed, ["a", "b"], "b", length, keys, block_rows=block_rows)
    blocks = ordering.sequence_blocks(indexed, ["a", "b"], "b", length, keys, block_rows=block_rows)
    blocks.write.parquet(str(tmp_path / "blocks"))
    stored = spark.read.parquet(str(tmp_path / "blocks"))
    got = ordering.read_sequences(stored, length, keys)
    key = lambda df: sorted((str(r.asDict()) for r in df.select(*keys, "start_idx", "x", "y").collect()))
    plain = lambda text: text.replace("nan", "None")
    assert [plain(t) for t in key(got)] == [plain(t) for t in key(want)] and got.count() == 150 - length * max(1, 2 * len(keys))
    rows_stored = stored.selectExpr("sum(size(y)) AS n").first()["n"]
    assert rows_stored <= 1.25 * 150 + length * 2


def test_a_day_of_rows_is_stored_about_once(spark, tmp_path):
    df = spark.range(40_000).select((F.col("id") * 60_000).alias("timestamp"), F.rand(1).alias("a"), F.rand(2).alias("b"))
    indexed = ordering.with_row_index(df)
    blocks = ordering.sequence_blocks(indexed, ["a", "b"], "b", 1440)
    assert blocks.selectExpr("sum(size(y)) AS n").first()["n"] < 1.3 * 40_000
    assert ordering.map_sequences(blocks, 1440, lambda s, x, y: {"s": s}, "s long").count() == 40_000 - 1440
