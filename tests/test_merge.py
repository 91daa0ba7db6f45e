from __future__ import annotations

import itertools
import math
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from check import compare
from tidegauge.operators import merge
from tidegauge.plans import grid

NAN = float("nan")


def long(spark, series):
    rows = [(q, t, v, i) for q, points in series.items() for i, (t, v) in enumerate(points)]
    return spark.createDataFrame(rows, "query_id string, timestamp long, value double, pos long")


def collect(df):
    return {r["timestamp"]: tuple(r[c] for c in df.columns if c != "timestamp") for r in df.collect()}


def merged(spark, series, aggs, **options):
    return collect(merge.merge_series(long(spark, series), aggs, tie="pos", **options))


M = 60_000


@pytest.mark.parametrize(
    "agg, points, expected",
    [
        ("mean", [(3, 5.0), (M - 1, 6.0), (M, 9.0), (7 * M + 1, 4.0)], {0: 5.5, M: 9.0, 7 * M: 4.0}),
        ("sum", [(2 * M, 0.5), (2 * M + 9, 0.25)], {2 * M: 0.75}),
        ("first", [(9, 8.0), (4, 7.0), (6, 1.0)], {0: 7.0}),
        ("last", [(9, 8.0), (4, 7.0), (6, 1.0)], {0: 8.0}),
        ("min", [(1, 5.0), (2, -5.0), (M, 0.0)], {0: -5.0, M: 0.0}),
        ("max", [(1, 5.0), (2, -5.0), (M, 0.0)], {0: 5.0, M: 0.0}),
        ("mean", [(-M - 1, 1.0), (-M, 2.0), (-1, 4.0)], {-2 * M: 1.0, -M: 3.0}),
        ("mean", [], {}),
    ],
)
def test_windows_of_one_series(spark, agg, points, expected):
    for build in (merge.merge_series, merge.pivot_series):
        got = collect(build(long(spark, {"a": points}), {"a": agg}))
        assert {t: pytest.approx(v[0]) for t, v in got.items()} == expected


def test_windows_of_two_series(spark):
    series = {"tide": [(5, 2.0), (6, 4.0), (9 * M, 1.0)], "rain": [(8, 0.5), (9, 0.75), (3 * M, 2.0)]}
    assert merged(spark, series, {"tide": "max", "rain": "sum"}) == {
        0: (4.0, 1.25),
        3 * M: (None, 2.0),
        9 * M: (1.0, 0.0),
    }


def test_unknown_aggregate(spark):
    with pytest.raises(ValueError, match="median"):
        merge.merge_series(long(spark, {"a": []}), {"a": "median"})


def test_column_order_follows_the_spec(spark):
    df = merge.merge_series(long(spark, {"b": [(0, 1.0)], "a": [(0, 2.0)]}), {"b": "mean", "a": "mean"})
    assert df.columns == ["timestamp", "b", "a"]


def test_null_and_nan_rules(spark):
    df = spark.createDataFrame(
        [(0, None, NAN), (1, None, 2.0), (60000, 3.0, NAN)], "timestamp long, a double, b double"
    )
    wide = df.select("timestamp", F.col("a").alias("s"), F.col("a").alias("f"), F.col("b").alias("lo"), F.col("b").alias("hi"))
    got = collect(merge.resample(wide, {"s": "sum", "f": "first", "lo": "min", "hi": "max"}))
    assert got[0] == (0.0, None, 2.0, 2.0)
    assert got[60000][:2] == (3.0, 3.0) and all(math.isnan(v) for v in got[60000][2:])


def joined_by_hand(series, aggs, step=60000):
    """The definition: timeline, left joins one after another, then windows."""
    timeline = sorted({t for points in series.values() for t, _ in points})
    rows = []
    for t in timeline:
        columns = [[v for u, v in series[q] if u == t] or [None] for q in aggs]
        rows += [(t, *combo) for combo in itertools.product(*columns)]
    out = {}
    for window, group in itertools.groupby(rows, key=lambda r: r[0] // step * step):
        group = list(group)
        values = []
        for i, agg in enumerate(aggs.values(), 1):
            column = [r[i] for r in group]
            real = [v for v in column if v is not None]
            values.append(
                {
                    "mean": lambda: sum(real) / len(real) if real else None,
                    "sum": lambda: sum(real),
                    "min": lambda: min(real, default=None),
                    "max": lambda: max(real, default=None),
                    "first": lambda: column[0],
                    "last": lambda: column[-1],
                }[agg]()
            )
        out[window] = tuple(values)
    return out


@pytest.mark.parametrize("seed", range(4))
def test_folding_equals_the_joins_with_duplicates(spark, seed):
    rng = random.Random(seed)
    aggs = {"a": "mean", "b": "sum", "c": "first", "d": "last", "e": "max"}
    series = {
        q: sorted(
            [(rng.randrange(0, 40) * 7000, rng.choice([rng.random(), 5.0])) for _ in range(rng.randrange(5, 40))],
            key=lambda p: p[0],
        )
        for q in aggs
    }
    got = merged(spark, series, aggs)
    expected = joined_by_hand(series, aggs)
    assert got.keys() == expected.keys()
    for t, values in expected.items():
        assert got[t] == pytest.approx(values)
    assert merge.has_duplicate_timestamps(long(spark, series))


def test_pivot_equals_folding_without_duplicates(spark):
    rng = random.Random(9)
    aggs = {"a": "mean", "b": "sum", "c": "first", "d": "last", "e": "min"}
    series = {q: [(t * 5000, rng.random()) for t in rng.sample(range(60), 20)] for q in aggs}
    df = long(spark, series)
    assert not merge.has_duplicate_timestamps(df)
    folded, pivoted = collect(merge.merge_series(df, aggs)), collect(merge.pivot_series(df, aggs))
    assert folded.keys() == pivoted.keys()
    for t, values in folded.items():
        assert pivoted[t] == pytest.approx(values)


def test_hot_timestamp_makes_no_pairs(spark):
    """A third of all points on one timestamp of two series: the joins would make 4 million rows."""
    hot = spark.range(4000).select(
        F.when(F.col("id") % 2 == 0, "a").otherwise("b").alias("query_id"),
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("timestamp"),
        F.lit(1.0).alias("value"),
    )
    got = collect(merge.merge_series(hot, {"a": "mean", "b": "sum"}))
    a = [0 if i % 3 == 0 else i for i in range(0, 4000, 2)]
    b = [0 if i % 3 == 0 else i for i in range(1, 4000, 2)]
    expected = sum(max(1, a.count(t)) for t in b)
    assert got[0] == (1.0, float(expected))


def test_pivot_refuses_duplicate_timestamps(spark):
    df = long(spark, {"a": [(1, 1.0), (1, 3.0)], "b": [(1, 2.0)]})
    with pytest.raises(Exception, match="two points at one timestamp"):
        merge.pivot_series(df, {"a": "sum", "b": "sum"}).collect()


def test_pivot_query_on_repeated_timestamps(spark, tmp_path):
    """The events three times over, under other ids: every series repeats its timestamps."""
    given = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    copies = [given.withColumns({"event_id": F.col("event_id") + k * 100_000, "value": F.col("value") + k}) for k in range(3)]
    copies[0].union(copies[1]).union(copies[2]).write.parquet(str(tmp_path / "events.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM '{tmp_path}/events.parquet/*.parquet'")
    good, text = compare(grid.merge_pivot(spark, str(tmp_path)), con, grid.MERGE_FINE_SQL)
    assert good, text
