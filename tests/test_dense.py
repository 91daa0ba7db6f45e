"""Rolling statistics where a time block holds too many rows for one group."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidegauge.operators import dense, rolling

WIDTHS = [rolling.MINUTE, 7 * rolling.MINUTE, rolling.HOUR, rolling.DAY]


def crowded(spark, rows=900):
    """One series with most rows inside a few minutes, ties, gaps, NULL, NaN and infinite values; one sparse."""
    rng = np.random.default_rng(2)
    times = np.sort(np.concatenate([rng.integers(0, 200_000, rows * 2 // 3), rng.integers(0, 2 * rolling.DAY, rows // 3)]))
    data = []
    for k, t in enumerate(times.tolist()):
        value = {0: None, 1: float("nan"), 2: float("inf"), 3: float("-inf")}.get(k % 101, float(np.round(rng.normal(50, 10), 3)))
        data.append(("s" if k % 9 else None, t, value, 7.0 if k % 2 else None, k))
    return spark.createDataFrame(data, "series string, timestamp long, a double, b double, id int").repartition(4)


def collected(df):
    names = [c for c in df.columns if "_mean_" in c or "_std_" in c]
    return {r["id"]: [r[c] for c in names] for r in df.collect()}


@pytest.mark.parametrize("keys,entries", [((), 100), (("series",), 64), (("series",), 4096)])
def test_dense_equals_time_blocks(spark, monkeypatch, keys, entries):
    df = crowded(spark)
    want = collected(rolling.rolling_statistics(df, ["a", "b"], WIDTHS, keys=keys))
    monkeypatch.setattr(rolling, "GROUP_ROWS", 50)
    monkeypatch.setattr(dense, "BLOCK_ENTRIES", entries)
    made = rolling.rolling_statistics(df, ["a", "b"], WIDTHS, keys=keys)
    assert made.columns[:5] == df.columns
    got = collected(made)
    assert got.keys() == want.keys()
    for k, row in want.items():
        for x, y in zip(got[k], row):
            assert (x is None) == (y is None)
            if x is not None:
                assert (math.isnan(x) and math.isnan(y)) or x == pytest.approx(y, rel=1e-12, abs=1e-12)


def test_no_group_holds_more_than_a_block(spark, monkeypatch):
    """Rows by group as the plan deals them, with all rows within one minute."""
    monkeypatch.setattr(dense, "BLOCK_ENTRIES", 128)
    real = dense._fold_block

    def fold(columns):
        run = real(columns)

        def bounded(table):
            if table.num_rows > 128:
                raise ValueError(f"{table.num_rows} entries in one group")
            return run(table)

        return bounded

    monkeypatch.setattr(dense, "_fold_block", fold)
    monkeypatch.setattr(rolling, "GROUP_ROWS", 10)
    df = spark.range(2000).select(F.pmod(F.hash("id"), F.lit(60_000)).cast("long").alias("timestamp"), F.lit(3.0).alias("a"), F.col("id").cast("int"))
    rows = rolling.rolling_statistics(df, ["a"], [30_000, rolling.HOUR]).collect()
    assert len(rows) == 2000
    assert {r[f"a_mean_{rolling.HOUR}i"] for r in rows} == {3.0} and {r[f"a_std_{rolling.HOUR}i"] for r in rows} <= {0.0, None}


def test_shifted_means_of_a_crowded_series(spark, monkeypatch):
    df = crowded(spark, 300).filter("a IS NOT NULL AND abs(a) < 1000").dropDuplicates(["timestamp"])
    want = collected(rolling.rolling_mean(df, ["a"], WIDTHS))
    monkeypatch.setattr(rolling, "GROUP_ROWS", 20)
    monkeypatch.setattr(dense, "BLOCK_ENTRIES", 77)
    got = collected(rolling.rolling_mean(df, ["a"], WIDTHS))
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k], rel=1e-12, nan_ok=True) for k in want if None not in want[k])
