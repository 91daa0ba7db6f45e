from __future__ import annotations

import math
import random
import statistics

import pytest
from pyspark.sql import functions as F

from tidegauge.functions import calendar
from tidegauge.operators import features, ordering, rolling
from tidegauge.plans import tables, windows

MIN, HOUR, DAY = rolling.MINUTE, rolling.HOUR, rolling.DAY
NAN = float("nan")


def series(seed, rows=160, gap=40, keys=("k",)):
    """Grid frames with gaps, NULLs, equal stretches and a stray NaN."""
    rng = random.Random(seed)
    out = []
    for key in keys:
        t = rng.randrange(-50, 50)
        for i in range(rows):
            t += 1 if rng.random() < 0.8 else rng.randrange(1, gap * 24)
            v = None if rng.random() < 0.1 else (7.0 if 40 < i < 70 else round(rng.expovariate(0.02), 2))
            out.append((key, t * MIN, v))
    rng.shuffle(out)
    return out


def frame(spark, rows):
    return spark.createDataFrame(rows, "k string, timestamp long, v double")


def by_key(df):
    out = {}
    for r in df.orderBy("k", "timestamp").collect():
        out.setdefault(r["k"], []).append(r)
    return out


def expected_shifted(points, width, stat):
    values = []
    for t, _ in points:
        window = [v for u, v in points if t - width < u <= t and v is not None]
        values.append(stat(window))
    return [None, *values[:-1]]


def mean(window):
    return statistics.fmean(window) if window else None


def std(window):
    return statistics.stdev(window) if len(window) > 1 else None


def p50(window):
    return statistics.median(window) if window else None


def p90(window):
    return sorted(window)[math.floor((len(window) - 1) * 0.9 + 0.5)] if window else None


WIDTHS = [5 * MIN, HOUR, 6 * HOUR, 2 * DAY]


@pytest.mark.parametrize(
    "make, stat, label",
    [
        (rolling.rolling_mean, mean, "mean"),
        (rolling.rolling_std, std, "std"),
        (rolling.rolling_p50, p50, "p50"),
        (rolling.rolling_p90, p90, "p90"),
    ],
)
def test_rolling_against_brute_force(spark, make, stat, label):
    rows = series(1, keys=("a", "b"))
    got = by_key(make(frame(spark, rows), ["v"], WIDTHS, keys=("k",)))
    for key, found in got.items():
        points = sorted((t, v) for k, t, v in rows if k == key)
        assert [r["timestamp"] for r in found] == [t for t, _ in points]
        for w in WIDTHS:
            expected = expected_shifted(points, w, stat)
            assert [r[f"v_{label}_{w}i"] for r in found] == pytest.approx(expected, abs=1e-6)


def test_p90_query_has_all_widths(spark, tmp_path):
    given = spark.read.parquet("/root/testdata/sf0.001/events.parquet").filter("event_id % 4 = 0")
    given.write.parquet(str(tmp_path / "events.parquet"))
    names = list(tables.WIDE)
    grid = sorted(tuple(r) for r in tables.wide(spark, str(tmp_path)).select("timestamp", *names).collect())
    got = windows.rolling_query(spark, str(tmp_path), "p90").orderBy("timestamp").collect()
    assert len(got) == len(grid) > 200 and grid[-1][0] - grid[0][0] > 28 * DAY
    for k, c in enumerate(names, 1):
        points = [(r[0], r[k]) for r in grid]
        for w in features.WIDTHS:
            expected = expected_shifted(points, w, p90)
            assert [r[f"{c}_p90_{w}i"] for r in got] == pytest.approx(expected, abs=1e-4)


def test_equal_values_have_no_deviation(spark):
    rows = [("k", i * MIN, 1e6 + 0.1 if i > 500 else float(i)) for i in range(2000)]
    got = rolling.rolling_statistics(frame(spark, rows), ["v"], [HOUR, 12 * HOUR])
    late = got.filter(F.col("timestamp") > 1300 * MIN)
    assert {tuple(r) for r in late.select(f"v_std_{HOUR}i", f"v_std_{12 * HOUR}i").distinct().collect()} == {(0.0, 0.0)}


def test_non_finite_values_stay_in_their_frames(spark):
    rows = [("k", i * HOUR, NAN if i == 30 else (float("inf") if i == 90 else float(i % 5))) for i in range(150)]
    got = rolling.rolling_statistics(frame(spark, rows), ["v"], [HOUR, 6 * HOUR]).orderBy("timestamp").collect()
    for i, r in enumerate(got):
        m = r[f"v_mean_{6 * HOUR}i"]
        if 30 <= i < 36:
            assert math.isnan(m) and math.isnan(r[f"v_std_{6 * HOUR}i"])
        elif 90 <= i < 96:
            assert m == math.inf
        else:
            assert m == pytest.approx(mean([j % 5 for j in range(max(0, i - 5), i + 1)]))


def test_rows_of_one_timestamp_share_a_frame(spark):
    rows = [("k", 0, 1.0), ("k", 0, 3.0), ("k", MIN, 5.0)]
    got = rolling.rolling_statistics(frame(spark, rows), ["v"], [HOUR, 6 * HOUR], ("mean",)).collect()
    for w in (HOUR, 6 * HOUR):
        assert sorted(r[f"v_mean_{w}i"] for r in got) == [2.0, 2.0, 3.0]
    quantiles = rolling.rolling_quantile(frame(spark, rows), ["v"], [HOUR], 0.5, "p50").collect()
    assert sorted(r[f"v_p50_{HOUR}i"] for r in quantiles) == [2.0, 2.0, 3.0]


def test_lags_count_rows_not_time(spark):
    rows = series(5, keys=("a", "b"))
    got = by_key(features.lag_rows(frame(spark, rows), ["v"], {"1m": 1, "10m": 10, "12h": 720}, keys=("k",)))
    for key, found in got.items():
        values = [v for _, v in sorted((t, v) for k, t, v in rows if k == key)]
        assert [r["v_lag_1m"] for r in found] == [None, *values[:-1]]
        assert [r["v_lag_10m"] for r in found] == [None] * 10 + values[:-10]
        assert {r["v_lag_12h"] for r in found} == {None}


def test_small_row_blocks_give_the_same_lags(spark):
    indexed = ordering.with_row_index(frame(spark, series(6)))
    small = ordering.shift_rows(indexed, {"l": ("v", 7)}, block_rows=1).select("row_idx", "l")
    large = ordering.shift_rows(indexed, {"l": ("v", 7)}).select("row_idx", "l")
    assert small.exceptAll(large).isEmpty() and small.count() == large.count() == 160


def test_feature_set_against_single_steps(spark):
    rng = random.Random(8)
    rows = [(i * MIN, rng.random(), rng.random() * 9, None if rng.random() < 0.1 else 4.0) for i in range(300)]
    df = spark.createDataFrame(rows, "timestamp long, queue double, load double, rate double")
    columns = ["queue", "load", "rate"]
    got = features.generate_features(df, columns, "queue").orderBy("timestamp")
    assert len(got.columns) == 4 + 9 + 33 + 30 + 30 + 4 + 6 - 0
    assert got.columns[4:7] == ["hour_sin", "hour_cos", "hour_sin_1"]
    assert got.columns[13:16] == [f"{c}_lag_1m" for c in columns]
    found = got.collect()
    cpu = [r[2] for r in rows]
    h = [mean(cpu[max(0, i - 59) : i + 1]) for i in range(300)]
    sd = [std(cpu[max(0, i - 59) : i + 1]) for i in range(300)]
    i = 200
    assert found[i][f"load_mean_{HOUR}i"] == pytest.approx(h[i - 1])
    assert found[i]["load_diff_mean_1h"] == pytest.approx(cpu[i - 1] - h[i - 1])
    assert found[i]["load_delta_mean_1h"] == pytest.approx(h[i - 1] - h[i - 2])
    assert found[i]["load_zscore_1h"] == pytest.approx((cpu[i - 1] - h[i - 1]) / sd[i - 1])
    assert found[i]["load_ratio_mean_1h_1d"] == pytest.approx(h[i - 1] / mean(cpu[:i]))
    assert found[i]["rate_zscore_1h"] is None and found[0]["load_lag_1m"] is None
    minimal = features.generate_features(df, columns, "queue", kind="sequence")
    assert len(minimal.columns) == 4 + 9
    with pytest.raises(ValueError, match="unknown"):
        features.generate_features(df, ["nope"], "nope")


def test_seasonality(spark):
    monday = 1704067200000
    df = spark.createDataFrame([(monday + h * HOUR,) for h in (0, 6, 12)], "timestamp long")
    got = calendar.hour_seasonality(df).orderBy("timestamp").collect()
    assert [r["hour_sin"] for r in got] == pytest.approx([0, 1, 0], abs=1e-12)
    assert [r["hour_cos"] for r in got] == pytest.approx([1, 0, -1], abs=1e-12)
    days = spark.createDataFrame([(monday + d * DAY,) for d in (0, 1, 6)], "timestamp long")
    week = calendar.week_seasonality(calendar.business_day(days)).orderBy("timestamp").collect()
    assert [round(r["day_of_week_sin"], 3) for r in week] == pytest.approx([0.782, 0.975, 0], abs=1e-3)
    assert [round(r["day_of_week_cos"], 3) for r in week] == pytest.approx([0.623, -0.223, 1], abs=1e-3)
    assert [r["is_business_day"] for r in week] == [1, 1, 0]
    month = calendar.month_seasonality(days).first()
    assert month["month_sin"] == pytest.approx(0.5) and month["month_cos"] == pytest.approx(math.sqrt(3) / 2)
    harmonics = calendar.harmonics_hours(df).orderBy("timestamp").collect()
    assert harmonics[1]["hour_sin_3"] == pytest.approx(-1)
    assert calendar.business_day(df).schema["is_business_day"].dataType.simpleString() == "tinyint"


@pytest.mark.parametrize("text", ["2026-01-01", "20261301", "2026011", "x", "202601011"])
def test_day_keys_are_checked(text):
    with pytest.raises(ValueError):
        calendar.parse_day_key(text)
    assert calendar.parse_day_key("20240229") == "20240229"


def test_an_outlier_leaves_no_trace(spark):
    """Seven values in turn and one spike: frames without the spike are as exact as if it were not there."""
    rows = [("k", i * 10 * MIN, 1e12 if i == 1 else float(i % 7)) for i in range(3000)]
    w = 7 * DAY
    got = rolling.rolling_statistics(frame(spark, rows), ["v"], [w]).orderBy("timestamp").collect()
    for i in range(1100, 3000, 131):
        window = [rows[j][2] for j in range(i - w // (10 * MIN) + 1, i + 1)]
        assert got[i][f"v_std_{w}i"] == pytest.approx(statistics.stdev(window), rel=1e-9)
        assert got[i][f"v_mean_{w}i"] == pytest.approx(statistics.fmean(window), rel=1e-9)


def test_spikes_against_brute_force(spark):
    rng = random.Random(3)
    rows = [("k", i * MIN, rng.uniform(0, 9) * (1e9 if i % 97 == 0 else 1.0)) for i in range(600)]
    got = rolling.rolling_statistics(frame(spark, rows), ["v"], [5 * MIN, HOUR]).orderBy("timestamp").collect()
    for w in (5 * MIN, HOUR):
        for i, r in enumerate(got):
            window = [v for _, _, v in rows[max(0, i - w // MIN + 1) : i + 1]]
            assert r[f"v_mean_{w}i"] == pytest.approx(mean(window), rel=1e-9)
            assert r[f"v_std_{w}i"] == (pytest.approx(std(window), rel=1e-9) if i else None)
