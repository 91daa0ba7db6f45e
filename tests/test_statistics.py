from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidegauge.operators import aggregates, ranges, standardize

NAN = float("nan")


def test_standardize(spark):
    train = spark.createDataFrame([(1.0, 10.0), (3.0, 30.0), (5.0, 50.0)], "a double, b double")
    other = spark.createDataFrame([(7.0, 70.0)], "a double, b double")
    scaled, (applied,), scale = standardize.standardize(train, [other], ["a", "b"])
    assert scale.mean == {"a": 3.0, "b": 30.0}
    assert scale.std == pytest.approx({"a": 1.63299316, "b": 16.32993162})
    assert list(applied.first()) == pytest.approx([2.44948974, 2.44948974])
    assert [r["a"] for r in scaled.collect()] == pytest.approx([-1.22474487, 0, 1.22474487])


def test_standardize_edges(spark):
    constant = spark.createDataFrame([(5.0,), (5.0,)], "a double")
    assert standardize.fit_scale(constant, ["a"]).std == {"a": 1.0}
    with pytest.raises(ValueError):
        standardize.fit_scale(constant.filter("a < 0"), ["a"])
    tiny = spark.createDataFrame([(0.0,), (1e-9,)], "y double")
    assert standardize.fit_target(tiny, "y").std == {"y": 1.0}
    assert standardize.fit_scale(tiny, ["y"]).std["y"] == pytest.approx(5e-10)
    bad = spark.createDataFrame([(0.0,), (NAN,)], "y double")
    assert standardize.fit_target(bad, "y").std == {"y": 1.0}
    scale = standardize.Scale({"y": 10.0}, {"y": 2.0})
    back = spark.createDataFrame([(1.5,)], "p double")
    assert standardize.restore_target(back, scale, "p", "y").first()[0] == 13.0
    cut = standardize.clip_columns(spark.createDataFrame([(99.0,), (-99.0,), (None,), (1.0,)], "a double"), ["a"])
    assert [r[0] for r in cut.collect()] == [20.0, -20.0, None, 1.0]


def test_error_measures(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 2.0), (4.0, 1.0)], "y double, p double")
    row = aggregates.evaluate(df, "y", "p").first()
    assert row["mae"] == pytest.approx(4 / 3)
    assert row["rmse"] == pytest.approx((10 / 3) ** 0.5)
    assert row["mape"] == pytest.approx((1 + 0 + 0.75) / 3)
    zero = aggregates.evaluate(spark.createDataFrame([(0.0, 1.0)], "y double, p double"), "y", "p").first()
    assert zero["mape"] == pytest.approx(1 / 2.220446049250313e-16)


def test_ensemble_and_last_series(spark):
    runs = spark.createDataFrame([(1, 2.0), (1, 4.0), (2, 1.0)], "row_id long, prediction double")
    assert {tuple(r) for r in aggregates.ensemble_mean(runs).collect()} == {(1, 3.0), (2, 1.0)}
    listed = spark.createDataFrame(
        [("a", 0, 0, 1.0), ("a", 0, 1, 2.0), ("a", 0, 1, 3.0), ("b", 0, 5, 4.0), ("b", 1, 0, 5.0)],
        "query_id string, kind int, ordinal int, value double",
    )
    assert sorted(r["value"] for r in aggregates.keep_last_series(listed).collect()) == [2.0, 3.0, 5.0]


def metric_frame(spark, rows):
    kv = "array<struct<key:string,value:string>>"
    return spark.createDataFrame(rows, f"t string, `__name__` string, value double, attributes {kv}, resource_attributes {kv}").select(
        F.to_timestamp("t").alias("timestamp"), "__name__", "value", "attributes", "resource_attributes"
    )


def test_training_aggregate(spark):
    a, b = [("x", "1"), ("y", "2")], [("y", "2"), ("x", "1")]
    rows = [
        ("2024-01-10 00:01:00", "m", 1.0, a, []),
        ("2024-01-10 00:04:59.999", "m", 3.0, b, []),
        ("2024-01-10 00:05:00", "m", 9.0, a, []),
        ("2024-01-10 00:05:00", "m", None, a, [("r", "1")]),
        ("2024-01-01 00:05:00", "m", 9.0, a, []),
    ]
    df = metric_frame(spark, rows)
    as_of = datetime(2024, 1, 11)
    got = aggregates.training_aggregate(df, as_of).collect()
    assert sorted((str(r["bucket"])[11:], r["value"], len(r["resource_attributes"])) for r in got if r["value"]) == [
        ("00:00:00", 2.0, 0),
        ("00:05:00", 9.0, 0),
    ]
    assert len(got) == 3 and all(r["timestamp"] % 300000 == 0 for r in got)
    assert aggregates.training_aggregate(df, as_of, bucket_minutes=None).count() == 4
    twice = metric_frame(spark, [("2024-01-10 00:01:00", "m", 1.0, [("x", "1"), ("x", "2")], [])])
    with pytest.raises(Exception, match="DUPLICATED_MAP_KEY"):
        aggregates.training_aggregate(twice, as_of).collect()


def brute_steps(points, range_ms, step, measure):
    out = {}
    first = min(t for t, _ in points) // step * step
    last = max(t for t, _ in points) + range_ms
    for t in range(first, last + step, step):
        window = sorted(p for p in points if t - range_ms < p[0] <= t)
        value = measure(window)
        if value is not None:
            out[t] = value
    return out


def grown(window, seconds):
    pairs = list(zip(window, window[1:]))
    if not pairs:
        return None
    return sum(b[1] - a[1] if b[1] >= a[1] else b[1] for a, b in pairs) / seconds


@pytest.mark.parametrize("span,step", [(60_000, 60_000), (60_000, 20_000), (420_000, 180_000), (45_000, 60_000), (600_000, 600)])
def test_range_functions_against_brute_force(spark, span, step):
    import random

    rng = random.Random(step)
    points, value = [], 0.0
    for t in sorted(rng.sample(range(0, 2_000_000, 500), 150)):
        value = 0.5 if rng.random() < 0.1 else value + rng.random()
        points.append((t, value))
        if rng.random() < 0.1:
            value += rng.choice([0.0, 0.25])
            points.append((t, value))
    df = spark.createDataFrame([("s", t, v) for t, v in points], "series string, timestamp long, value double")
    means = {r["timestamp"]: r["value"] for r in ranges.avg_over_time(df, ("series",), span, step).collect()}
    assert means == pytest.approx(
        brute_steps(points, span, step, lambda w: sum(v for _, v in w) / len(w) if w else None)
    )
    rates = {r["timestamp"]: r["value"] for r in ranges.rate(df, ("series",), span, step).collect()}
    assert rates == pytest.approx(brute_steps(points, span, step, lambda w: grown(w, span / 1000)))
    lines = df.withColumn("line", F.when(F.col("value") > 1, "has info").otherwise("none"))
    counts = {r["timestamp"]: r["value"] for r in ranges.count_over_time(lines, ("series",), "info", span, step).collect()}
    assert counts == brute_steps(points, span, step, lambda w: sum(v > 1 for _, v in w) or None)
    assert ranges.sum_by_step(ranges.rate(df, ("series",), span, step)).count() == len(rates)


def test_range_rules(spark):
    df = spark.createDataFrame([("s", 1, 1.0)], "series string, timestamp long, value double")
    assert ranges.rate(df, ("series",), 60_000, 45_000).count() == 0  # one sample is no increase
    assert ranges.align_to_step(df, 1000).first()["timestamp"] == 0
    labelled = df.withColumn("attributes", F.create_map(F.lit("job"), F.lit("a")))
    assert ranges.select_labels(labelled, {"job": "a"}).count() == 1
    assert ranges.select_labels(labelled, {"job": "a", "x": "y"}).count() == 0
