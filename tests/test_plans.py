"""The physical plans the operators are meant to have."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from tidegauge.operators import aggregates, features, filters, merge, ordering, ranges, rolling
from tidegauge.plans import modelling, tables

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def shuffles(df):
    return len(re.findall(r"Exchange (?:hash|range|SinglePartition|RoundRobin)", plan(df)))


def test_training_aggregate_is_one_partial_aggregation(spark):
    df = aggregates.training_aggregate(tables.metric_rows(spark, SF), tables.AS_OF)
    text = plan(df)
    assert shuffles(df) == 1 and "partial_avg" in text
    assert "PushedFilters: [IsNotNull(ts)" in text
    assert "event_id" not in re.search(r"ReadSchema: (.*)", text).group(1)


def test_name_filter_reaches_the_scan(spark):
    df = filters.include_metrics(tables.metric_rows(spark, SF), [{"name": "click", "attributes": {"k": "1"}}])
    assert "EqualTo(event_type,click)" in plan(df) or "In(event_type, [click])" in plan(df)


def test_merge_folds_before_both_shuffles(spark):
    df = merge.merge_series(tables.series(spark, SF), tables.WIDE)
    text = plan(df)
    assert shuffles(df) == 2 and "Join" not in text and text.count("HashAggregate") == 4
    assert shuffles(merge.pivot_series(tables.series(spark, SF), tables.WIDE)) == 2


def test_no_single_partition_windows(spark):
    wide = tables.wide(spark, SF)
    columns = list(tables.WIDE)
    frames = {
        "rolling": rolling.rolling_statistics(wide, columns, [rolling.HOUR, 2 * rolling.DAY]),
        "lags": features.lag_rows(wide, columns, {"1m": 1}),
        "features": features.generate_features(wide, columns, tables.TARGET),
        "sequences": ordering.sequences(ordering.with_row_index(wide), columns, tables.TARGET, 5),
    }
    for name, df in frames.items():
        for line in plan(df).splitlines():
            if "Window [" in line and "_rows" not in line:
                assert "_block" in line, (name, line[:300])
        assert "CartesianProduct" not in plan(df) and "NestedLoop" not in plan(df)


def test_split_is_a_filter_on_the_scan(spark):
    df = tables.table(spark, SF, "events").select("event_id", F.col("user_id").alias("timestamp"))
    train, val, test = ordering.split_by_time(df, tie="event_id")
    for part in (train, val, test):
        assert shuffles(part) == 0 and "PushedFilters: [" in plan(part)
    assert train.count() + val.count() + test.count() == df.count()


def test_seasonality_is_narrow(spark):
    df = features.run_steps(tables.events(spark, SF), features.seasonal_steps())
    assert shuffles(df) == 0


@pytest.mark.parametrize("width", [rolling.HOUR, rolling.DAY, 30 * rolling.DAY])
def test_few_rows_are_copied(spark, width):
    df = spark.range(20_000).select((F.col("id") * 60_000).alias("timestamp"))
    copied = rolling.in_time_blocks(df, width, rolling.block_length(width), "timestamp")
    assert copied.filter("_in_home").count() == 20_000
    assert copied.count() <= 20_000 * 1.3 + 43_200


def test_messages_are_built_in_dealt_rows(spark):
    """The events are one small file, a task or few; what is built of them is not."""
    assert shuffles(tables.otlp_messages(spark, SF)) == 1


def test_models_read_a_stored_grid(spark):
    """Splits and models read their frame many times; the merge must not run once more for each."""
    assert shuffles(modelling._grid_frame(spark, SF)) == 0
    assert shuffles(modelling._demand_frame(spark, SF)) == 0


def test_chunks_are_summed_in_tasks_of_a_bounded_size(spark, monkeypatch):
    monkeypatch.setattr(ranges, "TASK_SAMPLES", 20)
    samples = tables.events(spark, SF).select("user_id", "timestamp", "value")
    for function in (ranges.avg_over_time, ranges.rate):
        df = function(samples, ("user_id",), 21_600_000, 7_200_000)
        assert f", {-(-samples.count() // 20)}), REPARTITION_BY_NUM" in plan(df)
