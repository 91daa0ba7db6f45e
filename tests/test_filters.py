from __future__ import annotations

from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from tidegauge.operators import filters
from tidegauge.functions.calendar import previous_day_range

SCHEMA = (
    "id int, __name__ string, resource_attributes array<struct<key:string,value:string>>, "
    "attributes array<struct<key:string,value:string>>"
)


def rows(spark, *items):
    data = [(i, name, list(res.items()), list(attr.items())) for i, (name, res, attr) in enumerate(items)]
    return spark.createDataFrame(data, SCHEMA)


def tagged(**attributes):
    return ("pump", {}, attributes)


@pytest.mark.parametrize(
    "rule, items, kept",
    [
        # a pattern may match anywhere in the value
        ({"attributes": {"valve": "nor"}}, [tagged(valve="north"), tagged(valve="south"), tagged(valve="no")], [0]),
        ({"attributes": {"valve": "^n|^w"}}, [tagged(valve="west"), tagged(valve="own"), tagged(valve="north")], [0, 2]),
        # all patterns of a rule must match
        (
            {"attributes": {"valve": "th$", "grade": "[12]"}},
            [tagged(valve="north", grade="3"), tagged(valve="south", grade="2"), tagged(grade="1")],
            [1],
        ),
        ({"attributes": {"colour": "x"}}, [tagged(valve="north"), tagged()], []),
        ({"attributes": {"valve": "."}}, [tagged(valve=None)], []),
        ({"resource_attributes": {"site": "^7$"}}, [("pump", {"site": "7"}, {}), ("pump", {"site": "77"}, {})], [0]),
        ({}, [tagged(), ("fan", {}, {})], [0]),
    ],
)
def test_include_rules(spark, rule, items, kept):
    got = filters.include_metrics(rows(spark, *items), [{"name": "pump", **rule}])
    assert sorted(r["id"] for r in got.collect()) == kept


def test_names_are_exact_and_rules_are_alternatives(spark):
    df = rows(spark, ("cpu_usage", {}, {}), ("mem", {}, {}), ("disk", {}, {}))
    assert filters.include_metrics(df, [{"name": "cpu.*"}]).count() == 0
    assert filters.include_metrics(df, [{"name": "mem"}, {"name": "disk"}]).count() == 2
    assert filters.include_metrics(df, []).count() == 3


def test_rule_table_equals_rule_list(spark):
    listed = [
        {"service.namespace": "a", "service.name": "s"},
        {"service.namespace": "a"},
        {"service.namespace": "b"},
    ]
    data = [(n, s) for n in ("a", "b", "c", None) for s in ("s", "t", None)]
    df = spark.createDataFrame(data, "service_namespace string, service_name string")
    table = spark.createDataFrame(
        [(r["service.namespace"], r.get("service.name"), i) for i, r in enumerate(listed)],
        "service_namespace string, service_name string, rule_order int",
    )
    by_list = df.filter(filters.allow_predicate(listed, F.col("service_namespace"), F.col("service_name")))
    by_table = filters.allow_join(df, table)
    assert sorted(map(str, by_list.collect())) == sorted(map(str, by_table.select(*df.columns).collect()))
    assert by_list.count() == 5


def test_log_rules(spark):
    data = [
        ("agent", "level=info started", []),
        ("agent", "information only", []),
        ("web", "x", [("level", "INFO")]),
        ("web", "info", [("level", "warn")]),
        ("web", None, []),
    ]
    df = spark.createDataFrame(
        data, "service_name string, line string, attributes array<struct<key:string,value:string>>"
    )

    def lines(rules):
        return [r["line"] for r in filters.include_logs(df, rules).collect()]

    assert lines([{"service_name": "agent"}]) == ["level=info started", "information only"]
    assert lines([{"level": "info"}]) == ["level=info started", "x"]
    assert lines([{"contains": "info"}]) == ["level=info started", "information only", "info"]
    assert lines([{"service_name": "web", "level": "info"}, {"contains": "only"}]) == ["information only", "x"]
    assert len(lines([])) == 5


@pytest.mark.parametrize("offset", [-1, 0, 1, 40])
@pytest.mark.parametrize("as_of", [datetime(2023, 1, 1), datetime(2024, 3, 1, 23, 59, 59), datetime(2025, 7, 9, 6)])
def test_previous_day(as_of, offset):
    start, end = previous_day_range(as_of, offset)
    day = as_of.date() - timedelta(days=1 + offset)
    assert start == datetime(day.year, day.month, day.day, tzinfo=timezone.utc)
    assert end == start + timedelta(days=1, seconds=-1)


def test_time_windows(spark):
    times = ["2026-03-01 00:00:00", "2026-03-01 23:59:59", "2026-03-01 23:59:59.5", "2026-03-02 00:00:00"]
    df = spark.createDataFrame([(t,) for t in times], "t string").select(F.to_timestamp("t").alias("timestamp"))
    assert filters.previous_day(df, datetime(2026, 3, 2, 14)).count() == 2
    assert filters.recent_window(df, 1, datetime(2026, 3, 2, 0, 0)).count() == 3
