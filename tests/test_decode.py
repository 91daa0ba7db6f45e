from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from tests.otlp import golden, logs_message, metric, metrics_message, point
from tidegauge import schemas
from tidegauge.functions.anyvalue import float_text
from tidegauge.operators import decode


def texts(spark, *messages):
    return spark.createDataFrame([(m,) for m in messages], "value string")


def lake(spark, *messages, **options):
    return decode.flatten_metrics(decode.parse_messages(texts(spark, *messages)), **options)


def stream(spark, message, rules):
    return decode.flatten_stream_metrics(decode.parse_messages(texts(spark, message)), rules)


def pairs(items):
    return [(p["key"], p["value"]) for p in items]


def test_golden_message(spark):
    rows = lake(spark, golden()).cache()
    assert rows.count() == 898
    assert rows.select("__name__").distinct().count() == 98
    assert [r[0] for r in rows.select("service_name").distinct().collect()] == ["redpanda"]
    fetched = rows.filter(F.col("__name__") == "redpanda_kafka_records_fetched_total").collect()
    assert len(fetched) == 5 and 1674.0 in [r["value"] for r in fetched]
    assert rows.filter("service_namespace IS NOT NULL").count() == 0
    assert [(f.name, f.dataType) for f in rows.schema] == [(f.name, f.dataType) for f in schemas.METRIC]


@pytest.mark.parametrize(
    "include, count",
    [
        ([{"name": "redpanda_kafka_records_fetched_total"}], 5),
        ([{"name": "redpanda_kafka_records_fetched_total", "attributes": {"redpanda_namespace": "kafka$"}}], 3),
        ([{"name": "redpanda_kafka_records_fetched_total", "resource_attributes": {"service.name": "redpanda"}}], 5),
        ([{"name": "does_not_exist"}], 0),
        ([], 898),
    ],
)
def test_golden_message_filtered(spark, include, count):
    assert lake(spark, golden(), include=include).count() == count


def test_first_point_of_stream_profile(spark):
    message = json.loads(golden())
    message["resourceMetrics"][0]["resource"]["attributes"].append(
        {"key": "service.namespace", "value": {"stringValue": "ns"}}
    )
    rows = stream(spark, json.dumps(message), [{"service.namespace": "ns"}])
    first = rows.filter(F.col("__name__").startswith("redpanda_debug")).first()
    assert (first["timestamp"], first["value"], first["count"]) == (1772043702670000000, 0.0, None)
    assert rows.count() == 898 and rows.filter("count IS NOT NULL").count() == 0
    assert stream(spark, golden(), [{"service.namespace": "ns"}]).count() == 0


def test_value_by_kind(spark):
    message = metrics_message(
        {},
        [
            metric("g", "gauge", [point(asDouble=3.14)]),
            metric("i", "sum", [point(asInt="7")]),
            metric("n", "sum", [point(asInt=8)]),
            metric("u", "gauge", [point()]),
            metric("h", "histogram", [point(sum=250.0, count="10")]),
            metric("h0", "histogram", [point(count="10")]),
            metric("s", "summary", [point(sum=2.5, count="3")]),
            metric("e", "exponentialHistogram", [point(sum=9.0, count="4")]),
            {"name": "nothing"},
            metric("nan", "gauge", [point(asDouble="NaN")]),
        ],
    )
    got = {r["__name__"]: r["value"] for r in lake(spark, message).collect()}
    assert got.pop("nan") != got.get("nan")
    assert got == {"g": 3.14, "i": 7.0, "n": 8.0, "u": None, "h": 250.0, "h0": 0.0, "s": 2.5, "e": None}


def test_stream_values_and_counts(spark):
    message = metrics_message(
        {"service.namespace": "a"},
        [
            metric("g", "gauge", [point(asDouble=3.14)]),
            metric("h", "histogram", [point(sum=250.0, count="10")]),
            metric("h0", "histogram", [point(count=10)]),
            metric("e", "exponentialHistogram", [point(sum=9.0)]),
            metric("s", "summary", [point(sum=1.0, count="3")]),
        ],
    )
    got = {r["__name__"]: (r["value"], r["count"]) for r in stream(spark, message, [{"service.namespace": "a"}]).collect()}
    assert got == {"g": (3.14, None), "h": (250.0, 10), "h0": (0.0, 10), "e": (9.0, 0), "s": (1.0, 3)}


def test_stream_refuses_a_point_without_number(spark):
    message = metrics_message({"service.namespace": "a"}, [metric("g", "gauge", [point()])])
    with pytest.raises(Exception, match="neither asDouble nor asInt"):
        stream(spark, message, [{"service.namespace": "a"}]).collect()


@pytest.mark.parametrize(
    "resource, rules, kept",
    [
        ({"service.name": "x"}, [{"service.namespace": "a"}], False),
        ({"service.namespace": "b"}, [{"service.namespace": "a"}], False),
        ({"service.namespace": "a"}, [{"service.namespace": "a"}], True),
        ({"service.namespace": "a", "service.name": "s"}, [{"service.namespace": "a", "service.name": "s"}], True),
        ({"service.namespace": "a", "service.name": "t"}, [{"service.namespace": "a", "service.name": "s"}], False),
        ({"service.namespace": "a"}, [{"service.namespace": "a", "service.name": "s"}], True),
        (
            {"service.namespace": "a", "service.name": "t"},
            [{"service.namespace": "a", "service.name": "s"}, {"service.namespace": "a", "service.name": "t"}],
            False,
        ),
        ({"service.namespace": "a"}, [], False),
    ],
)
def test_allow_rules(spark, resource, rules, kept):
    message = metrics_message(resource, [metric("m", "gauge", [point(asDouble=1.0)])])
    assert stream(spark, message, rules).count() == int(kept)


def test_stream_takes_first_and_lake_takes_last_duplicate(spark):
    resource = [("service.namespace", "a"), ("service.name", "one"), ("service.name", "two"), ("host", 5)]
    message = metrics_message(resource, [metric("m", "gauge", [point(asDouble=1.0, attributes={"n": 1, "b": True})])])
    s = stream(spark, message, [{"service.namespace": "a"}]).first()
    assert (s["service_name"], s["host"], s["app"]) == ("one", "", None)
    assert pairs(s["attributes"]) == [("n", ""), ("b", "")]
    r = lake(spark, message).first()
    assert (r["service_name"], r["host"]) == ("two", "5")
    assert pairs(r["attributes"]) == [("n", "1"), ("b", "True")]
    assert pairs(r["resource_attributes"])[1:3] == [("service.name", "one"), ("service.name", "two")]


@pytest.mark.parametrize(
    "resource, host, env",
    [
        ({"host.name": "n", "host": "h"}, "n", None),
        ({"host.name": "", "host": "h"}, "h", None),
        ({"host.name": "", "host": ""}, None, None),
        ({"env": "", "deployment.environment": "prod"}, None, "prod"),
        ({"env": "dev", "deployment.environment": "prod"}, None, "dev"),
        ({"host.name": 0, "host": "h"}, "0", None),
        ({"host.name": {}, "host": "h"}, "h", None),
    ],
)
def test_metric_host_and_env(spark, resource, host, env):
    row = lake(spark, metrics_message(resource, [metric("m", "gauge", [point(asDouble=1.0)])])).first()
    assert (row["host"], row["env"]) == (host, env)


@pytest.mark.parametrize(
    "resource, host",
    [
        ({"host.name": "n", "host": "h"}, "n"),
        ({"host.name": "", "host": ""}, ""),
        ({"host.name": 0, "host": "h"}, "h"),
        ({"host.name": False, "host": 0}, "0"),
        ({"host.name": 0.0}, None),
        ({"host.name": 1.5}, "1.5"),
    ],
)
def test_log_host(spark, resource, host):
    message = logs_message(resource, [{"timeUnixNano": "5000", "body": {"stringValue": "x"}}])
    row = decode.flatten_logs(decode.parse_messages(texts(spark, message))).first()
    assert row["host"] == host


def test_log_rows(spark):
    message = logs_message(
        {"service.name": "svc"},
        [
            {"timeUnixNano": "1700000000000001999", "body": {"stringValue": "a"}},
            {"timeUnixNano": "0", "observedTimeUnixNano": "2000", "body": {"boolValue": False}},
            {"observedTimeUnixNano": "3000", "body": {"doubleValue": 1e-5}},
            {"body": {}},
            {"body": {"kvlistValue": {"values": []}}},
        ],
    )
    rows = decode.flatten_logs(decode.parse_messages(texts(spark, message)))
    got = [(r["us"], r["line"]) for r in rows.withColumn("us", F.unix_micros("timestamp")).collect()]
    assert got == [
        (1700000000000001, "a"),
        (2, "False"),
        (3, "1e-05"),
        (0, None),
        (0, '{"values":[]}'),
    ]
    assert rows.schema.names == schemas.LOG.names


def test_one_message_feeds_both_tables(spark):
    both = json.loads(metrics_message({}, [metric("m", "gauge", [point(asDouble=1.0)])]))
    both |= json.loads(logs_message({}, [{"timeUnixNano": "1"}]))
    both["somethingElse"] = 1
    parsed = decode.parse_messages(texts(spark, json.dumps(both), None))
    assert decode.flatten_metrics(parsed).count() == 1
    assert decode.flatten_logs(parsed).count() == 1


@pytest.mark.parametrize("text", ["{}", '{"resourceMetrics": []}', '{"resourceMetrics": [{}]}'])
def test_empty_messages(spark, text):
    rows = lake(spark, text)
    assert rows.count() == 0 and rows.schema.names == schemas.METRIC.names


def test_malformed_messages(spark):
    good = metrics_message({}, [metric("m", "gauge", [point(asDouble=1.0)])])
    bad_time = good.replace("1772043702670000000", "soon")
    with pytest.raises(Exception):
        lake(spark, "{not json").collect()
    parsed = decode.parse_messages(texts(spark, good, "{not json", bad_time), "quarantine")
    kept, rejected = decode.split_bad(parsed)
    assert decode.flatten_metrics(kept).count() == 1
    assert sorted(r[0] for r in rejected.collect()) == sorted(["{not json", bad_time])
    with pytest.raises(ValueError):
        decode.parse_messages(texts(spark, good), "ignore")


# One way each to break a message.
BREAKS = {
    "syntax": lambda text: text[:-1],
    "time": lambda text: text.replace('"timeUnixNano": "1772043702670000000"', '"timeUnixNano": "noon"'),
    "late time": lambda text: text.replace("1772043702670000000", "9223372036854775808"),
    "asInt": lambda text: text.replace('"asInt": "5"', '"asInt": "five"'),
    "sum": lambda text: text.replace('"sum": 2.5', '"sum": "much"'),
    "count": lambda text: text.replace('"count": "4"', '"count": "4.x"'),
    "attribute": lambda text: text.replace('"intValue": "3"', '"intValue": "3rd"'),
}


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_quarantine_takes_all_that_would_fail(spark, ansi):
    good = metrics_message(
        {"shelf": 3}, [metric("m", "gauge", [point(asInt="5")]), metric("h", "histogram", [point(sum=2.5, count="4")])]
    )
    broken = {name: make(good) for name, make in BREAKS.items()}
    assert all(text != good for text in broken.values())
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        parsed = decode.parse_messages(texts(spark, good, *broken.values()), "quarantine")
        kept, rejected = decode.split_bad(parsed)
        assert sorted(r["value"] for r in decode.flatten_metrics(kept).collect()) == [2.5, 5.0]
        assert sorted(r[0] for r in rejected.collect()) == sorted(broken.values())
        for name in ("time", "late time", "asInt", "sum"):
            with pytest.raises(Exception):
                lake(spark, broken[name]).collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_mixed_spelling_in_one_message(spark):
    text = metrics_message({}, [metric("m", "gauge", [point(asDouble=1.5)])])
    for name, other in {"scopeMetrics": "scope_metrics", "dataPoints": "data_points", "asDouble": "as_double"}.items():
        assert [r["value"] for r in lake(spark, text.replace(name, other)).collect()] == [1.5]


def test_publishable_skips_messages_without_metrics(spark):
    good = metrics_message({"a": 1}, [metric("m", "gauge", [point(asDouble=1.0)])])
    empty = metrics_message({}, [])
    out = decode.publishable(decode.parse_messages(texts(spark, good, empty, "{}")))
    rows = [json.loads(r[0]) for r in out.collect()]
    assert len(rows) == 1
    sent = rows[0]["resourceMetrics"][0]["scopeMetrics"][0]["metrics"][0]["gauge"]["dataPoints"][0]
    assert sent["timeUnixNano"] == "1772043702670000000"
    assert "sum" not in sent


def test_float_text(spark):
    numbers = [0.0, -0.0, 1.0, 0.1, 1e-3, 1e-4, 0.00025, -0.00099, 1e-5, 1.5e-5, 1e7, 12345678.9, 1e15, 1e16, -1.25e300]
    numbers += [float("inf"), float("-inf"), float("nan"), None]
    rows = spark.createDataFrame([(v,) for v in numbers], "v double").select(float_text(F.col("v"))).collect()
    assert [r[0] for r in rows] == [None if v is None else str(v) for v in numbers]


def test_json_is_parsed_once(spark):
    parsed = decode.parse_messages(texts(spark, golden()).repartition(1))
    plan = decode.flatten_metrics(parsed)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1


def test_field_names_of_the_definition(spark):
    message = metrics_message({"service.name": "a"}, [metric("m", "gauge", [point(asDouble=2.0, attributes={"resource_metrics": "as_int"})])])
    renamed = {
        "resourceMetrics": "resource_metrics",
        "scopeMetrics": "scope_metrics",
        "dataPoints": "data_points",
        "timeUnixNano": "time_unix_nano",
        "asDouble": "as_double",
        "stringValue": "string_value",
    }
    snake = message
    for camel, name in renamed.items():
        snake = snake.replace(f'"{camel}"', f'"{name}"')
    rows = lake(spark, message, snake).collect()
    assert len(rows) == 2 and rows[0] == rows[1]
    assert pairs(rows[0]["attributes"]) == [("resource_metrics", "as_int")]
