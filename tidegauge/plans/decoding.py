"""Queries on nested messages and backend answers."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidegauge.functions.anyvalue import first_match, last_match
from tidegauge.operators import decode, responses
from tidegauge.plans import tables

RULES = [
    {"service.namespace": "ns-1", "service.name": None},
    {"service.namespace": "ns-2", "service.name": "svc-2"},
    {"service.namespace": "ns-2", "service.name": "svc-3"},
    {"service.namespace": "ns-3"},
]


def otlp_metrics_lake(spark, sf_dir):
    parsed = decode.parse_messages(tables.otlp_messages(spark, sf_dir))
    rows = decode.flatten_metrics(parsed)
    attributes = F.col("attributes")
    return rows.select(
        F.unix_micros("timestamp").alias("ts_us"),
        F.col("__name__").alias("name"),
        tables.shown("value").alias("value"),
        "service_name",
        "service_namespace",
        "host",
        "env",
        F.size("resource_attributes").alias("n_resource"),
        last_match(attributes, "k").alias("k"),
        last_match(attributes, "even").alias("even"),
        last_match(attributes, "n").alias("n"),
    )


_OTLP_POINT = """
    SELECT event_id, epoch_us(ts) AS ts_us, event_type, value, user_id,
           json_extract_string(props, '$.k') AS k,
           CASE WHEN event_id % 2 = 0 THEN 'True' ELSE 'False' END AS even,
           CAST(event_id AS VARCHAR) AS n,
           event_id % 5 AS kind, CASE WHEN event_id % 11 <> 0 THEN value END AS maybe
    FROM events
"""

OTLP_METRICS_LAKE_SQL = f"""
WITH p AS ({_OTLP_POINT})
SELECT ts_us, event_type AS name,
       round(CASE kind WHEN 0 THEN coalesce(maybe, 0.5) WHEN 1 THEN floor(value)
                  WHEN 2 THEN coalesce(maybe, 0.0) WHEN 3 THEN coalesce(maybe, 0.0) END + 1e-9, 6) AS value,
       'svc-' || (user_id % 7) AS service_name, 'ns-' || (user_id % 5) AS service_namespace,
       CASE WHEN user_id % 3 = 0 THEN 'h' ELSE 'hn' END || user_id AS host, 'prod' AS env,
       6 AS n_resource, k, even, n
FROM p
UNION ALL
SELECT ts_us, 'uptime', CAST(event_id AS DOUBLE), CAST(user_id AS VARCHAR), NULL, NULL, NULL, 1, k, even, n
FROM p
"""


def otlp_metrics_stream(spark, sf_dir):
    parsed = decode.parse_messages(tables.otlp_messages(spark, sf_dir))
    rows = decode.flatten_stream_metrics(parsed, RULES)
    attributes = F.col("attributes")
    return rows.select(
        F.col("timestamp").alias("ts_ns"),
        F.col("__name__").alias("name"),
        tables.shown("value").alias("value"),
        F.col("count").alias("n_count"),
        "service_name",
        "service_namespace",
        "k8s_pod_name",
        "host",
        "env",
        first_match(attributes, "k").alias("k"),
        first_match(attributes, "even").alias("even"),
    )


OTLP_METRICS_STREAM_SQL = f"""
WITH p AS ({_OTLP_POINT})
SELECT ts_us * 1000 AS ts_ns, event_type AS name,
       round(CASE kind WHEN 0 THEN coalesce(maybe, 0.5) WHEN 1 THEN floor(value)
                  ELSE coalesce(maybe, 0.0) END + 1e-9, 6) AS value,
       CASE WHEN kind >= 2 THEN event_id END AS n_count,
       'svc-' || (user_id % 7) AS service_name, 'ns-' || (user_id % 5) AS service_namespace,
       '' AS k8s_pod_name, 'h' || user_id AS host, CAST(NULL AS VARCHAR) AS env, k, '' AS even
FROM p
WHERE user_id % 5 IN (1, 3) OR (user_id % 5 = 2 AND user_id % 7 = 2)
"""


def otlp_logs(spark, sf_dir):
    parsed = decode.parse_messages(tables.otlp_log_messages(spark, sf_dir))
    rows = decode.flatten_logs(parsed)
    attributes = F.col("attributes")
    return rows.select(
        F.unix_micros("timestamp").alias("ts_us"),
        "line",
        "service_name",
        "host",
        "env",
        last_match(attributes, "conv").alias("conv"),
        last_match(attributes, "first").alias("is_first"),
    )


OTLP_LOGS_SQL = """
SELECT (conv_id * 3600 + turn * 60 + 1704067200) * 1000000 AS ts_us, text AS line, role AS service_name,
       CASE WHEN turn = 0 THEN 'fallback' ELSE CAST(turn AS VARCHAR) END AS host, '' AS env,
       CAST(conv_id AS VARCHAR) AS conv, CASE WHEN turn = 0 THEN 'True' ELSE 'False' END AS is_first
FROM conversations
"""


def _without_metrics(spark, sf_dir):
    """One message per event that is valid and holds no metric, in five forms by turns."""
    forms = ["{}", '{"resourceMetrics":[]}', '{"resourceMetrics":[{}]}', '{"resourceMetrics":[{"scopeMetrics":[]}]}']
    forms.append('{"resourceMetrics":[{"resource":{},"scopeMetrics":[{"metrics":[]}]}]}')
    turn = (F.col("event_id") % len(forms)).cast("int")
    return tables.events(spark, sf_dir).select(F.get(F.array(*map(F.lit, forms)), turn).alias("value"))


def otlp_empty(spark, sf_dir):
    """Messages without metrics among the others add no row."""
    messages = tables.otlp_messages(spark, sf_dir).select("value").unionByName(_without_metrics(spark, sf_dir))
    rows = decode.flatten_metrics(decode.parse_messages(messages))
    return rows.groupBy(F.col("__name__").alias("name")).agg(F.count(F.lit(1)).alias("n_points"))


OTLP_EMPTY_SQL = f"WITH lake AS ({OTLP_METRICS_LAKE_SQL}) SELECT name, count(*) AS n_points FROM lake GROUP BY 1"


def otlp_publishable(spark, sf_dir):
    """Messages that hold a metric, as JSON again; logs messages and those without metrics are skipped."""
    metrics = tables.otlp_messages(spark, sf_dir).select("value")
    logs = tables.otlp_log_messages(spark, sf_dir).select("value")
    parsed = decode.parse_messages(metrics.unionByName(logs).unionByName(_without_metrics(spark, sf_dir)))
    texts = decode.publishable(parsed)
    first = "$.resourceMetrics[0].scopeMetrics[0].metrics[0]"
    return texts.select(
        F.get_json_object("value", f"{first}.name").alias("name"),
        F.get_json_object("value", "$.resourceMetrics[1].resource.attributes[0].value.intValue").alias("bare"),
        F.get_json_object(
            "value", "$.resourceMetrics[1].scopeMetrics[0].metrics[0].sum.dataPoints[0].asInt"
        ).alias("uptime"),
    )


OTLP_PUBLISHABLE_SQL = """
SELECT event_type AS name, CAST(user_id AS VARCHAR) AS bare, CAST(event_id AS VARCHAR) AS uptime FROM events
"""


def response_series(spark, sf_dir):
    parsed = responses.parse_responses(tables.responses(spark, sf_dir))
    return responses.to_series(parsed, F.col("event_type")).select(
        "query_id", "timestamp", tables.shown("value").alias("value")
    )


RESPONSE_SERIES_SQL = """
SELECT event_type AS query_id, (epoch_us(ts) // 1000) AS timestamp, round(value + 1e-9, 6) AS value
FROM events WHERE event_id % 7 <> 0
UNION ALL
SELECT event_type, (epoch_us(ts) // 1000) + 1000, round(value + 1 + 1e-9, 6) FROM events WHERE event_id % 7 <> 0
"""


def response_values(spark, sf_dir):
    """Accessors: frames and raw values of a refId, present or absent."""
    parsed = responses.parse_responses(tables.responses(spark, sf_dir))
    results = F.col("results")
    first = F.get(responses.values_of(results, "A"), F.lit(1))
    return parsed.select(
        "event_id",
        F.size(responses.frames_of(results, "B")).alias("frames_b"),
        F.size(responses.frames_of(results, "C")).alias("frames_c"),
        F.size(responses.values_of(results, "B")).alias("columns_b"),
        F.size(responses.values_of(results, "C")).alias("columns_c"),
        tables.shown(F.get(first, F.lit(0))).alias("first_value"),
    )


RESPONSE_VALUES_SQL = """
SELECT event_id, 1 AS frames_b, 0 AS frames_c, 1 AS columns_b, 0 AS columns_c, round(value + 1e-9, 6) AS first_value
FROM events
"""


def response_to_otlp(spark, sf_dir):
    parsed = responses.parse_responses(tables.responses(spark, sf_dir))
    points = responses.to_gauge_points(parsed, carry=("event_id",))
    return points.select(
        "event_id",
        F.col("__name__").alias("name"),
        "time_unix_nano",
        tables.shown("value").alias("value"),
        first_match(F.col("attributes"), "job").alias("job"),
    )


RESPONSE_TO_OTLP_SQL = """
SELECT event_id, 'A' AS name, (epoch_us(ts) // 1000) * 1000000 AS time_unix_nano, round(value + 1e-9, 6) AS value,
       event_type AS job FROM events
UNION ALL
SELECT event_id, 'A', ((epoch_us(ts) // 1000) + 1000) * 1000000, round(value + 1 + 1e-9, 6), event_type
FROM events WHERE event_id % 7 <> 0
"""


def otlp_renest(spark, sf_dir):
    """Answers to nested messages, to JSON, and decoded again."""
    parsed = responses.parse_responses(tables.responses(spark, sf_dir))
    nested = responses.to_otlp(parsed, "probe", {"service.name": "integrations"})
    texts = nested.select(decode.serialize(F.col("message")).alias("value"))
    rows = decode.flatten_metrics(decode.parse_messages(texts))
    return rows.select(
        F.unix_micros("timestamp").alias("ts_us"),
        F.col("__name__").alias("name"),
        tables.shown("value").alias("value"),
        "service_name",
        last_match(F.col("attributes"), "job").alias("job"),
    )


OTLP_RENEST_SQL = """
SELECT (epoch_us(ts) // 1000) * 1000 AS ts_us, 'probe' AS name, round(value + 1e-9, 6) AS value,
       'integrations' AS service_name, event_type AS job FROM events
UNION ALL
SELECT ((epoch_us(ts) // 1000) + 1000) * 1000, 'probe', round(value + 1 + 1e-9, 6), 'integrations', event_type
FROM events WHERE event_id % 7 <> 0
"""


def _broken(text):
    """Six ways to break a message, by turns."""
    turn = F.expr("(event_id div 13) % 6")
    nanos = '"timeUnixNano":"[0-9]+"'
    return (
        F.when(turn == 0, F.substring(text, F.lit(1), F.length(text) - 1))
        .when(turn == 1, F.regexp_replace(text, nanos, '"timeUnixNano":"soon"'))
        .when(turn == 2, F.regexp_replace(text, nanos, '"timeUnixNano":"9223372036854775808"'))
        .when(turn == 3, F.regexp_replace(text, '"asInt":"[0-9-]+"', '"asInt":"many"'))
        .when(turn == 4, F.regexp_replace(text, '"intValue":"[0-9]+"', '"intValue":"x"'))
        .otherwise(F.regexp_replace(text, nanos, '"timeUnixNano":""'))
    )


def otlp_quarantine(spark, sf_dir):
    """Every 13th message is broken; the others are decoded, and the rejected ones counted."""
    messages = tables.otlp_messages(spark, sf_dir)
    text = F.when(F.col("event_id") % 13 == 0, _broken(F.col("value"))).otherwise(F.col("value"))
    parsed = decode.parse_messages(messages.select(text.alias("value")), "quarantine")
    good, bad = decode.split_bad(parsed)
    rows = decode.flatten_metrics(good)
    kept = rows.select(F.col("__name__").alias("name"), last_match(F.col("attributes"), "n").alias("n"))
    counted = bad.agg(F.count(F.lit(1)).cast("string").alias("n")).select(F.lit("rejected").alias("name"), "n")
    return kept.unionByName(counted)


OTLP_QUARANTINE_SQL = f"""
WITH lake AS ({OTLP_METRICS_LAKE_SQL})
SELECT name, n FROM lake WHERE CAST(n AS BIGINT) % 13 <> 0
UNION ALL
SELECT 'rejected', CAST(count(*) AS VARCHAR) FROM events WHERE event_id % 13 = 0
"""


QUERIES = {
    "otlp_empty": (otlp_empty, OTLP_EMPTY_SQL),
    "otlp_quarantine": (otlp_quarantine, OTLP_QUARANTINE_SQL),
    "otlp_metrics_lake": (otlp_metrics_lake, OTLP_METRICS_LAKE_SQL),
    "otlp_metrics_stream": (otlp_metrics_stream, OTLP_METRICS_STREAM_SQL),
    "otlp_logs": (otlp_logs, OTLP_LOGS_SQL),
    "otlp_publishable": (otlp_publishable, OTLP_PUBLISHABLE_SQL),
    "response_series": (response_series, RESPONSE_SERIES_SQL),
    "response_values": (response_values, RESPONSE_VALUES_SQL),
    "response_to_otlp": (response_to_otlp, RESPONSE_TO_OTLP_SQL),
    "otlp_renest": (otlp_renest, OTLP_RENEST_SQL),
}
