"""Small builders of OTLP JSON messages."""

from __future__ import annotations

import json


def value(v):
    if isinstance(v, dict):
        return v
    if isinstance(v, bool):
        return {"boolValue": v}
    if isinstance(v, int):
        return {"intValue": str(v)}
    if isinstance(v, float):
        return {"doubleValue": v}
    return {"stringValue": v}


def attrs(pairs):
    items = pairs.items() if isinstance(pairs, dict) else pairs
    return [{"key": k, "value": value(v)} for k, v in items]


def point(ns=1_772_043_702_670_000_000, attributes=(), **fields):
    return {"timeUnixNano": str(ns), "attributes": attrs(dict(attributes)), **fields}


def metric(name, kind="gauge", points=()):
    return {"name": name, kind: {"dataPoints": list(points)}}


def metrics_message(resource, metrics):
    return json.dumps(
        {
            "resourceMetrics": [
                {"resource": {"attributes": attrs(resource)}, "scopeMetrics": [{"metrics": list(metrics)}]}
            ]
        }
    )


def logs_message(resource, records):
    return json.dumps(
        {
            "resourceLogs": [
                {"resource": {"attributes": attrs(resource)}, "scopeLogs": [{"logRecords": list(records)}]}
            ]
        }
    )


def golden():
    """98 names and 898 points of one service, as in FIXTURES.md."""
    fetched = "redpanda_kafka_records_fetched_total"
    first = "redpanda_debug_bundle_last_failed_bundle_timestamp_seconds"
    namespaces = ["kafka", "kafka", "kafka", "kafka_internal", "redpanda"]
    metrics = [metric(first, points=[point(asDouble=0.0)])]
    metrics.append(
        metric(
            fetched,
            points=[
                point(asDouble=1674.0 if i == 0 else float(i), attributes={"redpanda_namespace": ns})
                for i, ns in enumerate(namespaces)
            ],
        )
    )
    left, names = 898 - 1 - 5, 96
    for i in range(names):
        count = left // names + (1 if i < left % names else 0)
        metrics.append(
            metric(f"metric_{i}", points=[point(asDouble=float(j), attributes={"j": str(j)}) for j in range(count)])
        )
    return metrics_message({"service.name": "redpanda"}, metrics)
