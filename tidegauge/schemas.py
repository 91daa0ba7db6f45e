"""Row layouts shared by the decoders, the lake tables and the readers."""

from __future__ import annotations

from pyspark.sql import types as T

KV = T.StructType([T.StructField("key", T.StringType()), T.StructField("value", T.StringType())])
KV_LIST = T.ArrayType(KV)

_PROMOTED = [
    T.StructField(name, T.StringType())
    for name in (
        "service_name",
        "service_namespace",
        "k8s_namespace_name",
        "cluster_name",
        "host",
        "env",
    )
]
_LISTS = [T.StructField("resource_attributes", KV_LIST), T.StructField("attributes", KV_LIST)]

METRIC = T.StructType(
    [
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("__name__", T.StringType()),
        T.StructField("value", T.DoubleType()),
        *_PROMOTED,
        *_LISTS,
    ]
)

LOG = T.StructType(
    [
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("line", T.StringType()),
        *_PROMOTED,
        *_LISTS,
    ]
)

STREAM_METRIC = T.StructType(
    [
        T.StructField("timestamp", T.LongType()),
        T.StructField("__name__", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("count", T.LongType()),
        *[
            T.StructField(name, T.StringType())
            for name in (
                "service_name",
                "service_namespace",
                "app",
                "env",
                "zone",
                "k8s_namespace_name",
                "cluster_name",
                "k8s_pod_name",
                "host",
                "topic",
            )
        ],
        *_LISTS,
    ]
)

# OTLP JSON. Numbers are declared as text because the protocol allows both quoted and bare
# numbers; the decoders cast them.
ANY_VALUE = T.StructType(
    [
        T.StructField("stringValue", T.StringType()),
        T.StructField("intValue", T.StringType()),
        T.StructField("doubleValue", T.StringType()),
        T.StructField("boolValue", T.BooleanType()),
        T.StructField("bytesValue", T.StringType()),
        T.StructField("arrayValue", T.StringType()),
        T.StructField("kvlistValue", T.StringType()),
    ]
)

OTLP_ATTRIBUTES = T.ArrayType(
    T.StructType([T.StructField("key", T.StringType()), T.StructField("value", ANY_VALUE)])
)

_RESOURCE = T.StructType([T.StructField("attributes", OTLP_ATTRIBUTES)])
_SCOPE = T.StructType([T.StructField("name", T.StringType())])

DATA_POINT = T.StructType(
    [
        T.StructField("timeUnixNano", T.StringType()),
        T.StructField("asDouble", T.StringType()),
        T.StructField("asInt", T.StringType()),
        T.StructField("sum", T.StringType()),
        T.StructField("count", T.StringType()),
        T.StructField("attributes", OTLP_ATTRIBUTES),
    ]
)

_POINTS = T.StructType([T.StructField("dataPoints", T.ArrayType(DATA_POINT))])

METRIC_KINDS = ("gauge", "sum", "histogram", "summary", "exponentialHistogram")

OTLP_METRIC = T.StructType(
    [
        T.StructField("name", T.StringType()),
        *[T.StructField(kind, _POINTS) for kind in METRIC_KINDS],
    ]
)

RESOURCE_METRICS = T.ArrayType(
    T.StructType(
        [
            T.StructField("resource", _RESOURCE),
            T.StructField(
                "scopeMetrics",
                T.ArrayType(
                    T.StructType(
                        [
                            T.StructField("scope", _SCOPE),
                            T.StructField("metrics", T.ArrayType(OTLP_METRIC)),
                        ]
                    )
                ),
            ),
        ]
    )
)

LOG_RECORD = T.StructType(
    [
        T.StructField("timeUnixNano", T.StringType()),
        T.StructField("observedTimeUnixNano", T.StringType()),
        T.StructField("body", ANY_VALUE),
        T.StructField("attributes", OTLP_ATTRIBUTES),
    ]
)

RESOURCE_LOGS = T.ArrayType(
    T.StructType(
        [
            T.StructField("resource", _RESOURCE),
            T.StructField(
                "scopeLogs",
                T.ArrayType(
                    T.StructType(
                        [
                            T.StructField("scope", _SCOPE),
                            T.StructField("logRecords", T.ArrayType(LOG_RECORD)),
                        ]
                    )
                ),
            ),
        ]
    )
)

OTLP_MESSAGE = T.StructType(
    [
        T.StructField("resourceMetrics", RESOURCE_METRICS),
        T.StructField("resourceLogs", RESOURCE_LOGS),
    ]
)

# Answer of the dashboard backend: column arrays per frame. Numbers may be quoted, so they are text here.
RESPONSE = T.StructType(
    [
        T.StructField(
            "results",
            T.MapType(
                T.StringType(),
                T.StructType(
                    [
                        T.StructField(
                            "frames",
                            T.ArrayType(
                                T.StructType(
                                    [
                                        T.StructField(
                                            "schema",
                                            T.StructType(
                                                [
                                                    T.StructField("name", T.StringType()),
                                                    T.StructField(
                                                        "fields",
                                                        T.ArrayType(
                                                            T.StructType(
                                                                [
                                                                    T.StructField(
                                                                        "name", T.StringType()
                                                                    ),
                                                                    T.StructField(
                                                                        "type", T.StringType()
                                                                    ),
                                                                    T.StructField(
                                                                        "labels",
                                                                        T.MapType(
                                                                            T.StringType(),
                                                                            T.StringType(),
                                                                        ),
                                                                    ),
                                                                ]
                                                            )
                                                        ),
                                                    ),
                                                ]
                                            ),
                                        ),
                                        T.StructField(
                                            "data",
                                            T.StructType(
                                                [
                                                    T.StructField(
                                                        "values",
                                                        T.ArrayType(T.ArrayType(T.StringType())),
                                                    )
                                                ]
                                            ),
                                        ),
                                    ]
                                )
                            ),
                        )
                    ]
                ),
            ),
        )
    ]
)
