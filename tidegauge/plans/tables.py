"""The given tables in the shapes the operators expect."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.session import prepare

# Fixed value: the events end on 2024-01-30, so "now" for them is the day after.
AS_OF = datetime(2024, 1, 31, tzinfo=timezone.utc)

# Query ids of the wide frame, in column order, with their resample aggregates.
WIDE = {"view": "mean", "click": "mean", "error": "mean", "purchase": "mean", "signup": "mean"}
TARGET = "view"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def shown(value: Column | str, digits: int = 6) -> Column:
    """Round for display. Means of two-decimal numbers often end exactly on a rounding border; the
    small offset, which the SQL twins add too, keeps both engines on the same side of it."""
    column = F.col(value) if isinstance(value, str) else value
    return F.round(column + F.lit(float(f"1e-{digits + 3}")), digits)


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with ``at`` (UTC instant) and ``timestamp`` (epoch milliseconds)."""
    at = F.col("ts").cast("timestamp")
    return table(spark, sf_dir, "events").withColumns({"at": at, "timestamp": F.unix_millis(at)})


def _dealt(rows: DataFrame, *key: str) -> DataFrame:
    """Rows dealt over the cluster by their key, before much larger messages are built of them.

    A scan has as many tasks as its files have blocks, and a small file of short rows makes very many messages.
    """
    return rows.repartition(*key)


def _pair(key: str, value: Column) -> Column:
    return F.struct(F.lit(key).alias("key"), value.cast("string").alias("value"))


def tag() -> Column:
    """The number inside ``props``, as text."""
    return F.get_json_object("props", "$.k")


def metric_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as flat metric rows."""
    user = F.col("user_id")
    return events(spark, sf_dir).select(
        "event_id",
        F.col("at").alias("timestamp"),
        F.col("event_type").alias("__name__"),
        "value",
        F.concat(F.lit("svc-"), (user % 7).cast("string")).alias("service_name"),
        F.when(user % 5 != 0, F.concat(F.lit("ns-"), (user % 5).cast("string"))).alias(
            "service_namespace"
        ),
        F.array(_pair("user", user)).alias("resource_attributes"),
        F.array(_pair("k", tag()), _pair("kind", F.col("event_type"))).alias("attributes"),
    )


def series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as long series, one per event type."""
    return events(spark, sf_dir).select(
        F.col("event_type").alias("query_id"), "timestamp", "value", "event_id"
    )


def damaged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with NULL in every 17th value and NaN in every 23rd."""
    value = (
        F.when(F.col("event_id") % 17 == 0, F.lit(None).cast("double"))
        .when(F.col("event_id") % 23 == 0, F.lit(float("nan")))
        .otherwise(F.col("value"))
    )
    return events(spark, sf_dir).select("event_id", "timestamp", "event_type", value.alias("value"))


def _any(**alternatives: Column) -> Column:
    return F.struct(*[c.alias(name) for name, c in alternatives.items()])


def _attr(key: str, value: Column) -> Column:
    return F.struct(F.lit(key).alias("key"), value.alias("value"))


def _text(c: Column) -> Column:
    """A string alternative; int and bool alternatives stay unset."""
    return _any(
        stringValue=c.cast("string"),
        intValue=F.lit(None).cast("string"),
        boolValue=F.lit(None).cast("boolean"),
    )


def _int(c: Column) -> Column:
    return _any(
        stringValue=F.lit(None).cast("string"),
        intValue=c.cast("string"),
        boolValue=F.lit(None).cast("boolean"),
    )


def _bool(c: Column) -> Column:
    return _any(
        stringValue=F.lit(None).cast("string"), intValue=F.lit(None).cast("string"), boolValue=c
    )


def otlp_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One OTLP metrics message per event, with a metric of each kind in turn.

    Every message nests two resources; the second has no namespace and one sum point. Built inside
    the row, so the messages grow with the table and nothing is grouped.
    """
    user, eid = F.col("user_id"), F.col("event_id")
    nanos = (F.unix_micros("at") * 1000).cast("string")

    def point(**fields: Column) -> Column:
        return F.struct(
            nanos.alias("timeUnixNano"),
            *[c.alias(name) for name, c in fields.items()],
            F.array(
                _attr("k", _text(tag())), _attr("even", _bool(eid % 2 == 0)), _attr("n", _int(eid))
            ).alias("attributes"),
        )

    def points(when: Column, body: Column) -> Column:
        return F.when(when, F.struct(F.array(body).alias("dataPoints")))

    # Unset values are left out of the JSON, as a sender would do it.
    value = F.when(eid % 11 != 0, F.col("value"))
    kind = eid % 5
    main_metric = F.struct(
        F.col("event_type").alias("name"),
        points(kind == 0, point(asDouble=F.coalesce(value, F.lit(0.5)))).alias("gauge"),
        points(kind == 1, point(asInt=F.floor("value").cast("string"))).alias("sum"),
        points(kind == 2, point(sum=value, count=eid.cast("string"))).alias("histogram"),
        points(kind == 3, point(sum=value, count=eid.cast("string"))).alias("summary"),
        points(kind == 4, point(sum=value, count=eid.cast("string"))).alias("exponentialHistogram"),
    )
    side_metric = F.struct(
        F.lit("uptime").alias("name"), points(F.lit(True), point(asInt=eid.cast("string"))).alias("sum")
    )
    resource = F.struct(
        F.array(
            _attr("service.name", _text(F.concat(F.lit("svc-"), (user % 7).cast("string")))),
            _attr("service.namespace", _text(F.concat(F.lit("ns-"), (user % 5).cast("string")))),
            _attr("host", _text(F.concat(F.lit("h"), user.cast("string")))),
            _attr("host.name", _text(F.when(user % 3 == 0, "").otherwise(F.concat(F.lit("hn"), user.cast("string"))))),
            _attr("deployment.environment", _text(F.lit("prod"))),
            _attr("k8s_pod_name", _int(user)),
        ).alias("attributes")
    )
    bare = F.struct(F.array(_attr("service.name", _int(user))).alias("attributes"))
    message = F.struct(
        F.array(
            F.to_json(
                F.struct(
                    resource.alias("resource"),
                    F.array(F.struct(F.array(main_metric).alias("metrics"))).alias("scopeMetrics"),
                )
            ),
            F.to_json(
                F.struct(
                    bare.alias("resource"),
                    F.array(F.struct(F.array(side_metric).alias("metrics"))).alias("scopeMetrics"),
                )
            ),
        ).alias("parts")
    )
    text = F.concat(
        F.lit('{"resourceMetrics":['), F.array_join(message["parts"], ","), F.lit("]}")
    )
    return _dealt(events(spark, sf_dir), "event_id").select("event_id", text.alias("value"))


def otlp_log_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One OTLP logs message per conversation turn."""
    conv, turn = F.col("conv_id"), F.col("turn")
    nanos = ((conv * 3600 + turn * 60 + 1_704_067_200) * 1_000_000_000).cast("string")
    record = F.struct(
        F.when(turn % 2 == 0, nanos).otherwise("0").alias("timeUnixNano"),
        nanos.alias("observedTimeUnixNano"),
        _text(F.col("text")).alias("body"),
        F.array(_attr("conv", _int(conv)), _attr("first", _bool(turn == 0))).alias("attributes"),
    )
    resource = F.struct(
        F.array(
            _attr("service.name", _text(F.col("role"))),
            _attr("host.name", _int(turn)),
            _attr("host", _text(F.lit("fallback"))),
            _attr("env", _text(F.lit(""))),
            _attr("deployment.environment", _text(F.lit(""))),
        ).alias("attributes")
    )
    message = F.struct(
        F.array(
            F.struct(
                resource.alias("resource"),
                F.array(F.struct(F.array(record).alias("logRecords"))).alias("scopeLogs"),
            )
        ).alias("resourceLogs")
    )
    return _dealt(table(spark, sf_dir, "conversations"), "conv_id", "turn").select(
        "conv_id", "turn", F.to_json(message).alias("value")
    )


def responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One backend answer per event: refId A with a labelled frame of two points, one of them NULL
    for every 7th event, and refId B with a frame of one column."""
    eid = F.col("event_id")
    time = F.col("timestamp").cast("double")
    second = F.when(eid % 7 == 0, F.lit("null")).otherwise((F.col("value") + 1).cast("string"))
    stamp = F.col("timestamp").cast("string")
    text = F.concat(
        F.lit('{"results":{"A":{"frames":[{"schema":{"name":"f","fields":[{"name":"time","type":"time"},'
              '{"name":"v","type":"number","labels":{"job":"'),
        F.col("event_type"),
        F.lit('"}}]},"data":{"values":[['),
        stamp, F.lit(","), (F.col("timestamp") + 1000).cast("string"),
        F.lit("],["),
        F.col("value").cast("string"), F.lit(","), second,
        F.lit(']]}}]},"B":{"frames":[{"schema":{"fields":[]},"data":{"values":[['),
        stamp,
        F.lit("]]}}]}}}"),
    )
    return _dealt(events(spark, sf_dir), "event_id").select("event_id", "event_type", text.alias("value"))


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversation turns as log lines: role as service, one line per minute and conversation hour."""
    conv, turn = F.col("conv_id"), F.col("turn")
    ms = (conv % 500 * 60 + turn * 10 + 1_704_067_200) * 1000
    return table(spark, sf_dir, "conversations").select(
        "conv_id",
        "turn",
        ms.alias("timestamp"),
        F.col("text").alias("line"),
        F.col("role").alias("service_name"),
        F.array(_pair("level", F.when(turn % 2 == 0, "info").otherwise("warn"))).alias("attributes"),
    )


def wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events on the one-minute grid, one column per query id of :data:`WIDE`."""
    from tidegauge.operators.merge import merge_series

    return merge_series(series(spark, sf_dir), WIDE)
