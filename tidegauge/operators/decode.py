"""OTLP JSON messages to flat rows and back.

Every level of the nested message is unfolded by its own ``explode``, so name and resource filters
sit between the levels and the rows they reject are never expanded further.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegauge import schemas
from tidegauge.functions.anyvalue import (
    any_text,
    any_truthy,
    first_match,
    kv_strings,
    kv_texts,
)
from tidegauge.functions.calendar import from_nanos
from tidegauge.functions.numbers import any_of, strict, unfold
from tidegauge.operators.filters import allow_predicate, include_predicate

_CORRUPT = "_corrupt"

# Field names of the protocol as its definition spells them.
_PROTO_NAMES = [
    "resource_metrics",
    "scope_metrics",
    "data_points",
    "exponential_histogram",
    "time_unix_nano",
    "as_double",
    "as_int",
    "resource_logs",
    "scope_logs",
    "log_records",
    "observed_time_unix_nano",
    "string_value",
    "int_value",
    "double_value",
    "bool_value",
    "bytes_value",
    "array_value",
    "kvlist_value",
]


def _camel(name: str) -> str:
    first, *rest = name.split("_")
    return first + "".join(word.capitalize() for word in rest)


def _camel_names(text: Column) -> Column:
    """Rename the keys of messages written with the definition's own field names.

    A key is an unescaped quoted name with a colon behind it, so values are never touched. A message
    may mix both spellings; one without any such name does not pay for the renaming.
    """
    renamed = text
    for name in _PROTO_NAMES:
        renamed = F.regexp_replace(renamed, rf'(?<!\\)"{name}"\s*:', f'"{_camel(name)}":')
    # the test looks for underscores, which are rare, and for how such names end, before it looks for a key
    ends = sorted({name.rsplit("_", 1)[1] for name in _PROTO_NAMES})
    spelled = text.rlike("_(?:" + "|".join(ends) + r')"\s*:')
    return F.when(spelled, renamed).otherwise(text)


def parse_messages(df: DataFrame, on_error: str = "fail", value: str = "value") -> DataFrame:
    """Parse the JSON text in ``value`` into ``message`` (metric and log roots side by side).

    ``fail`` stops at the first malformed message. ``quarantine`` keeps going: rows gain an
    ``is_bad`` flag and :func:`split_bad` parts them. NULL texts are dropped.
    """
    rows = df.filter(F.col(value).isNotNull())
    text = _camel_names(F.col(value))
    if on_error == "fail":
        return rows.withColumn(
            "message", F.from_json(text, schemas.OTLP_MESSAGE, {"mode": "FAILFAST"})
        )
    if on_error != "quarantine":
        raise ValueError(f"on_error must be 'fail' or 'quarantine', not '{on_error}'")
    layout = T.StructType([*schemas.OTLP_MESSAGE.fields, T.StructField(_CORRUPT, T.StringType())])
    # Unfolded, so that the test below and later filters read the parsed message, not the text again.
    message = F.from_json(text, layout, {"columnNameOfCorruptRecord": _CORRUPT})
    parsed = unfold(rows, rows.columns, F.array(message), "message")
    return parsed.withColumn(
        "is_bad", F.col(f"message.{_CORRUPT}").isNotNull() | _has_bad_number(F.col("message"))
    )


def _no_number(text: Column, kind: str) -> Column:
    return text.isNotNull() & text.try_cast(kind).isNull()


def _any(array: Column, test) -> Column:
    return F.coalesce(F.exists(array, lambda x: F.coalesce(test(x), F.lit(False))), F.lit(False))


def _bad_value(value: Column) -> Column:
    return _no_number(value["intValue"], "bigint") | _no_number(value["doubleValue"], "double")


def _bad_attributes(attributes: Column) -> Column:
    return _any(attributes, lambda a: F.coalesce(_bad_value(a["value"]), F.lit(False)))


def _has_bad_number(message: Column) -> Column:
    """Whether any number that the decoders read from a message is none, or out of its range."""

    def bad_point(p: Column) -> Column:
        whole = [_no_number(p[name], "bigint") for name in ("timeUnixNano", "asInt", "count")]
        real = [_no_number(p[name], "double") for name in ("asDouble", "sum")]
        return any_of([*whole, *real, _bad_attributes(p["attributes"])])

    def bad_record(r: Column) -> Column:
        times = [_no_number(r[name], "bigint") for name in ("timeUnixNano", "observedTimeUnixNano")]
        return any_of([*times, F.coalesce(_bad_value(r["body"]), F.lit(False)), _bad_attributes(r["attributes"])])

    def bad_resource(r: Column) -> Column:
        return _bad_attributes(r["resource"]["attributes"])

    metrics = _any(
        message["resourceMetrics"],
        lambda r: bad_resource(r)
        | _any(r["scopeMetrics"], lambda s: _any(s["metrics"], lambda m: _any(_points(m), bad_point))),
    )
    logs = _any(
        message["resourceLogs"],
        lambda r: bad_resource(r) | _any(r["scopeLogs"], lambda s: _any(s["logRecords"], bad_record)),
    )
    return metrics | logs


def split_bad(parsed: DataFrame, value: str = "value") -> tuple[DataFrame, DataFrame]:
    """Good messages and the raw text of the bad ones."""
    good = parsed.filter(~F.col("is_bad")).drop("is_bad")
    bad = parsed.filter(F.col("is_bad")).select(value)
    return good, bad


def _number(point: Column) -> Column:
    return F.coalesce(strict(point["asDouble"], "double", "asDouble"), strict(point["asInt"], "bigint", "asInt").cast("double"))


def _sum_or_zero(point: Column) -> Column:
    return F.coalesce(strict(point["sum"], "double", "sum"), F.lit(0.0))


def _kind(metric: Column) -> Column:
    """Which data alternative a metric carries; NULL when none."""
    choice = F.when(metric[schemas.METRIC_KINDS[0]].isNotNull(), schemas.METRIC_KINDS[0])
    for name in schemas.METRIC_KINDS[1:]:
        choice = choice.when(metric[name].isNotNull(), name)
    return choice


def _points(metric: Column) -> Column:
    return F.coalesce(*[metric[kind]["dataPoints"] for kind in schemas.METRIC_KINDS])


def _nanos(text: Column) -> Column:
    return F.coalesce(strict(text, "bigint", "time"), F.lit(0).cast("bigint"))


def _explode_resources(messages: DataFrame, root: str, carry: tuple[str, ...]) -> DataFrame:
    return unfold(messages, list(carry), F.col(f"message.{root}"), "r")


def _explode_metrics(resources: DataFrame, carry: list[str]) -> DataFrame:
    scopes = resources.select(*carry, F.explode("r.scopeMetrics").alias("s"))
    return scopes.select(*carry, F.explode("s.metrics").alias("m"))


def _explode_points(metrics: DataFrame, carry: list[str]) -> DataFrame:
    m = F.col("m")
    return metrics.select(
        *carry,
        F.coalesce(m["name"], F.lit("")).alias("__name__"),
        _kind(m).alias("kind"),
        F.explode(_points(m)).alias("p"),
    )


# Resource keys promoted to lake columns.
LAKE_KEYS = {
    "service_name": "service.name",
    "service_namespace": "service.namespace",
    "k8s_namespace_name": "k8s.namespace.name",
    "cluster_name": "cluster.name",
}
_LAKE_COLUMNS = [*LAKE_KEYS, "host", "env", "resource_attributes"]


def _listed(resources: DataFrame) -> DataFrame:
    """Resource attributes as text pairs, and the same newest first: the last duplicate counts."""
    pairs = kv_texts(F.col("r.resource.attributes"))
    return resources.withColumn("resource_attributes", pairs).withColumn(
        "_newest", F.reverse("resource_attributes")
    )


def _promote_metric_resource(resources: DataFrame) -> DataFrame:
    """Promoted columns of a metric resource; '' falls through to the second key."""
    newest = F.col("_newest")

    def filled(key: str) -> Column:
        return F.nullif(first_match(newest, key), F.lit(""))

    return _listed(resources).withColumns(
        {
            **{c: first_match(newest, key) for c, key in LAKE_KEYS.items()},
            "host": F.coalesce(filled("host.name"), filled("host")),
            "env": F.coalesce(filled("env"), filled("deployment.environment")),
        }
    )


def _promote_log_resource(resources: DataFrame) -> DataFrame:
    """The same for logs, where the typed value decides: 0, false and '' fall through, and the
    second alternative stays as it is even when empty."""
    typed, newest = F.reverse("r.resource.attributes"), F.col("_newest")

    def either(first: str, second: str) -> Column:
        is_set = F.coalesce(any_truthy(first_match(typed, first)), F.lit(False))
        return F.when(is_set, first_match(newest, first)).otherwise(first_match(newest, second))

    return _listed(resources).withColumns(
        {
            **{c: first_match(newest, key) for c, key in LAKE_KEYS.items()},
            "host": either("host.name", "host"),
            "env": either("env", "deployment.environment"),
        }
    )


def flatten_metrics(
    messages: DataFrame, include: list[dict] | None = None, carry: tuple[str, ...] = ()
) -> DataFrame:
    """One lake row per data point of parsed messages.

    ``include`` are the rules of :func:`tidegauge.operators.filters.include_metrics`. Their names
    are already checked before the data points are unfolded.
    """
    resources = _promote_metric_resource(_explode_resources(messages, "resourceMetrics", carry))
    promoted = [*carry, *_LAKE_COLUMNS]
    metrics = _explode_metrics(resources, promoted)
    if include:
        names = sorted({rule["name"] for rule in include})
        metrics = metrics.filter(F.coalesce(F.col("m.name"), F.lit("")).isin(names))
    points = _explode_points(metrics, promoted)
    p = F.col("p")
    value = (
        F.when(F.col("kind").isin("gauge", "sum"), _number(p))
        .when(F.col("kind").isin("histogram", "summary"), _sum_or_zero(p))
        .otherwise(F.lit(None).cast("double"))
    )
    rows = points.select(
        *carry,
        from_nanos(_nanos(p["timeUnixNano"])).alias("timestamp"),
        "__name__",
        value.alias("value"),
        "service_name",
        "service_namespace",
        "k8s_namespace_name",
        "cluster_name",
        "host",
        "env",
        "resource_attributes",
        kv_texts(p["attributes"]).alias("attributes"),
    )
    return rows.filter(include_predicate(include)) if include else rows


def flatten_logs(messages: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """One lake row per log record of parsed messages."""
    resources = _promote_log_resource(_explode_resources(messages, "resourceLogs", carry))
    promoted = [*carry, *_LAKE_COLUMNS]
    scopes = resources.select(*promoted, F.explode("r.scopeLogs").alias("s"))
    records = scopes.select(*promoted, F.explode("s.logRecords").alias("p"))
    p = F.col("p")
    sent = F.nullif(_nanos(p["timeUnixNano"]), F.lit(0).cast("bigint"))
    return records.select(
        *carry,
        from_nanos(F.coalesce(sent, _nanos(p["observedTimeUnixNano"]))).alias("timestamp"),
        any_text(p["body"]).alias("line"),
        "service_name",
        "service_namespace",
        "k8s_namespace_name",
        "cluster_name",
        "host",
        "env",
        "resource_attributes",
        kv_texts(p["attributes"]).alias("attributes"),
    )


# Resource keys the stream record promotes, by output column.
STREAM_KEYS = {
    "service_name": "service.name",
    "service_namespace": "service.namespace",
    "app": "app",
    "env": "env",
    "zone": "zone",
    "k8s_namespace_name": "k8s_namespace_name",
    "cluster_name": "cluster_name",
    "k8s_pod_name": "k8s_pod_name",
    "host": "host",
    "topic": "topic",
}


def flatten_stream_metrics(
    messages: DataFrame, rules: list[dict], carry: tuple[str, ...] = ()
) -> DataFrame:
    """One stream record per data point of the resources the allow rules let through.

    Stateless, so the same function serves batch and streaming frames. A gauge or sum point
    without a number stops the job.
    """
    resources = _explode_resources(messages, "resourceMetrics", carry).withColumn(
        "resource_attributes", kv_strings(F.col("r.resource.attributes"))
    )
    pairs = F.col("resource_attributes")
    resources = resources.filter(
        allow_predicate(
            rules, first_match(pairs, "service.namespace"), first_match(pairs, "service.name")
        )
    )
    resources = resources.withColumns({c: first_match(pairs, k) for c, k in STREAM_KEYS.items()})
    promoted = [*carry, *STREAM_KEYS, "resource_attributes"]
    points = _explode_points(_explode_metrics(resources, promoted), promoted)
    p = F.col("p")
    plain = F.col("kind").isin("gauge", "sum")
    missing = F.raise_error(F.lit("a gauge or sum point holds neither asDouble nor asInt"))
    value = F.when(plain, F.coalesce(_number(p), missing.cast("double"))).otherwise(_sum_or_zero(p))
    count = F.when(~plain, F.coalesce(strict(p["count"], "bigint", "count"), F.lit(0).cast("bigint")))
    return points.select(
        *carry,
        _nanos(p["timeUnixNano"]).alias("timestamp"),
        "__name__",
        value.alias("value"),
        count.alias("count"),
        *STREAM_KEYS,
        "resource_attributes",
        kv_strings(p["attributes"]).alias("attributes"),
    )


def serialize(message: Column) -> Column:
    """A nested OTLP value as JSON text; unset fields are left out."""
    return F.to_json(message)


def has_metrics(message: Column) -> Column:
    """True when some scope of the message holds a metric."""
    found = F.exists(
        message["resourceMetrics"],
        lambda rm: F.coalesce(
            F.exists(
                rm["scopeMetrics"], lambda sm: F.coalesce(F.size(sm["metrics"]), F.lit(0)) > 0
            ),
            F.lit(False),
        ),
    )
    return F.coalesce(found, F.lit(False))


def publishable(parsed: DataFrame) -> DataFrame:
    """Messages with a metric as JSON texts in ``value``; the others are skipped."""
    message = F.col("message")
    kept = F.when(has_metrics(message), F.array(serialize(message)))
    return unfold(parsed, [], kept, "value")
