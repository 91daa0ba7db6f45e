"""Answers of the dashboard backend: column arrays per refId and frame."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge import schemas
from tidegauge.functions.numbers import unfold

_MS_TO_NS = 1_000_000
_NO_FRAMES = (
    "array<struct<schema:struct<name:string,fields:array<struct<name:string,type:string,"
    "labels:map<string,string>>>>,data:struct<values:array<array<string>>>>>"
)


def parse_responses(df: DataFrame, value: str = "value") -> DataFrame:
    """Parse JSON answers into ``results``: refId to frames. Missing parts stay empty."""
    parsed = F.from_json(value, schemas.RESPONSE)["results"]
    return df.withColumn("results", F.coalesce(parsed, F.create_map().cast(_results_type())))


def _results_type() -> str:
    return f"map<string,struct<frames:{_NO_FRAMES}>>"


def frames_of(results: Column, ref_id: str = "A") -> Column:
    """Frames of one refId; empty when it is absent."""
    return F.coalesce(
        F.try_element_at(results, F.lit(ref_id))["frames"], F.array().cast(_NO_FRAMES)
    )


def _columns(frame: Column) -> Column:
    """Column arrays of a frame as numbers, quoted or not; what is no number counts as NULL."""
    return F.transform(frame["data"]["values"], lambda c: F.transform(c, lambda v: v.try_cast("double")))


def values_of(results: Column, ref_id: str = "A") -> Column:
    """Raw column arrays of the first frame; empty when there is none."""
    first = F.get(frames_of(results, ref_id), F.lit(0))
    return F.coalesce(_columns(first), F.array().cast("array<array<double>>"))


def to_series(
    responses: DataFrame, query_id: Column, ref_id: str = "A", on_error: str = "drop"
) -> DataFrame:
    """Long ``(query_id, timestamp, value)`` rows of the first frame of each answer.

    A frame needs exactly two columns of one length, without NULL; an answer that breaks this is
    dropped whole, or stops the job with ``on_error='raise'``. No frames means no rows.
    """
    if on_error not in ("drop", "raise"):
        raise ValueError(f"on_error must be 'drop' or 'raise', not '{on_error}'")
    frame = responses.select(
        query_id.alias("query_id"), values_of(F.col("results"), ref_id).alias("columns"),
        F.size(frames_of(F.col("results"), ref_id)).alias("n_frames"),
    )
    columns = F.col("columns")
    times, points = F.get(columns, F.lit(0)), F.get(columns, F.lit(1))
    two_columns = F.size(columns) == 2
    valid = F.coalesce(
        two_columns
        & (F.size(times) == F.size(points))
        & ~F.exists(times, lambda t: t.isNull())
        & ~F.exists(points, lambda v: v.isNull()),
        F.lit(False),
    )
    pairs = F.when(valid, F.arrays_zip(times.alias("t"), points.alias("v")))
    if on_error == "raise":
        reason = F.when(~two_columns, F.lit("a frame needs one column of times and one of values")).otherwise(
            F.lit("the two columns must be equally long and without NULL")
        )
        message = F.concat(F.lit("Query '"), F.col("query_id"), F.lit("': "), reason)
        pairs = pairs.when(
            F.col("n_frames") > 0, F.raise_error(message).cast("array<struct<t:double,v:double>>")
        )
    return unfold(frame, ["query_id"], pairs, "p").select(
        "query_id", F.col("p.t").cast("bigint").alias("timestamp"), F.col("p.v").alias("value")
    )


def _usable(frame: Column) -> Column:
    values = _columns(frame)
    return F.coalesce((F.size(values) == 2) & (F.size(F.get(values, F.lit(0))) > 0), F.lit(False))


def _labels(frame: Column) -> Column:
    """Labels of the value column as (key, value) pairs."""
    labels = F.get(frame["schema"]["fields"], F.lit(1))["labels"]
    return F.coalesce(
        F.map_entries(labels), F.array().cast("array<struct<key:string,value:string>>")
    )


def to_gauge_points(responses: DataFrame, name: str | None = None, carry: tuple[str, ...] = ()) -> DataFrame:
    """Flat gauge points of all frames: ref_id, metric name, nanoseconds, value, attributes."""
    refs = unfold(responses, list(carry), F.map_entries("results"), "ref")
    frames = refs.select(
        *carry, F.col("ref.key").alias("ref_id"), F.explode("ref.value.frames").alias("frame")
    ).filter(_usable(F.col("frame")))
    values = _columns(F.col("frame"))
    zipped = F.arrays_zip(
        F.get(values, F.lit(0)).alias("t"), F.get(values, F.lit(1)).alias("v")
    )
    points = frames.select(
        *carry,
        "ref_id",
        F.coalesce(F.lit(name), F.col("ref_id")).alias("__name__"),
        _labels(F.col("frame")).alias("attributes"),
        F.explode(zipped).alias("p"),
    )
    # The shorter column is padded with NULL, so this also ends the pairs where it ends.
    kept = points.filter(F.col("p.t").isNotNull() & F.col("p.v").isNotNull())
    return kept.select(
        *carry,
        "ref_id",
        "__name__",
        (F.col("p.t").cast("bigint") * F.lit(_MS_TO_NS)).alias("time_unix_nano"),
        F.col("p.v").alias("value"),
        "attributes",
    )


def _attribute(key: Column, text: Column) -> Column:
    return F.struct(key.alias("key"), F.struct(text.alias("stringValue")).alias("value"))


def _gauge_points(frames: Column) -> Column:
    def points(frame: Column) -> Column:
        values = _columns(frame)
        attributes = F.transform(_labels(frame), lambda kv: _attribute(kv["key"], kv["value"]))
        pairs = F.filter(
            F.arrays_zip(F.get(values, F.lit(0)).alias("t"), F.get(values, F.lit(1)).alias("v")),
            lambda p: p["t"].isNotNull() & p["v"].isNotNull(),
        )
        return F.transform(
            pairs,
            lambda p: F.struct(
                (p["t"].cast("bigint") * F.lit(_MS_TO_NS)).cast("string").alias("timeUnixNano"),
                p["v"].alias("asDouble"),
                attributes.alias("attributes"),
            ),
        )

    return F.flatten(F.transform(F.filter(frames, _usable), points))


def to_otlp(
    responses: DataFrame,
    name: str | None = None,
    resource_attributes: dict[str, str] | None = None,
) -> DataFrame:
    """Add ``message``: each answer as one nested OTLP metrics message of gauges.

    Built inside the row with array functions, so nothing is shuffled or collected. refIds
    without points are left out.
    """
    attributes = [_attribute(F.lit(k), F.lit(v)) for k, v in (resource_attributes or {}).items()]
    resource = F.struct(
        (
            F.array(*attributes)
            if attributes
            else F.array().cast("array<struct<key:string,value:struct<stringValue:string>>>")
        ).alias("attributes")
    )
    metrics = F.transform(
        F.map_entries("results"),
        lambda entry: F.struct(
            F.coalesce(F.lit(name), entry["key"]).alias("name"),
            F.struct(
                _gauge_points(
                    F.coalesce(entry["value"]["frames"], F.array().cast(_NO_FRAMES))
                ).alias("dataPoints")
            ).alias("gauge"),
        ),
    )
    filled = F.filter(metrics, lambda m: F.size(m["gauge"]["dataPoints"]) > 0)
    scope = F.struct(F.struct(F.lit("grafana").alias("name")).alias("scope"), filled.alias("metrics"))
    message = F.struct(
        F.array(
            F.struct(resource.alias("resource"), F.array(scope).alias("scopeMetrics"))
        ).alias("resourceMetrics")
    )
    return responses.withColumn("message", message)
