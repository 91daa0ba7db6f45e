from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from tidegauge.operators import decode, responses


def frame(values, labels=None, fields=None):
    if fields is None:
        fields = [{"name": "time"}, {"name": "v", **({"labels": labels} if labels is not None else {})}]
    return {"schema": {"fields": fields}, "data": {"values": values}}


def answer(**refs):
    return json.dumps({"results": {ref: {"frames": frames} for ref, frames in refs.items()}})


def parsed(spark, *texts):
    return responses.parse_responses(spark.createDataFrame([(t,) for t in texts], "value string"))


def points(spark, text, **options):
    rows = responses.to_gauge_points(parsed(spark, text), **options).collect()
    return [(r["__name__"], r["time_unix_nano"], r["value"], [(p.key, p.value) for p in r["attributes"]]) for r in rows]


T0 = 1_640_995_200_000


def test_one_series(spark):
    text = answer(A=[frame([[T0 + 5 * k for k in range(4)], [k / 8 for k in range(4)]])])
    assert points(spark, text) == [("A", (T0 + 5 * k) * 10**6, k / 8, []) for k in range(4)]
    series = responses.to_series(parsed(spark, text), F.lit("level")).collect()
    assert [tuple(r) for r in series] == [("level", T0 + 5 * k, k / 8) for k in range(4)]


def test_numbers_may_be_quoted(spark):
    text = answer(A=[frame([[str(T0), T0 + 1, "x"], ["1.5", 2, 3]])])
    assert [p[1:3] for p in points(spark, text)] == [(T0 * 10**6, 1.5), ((T0 + 1) * 10**6, 2.0)]
    quoted = answer(A=[frame([[T0], ["-2e-3"]])])
    assert [r["value"] for r in responses.to_series(parsed(spark, quoted), F.lit("q")).collect()] == [-0.002]


def test_names_and_labels(spark):
    text = answer(tide=[frame([[T0], [3.25]])], wind=[frame([[T0], [11.0]])])
    assert sorted(p[0] for p in points(spark, text)) == ["tide", "wind"]
    frames = [frame([[T0], [float(k)]], {"gauge": f"g{k}"}) for k in range(3)]
    got = points(spark, answer(A=frames), name="level")
    assert [(n, v, a) for n, _, v, a in got] == [("level", float(k), [("gauge", f"g{k}")]) for k in range(3)]


@pytest.mark.parametrize(
    "text",
    [
        "{}",
        '{"results": {}}',
        answer(A=[]),
        answer(A=[frame([])]),
        answer(A=[frame([[T0]])]),
        answer(A=[frame([[], []])]),
        answer(A=[frame([[T0], [None]])]),
        answer(A=[{}]),
    ],
)
def test_nothing_to_convert(spark, text):
    assert points(spark, text) == []
    message = json.loads(
        responses.to_otlp(parsed(spark, text)).select(decode.serialize(F.col("message"))).first()[0]
    )
    assert message["resourceMetrics"][0]["scopeMetrics"][0]["metrics"] == []


def test_pairs_stop_at_the_shorter_column(spark):
    text = answer(A=[frame([[T0, T0 + 1, T0 + 2], [1.0, None]])])
    assert [p[2] for p in points(spark, text)] == [1.0]


def test_message_nesting(spark):
    text = answer(A=[frame([[T0], [42.0]], {"job": "api"}), frame([[T0, T0 + 1], [1.0, 2.0]])], B=[])
    nested = responses.to_otlp(parsed(spark, text), resource_attributes={"service.name": "agent"})
    out = json.loads(nested.select(decode.serialize(F.col("message"))).first()[0])
    resource = out["resourceMetrics"][0]
    assert resource["resource"]["attributes"] == [{"key": "service.name", "value": {"stringValue": "agent"}}]
    scope = resource["scopeMetrics"][0]
    assert scope["scope"] == {"name": "grafana"} and len(scope["metrics"]) == 1
    dps = scope["metrics"][0]["gauge"]["dataPoints"]
    assert [p["asDouble"] for p in dps] == [42.0, 1.0, 2.0]
    assert dps[0]["timeUnixNano"] == str(T0 * 10**6)
    assert dps[0]["attributes"] == [{"key": "job", "value": {"stringValue": "api"}}]


@pytest.mark.parametrize(
    "text, valid",
    [
        (answer(A=[frame([[T0], [1.0]]), frame([[T0], [9.0]])]), 1),
        (answer(A=[]), 0),
        (answer(B=[frame([[T0], [1.0]])]), 0),
        ("{}", 0),
    ],
)
def test_first_frame_of_the_asked_ref(spark, text, valid):
    for mode in ("drop", "raise"):
        assert responses.to_series(parsed(spark, text), F.lit("q"), on_error=mode).count() == valid


@pytest.mark.parametrize(
    "values", [[[T0]], [[T0], [1.0], [2.0]], [[T0, T0], [1.0]], [[T0], [None]], [[None], [1.0]], []]
)
def test_broken_answers(spark, values):
    df = parsed(spark, answer(A=[frame(values)]))
    assert responses.to_series(df, F.lit("q")).count() == 0
    with pytest.raises(Exception, match="Query 'q'"):
        responses.to_series(df, F.lit("q"), on_error="raise").collect()


def test_accessors(spark):
    df = parsed(spark, answer(A=[frame([[1.0], [2.0]]), frame([[3.0], [4.0]])]))
    row = df.select(
        F.size(responses.frames_of(F.col("results"))).alias("n"),
        responses.values_of(F.col("results")).alias("v"),
        responses.values_of(F.col("results"), "Z").alias("z"),
    ).first()
    assert (row["n"], row["v"], row["z"]) == (2, [[1.0], [2.0]], [])
