"""Queries of the training aggregate, resampling, merging and range vectors."""

from __future__ import annotations

from functools import partial

from pyspark.sql import functions as F

from tidegauge.operators import aggregates, merge, ranges
from tidegauge.plans import tables
from tidegauge.plans.filtering import WIDE_CTE


def _flat(df):
    return df.select(
        F.col("timestamp").alias("bucket_ms"),
        F.col("__name__").alias("name"),
        F.col("attributes")["k"].alias("k"),
        F.col("resource_attributes")["user"].alias("user_id"),
        tables.shown("value", 6).alias("value"),
    )


def training_aggregate(spark, sf_dir):
    return _flat(aggregates.training_aggregate(tables.metric_rows(spark, sf_dir), tables.AS_OF))


def training_aggregate_literal(spark, sf_dir):
    rows = tables.metric_rows(spark, sf_dir)
    return _flat(aggregates.training_aggregate(rows, tables.AS_OF, bucket_minutes=None))


_TRAINING = """
SELECT {bucket} AS bucket_ms, event_type AS name, json_extract_string(props, '$.k') AS k,
       CAST(user_id AS VARCHAR) AS user_id, round(avg(value) + 1e-9, 6) AS value
FROM events WHERE ts > TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 7 DAY GROUP BY {key}, 2, 3, 4
"""
TRAINING_SQL = _TRAINING.format(bucket="(epoch_us(ts) // 300000000) * 300000", key="1")
TRAINING_LITERAL_SQL = _TRAINING.format(bucket="(epoch_us(ts) // 1000)", key="ts")

HOUR_MS = 3_600_000


def resample(spark, sf_dir, agg):
    """Hourly windows per event type."""
    rows = tables.series(spark, sf_dir)
    grid = merge.resample(rows, {"value": agg}, HOUR_MS, keys=("query_id",), tie=("event_id",))
    return grid.select("query_id", "timestamp", tables.shown("value", 6).alias("value"))


RESAMPLE_SQL = """
SELECT event_type AS query_id, ((epoch_us(ts) // 1000) // 3600000) * 3600000 AS timestamp, round({agg} + 1e-9, 6) AS value
FROM events GROUP BY 1, 2
"""
_SQL_AGGREGATES = {
    "mean": "avg(value)",
    "sum": "sum(value)",
    "min": "min(value)",
    "max": "max(value)",
    "first": "arg_min(value, ((epoch_us(ts) // 1000), event_id))",
    "last": "arg_max(value, ((epoch_us(ts) // 1000), event_id))",
}


def resample_damaged(spark, sf_dir):
    """All aggregates over values with NULL and NaN: an empty sum is 0, extremes skip NaN."""
    rows = tables.damaged(spark, sf_dir)
    copies = rows.select(
        "timestamp", "event_id", "event_type",
        *[F.col("value").alias(name) for name in ("mean", "sum", "min", "max")],
    )
    names = {name: name for name in ("mean", "sum", "min", "max")}
    grid = merge.resample(copies, names, HOUR_MS, keys=("event_type",))

    def shown(name):
        return F.when(~F.isnan(name), tables.shown(name, 6)).alias(f"value_{name}")

    return grid.select("event_type", "timestamp", *[shown(name) for name in names])


RESAMPLE_DAMAGED_SQL = """
WITH d AS (SELECT ((epoch_us(ts) // 1000) // 3600000) * 3600000 AS timestamp, event_type,
                  event_id % 17 <> 0 AND event_id % 23 = 0 AS is_nan,
                  CASE WHEN event_id % 17 <> 0 AND event_id % 23 <> 0 THEN value END AS value FROM events)
SELECT event_type, timestamp,
       CASE WHEN NOT bool_or(is_nan) THEN round(avg(value) + 1e-9, 6) END AS value_mean,
       CASE WHEN NOT bool_or(is_nan) THEN round(coalesce(sum(value), 0.0) + 1e-9, 6) END AS value_sum,
       round(min(value) + 1e-9, 6) AS value_min, round(max(value) + 1e-9, 6) AS value_max
FROM d GROUP BY 1, 2
"""

MIXED = {"view": "mean", "click": "sum", "error": "min", "purchase": "first", "signup": "last"}
QUARTER_MS = 900_000


def _mixed(df):
    return df.select("timestamp", *[tables.shown(c, 6).alias(c) for c in MIXED])


def _coarse(spark, sf_dir):
    """Series on whole seconds, so that some timestamps hold several points of one series."""
    rows = tables.series(spark, sf_dir)
    return rows.withColumn("timestamp", F.col("timestamp") - F.pmod("timestamp", F.lit(100_000)))


def merge_exact(spark, sf_dir):
    return _mixed(merge.merge_series(_coarse(spark, sf_dir), MIXED, QUARTER_MS, tie="event_id"))


_JOINS = "\n".join(
    f"LEFT JOIN (SELECT {{ts}} AS timestamp, value AS {c}, event_id AS id_{c} FROM events"
    f" WHERE event_type = '{c}') USING (timestamp)"
    for c in MIXED
)
MERGE_EXACT_SQL = (
    """
WITH timeline AS (SELECT DISTINCT {ts} AS timestamp FROM events),
joined AS (SELECT * FROM timeline """
    + _JOINS
    + """),
edges AS (SELECT *, (timestamp // 900000) * 900000 AS bucket,
            row_number() OVER (PARTITION BY timestamp // 900000 ORDER BY timestamp, id_purchase) AS r_first,
            row_number() OVER (PARTITION BY timestamp // 900000 ORDER BY timestamp DESC, id_signup DESC) AS r_last
          FROM joined)
SELECT bucket AS timestamp, round(avg(view) + 1e-9, 6) AS view, round(coalesce(sum(click), 0.0) + 1e-9, 6) AS click,
       round(min(error) + 1e-9, 6) AS error,
       round(max(CASE WHEN r_first = 1 THEN purchase END) + 1e-9, 6) AS purchase,
       round(max(CASE WHEN r_last = 1 THEN signup END) + 1e-9, 6) AS signup
FROM edges GROUP BY 1
"""
)
MERGE_COARSE_SQL = MERGE_EXACT_SQL.replace("{ts}", "((epoch_us(ts) // 1000) // 100000) * 100000")
MERGE_FINE_SQL = MERGE_EXACT_SQL.replace("{ts}", "(epoch_us(ts) // 1000)")


def merge_pivot(spark, sf_dir):
    return _mixed(merge.pivot_or_merge(tables.series(spark, sf_dir), MIXED, QUARTER_MS, tie="event_id"))


def timeline(spark, sf_dir):
    return merge.timeline(_coarse(spark, sf_dir))


TIMELINE_SQL = "SELECT DISTINCT ((epoch_us(ts) // 1000) // 100000) * 100000 AS timestamp FROM events"


def wide_frame(spark, sf_dir):
    return tables.wide(spark, sf_dir).select(
        "timestamp", *[tables.shown(c, 6).alias(c) for c in tables.WIDE]
    )


WIDE_FRAME_SQL = f"""
WITH {WIDE_CTE}
SELECT timestamp, {", ".join(f"round({c} + 1e-9, 6) AS {c}" for c in tables.WIDE)} FROM wide
"""


def _samples(spark, sf_dir):
    return tables.events(spark, sf_dir).select("user_id", "timestamp", "value", "event_id")


def avg_over_time(spark, sf_dir):
    """Six-hour means per user, every two hours, summed over users: the series of the wide frame."""
    means = ranges.avg_over_time(_samples(spark, sf_dir), ("user_id",), 6 * HOUR_MS, 2 * HOUR_MS)
    return means.select("user_id", "timestamp", tables.shown("value", 6).alias("value"))


_STEPS = """
steps AS (SELECT unnest(range(lo, hi + 21600000, 7200000)) AS timestamp
          FROM (SELECT (min((epoch_us(ts) // 1000)) // 7200000) * 7200000 AS lo, max((epoch_us(ts) // 1000)) AS hi FROM events)),
s AS (SELECT user_id, (epoch_us(ts) // 1000) AS t, value, event_id FROM events)
"""
AVG_OVER_TIME_SQL = f"""
WITH {_STEPS}
SELECT user_id, timestamp, round(avg(value) + 1e-9, 6) AS value
FROM s JOIN steps ON t > timestamp - 21600000 AND t <= timestamp GROUP BY 1, 2
"""


def sum_by_step(spark, sf_dir):
    means = ranges.avg_over_time(_samples(spark, sf_dir), ("user_id",), 6 * HOUR_MS, 2 * HOUR_MS)
    return ranges.sum_by_step(means).select("timestamp", tables.shown("value", 4).alias("value"))


SUM_BY_STEP_SQL = f"""
WITH {_STEPS}, m AS (
  SELECT user_id, timestamp, avg(value) AS value
  FROM s JOIN steps ON t > timestamp - 21600000 AND t <= timestamp GROUP BY 1, 2)
SELECT timestamp, round(sum(value) + 1e-7, 4) AS value FROM m GROUP BY 1
"""


def rate(spark, sf_dir):
    """Per-user counters (restarting whenever the value drops) over six hours, every two hours."""
    rates = ranges.rate(_samples(spark, sf_dir), ("user_id",), 6 * HOUR_MS, 2 * HOUR_MS)
    return rates.select("user_id", "timestamp", tables.shown("value", 9).alias("value"))


RATE_SQL = f"""
WITH {_STEPS}, pairs AS (
  SELECT user_id, t, value, lag(t) OVER w AS t0, lag(value) OVER w AS v0 FROM s
  WINDOW w AS (PARTITION BY user_id ORDER BY t, value))
SELECT user_id, timestamp,
       round(sum(CASE WHEN value >= v0 THEN value - v0 ELSE value END) / 21600.0 + 1e-12, 9) AS value
FROM pairs JOIN steps ON t0 > timestamp - 21600000 AND t <= timestamp GROUP BY 1, 2
"""


# A range that is no multiple of the step, and one of a thousand steps.
_ODD = 7 * HOUR_MS, 3 * HOUR_MS
_LONG = 100 * HOUR_MS, HOUR_MS // 10


def avg_over_odd_range(spark, sf_dir):
    """Seven-hour means per user, every three hours."""
    means = ranges.avg_over_time(_samples(spark, sf_dir), ("user_id",), *_ODD)
    return means.select("user_id", "timestamp", tables.shown("value", 6).alias("value"))


def _steps_sql(range_ms, step_ms):
    return f"""
steps AS (SELECT unnest(range(lo, hi + {range_ms}, {step_ms})) AS timestamp
          FROM (SELECT (min((epoch_us(ts) // 1000)) // {step_ms}) * {step_ms} AS lo, max((epoch_us(ts) // 1000)) AS hi FROM events)),
s AS (SELECT user_id, event_type, (epoch_us(ts) // 1000) AS t, value FROM events)"""


AVG_OVER_ODD_SQL = f"""
WITH {_steps_sql(*_ODD)}
SELECT user_id, timestamp, round(avg(value) + 1e-9, 6) AS value
FROM s JOIN steps ON t > timestamp - {_ODD[0]} AND t <= timestamp GROUP BY 1, 2
"""


def rate_long_range(spark, sf_dir):
    """The counters of the event types over a hundred hours, every six minutes."""
    samples = tables.events(spark, sf_dir).select("event_type", "timestamp", "value")
    rates = ranges.rate(samples, ("event_type",), *_LONG)
    return rates.select("event_type", "timestamp", tables.shown("value", 9).alias("value"))


RATE_LONG_SQL = f"""
WITH {_steps_sql(*_LONG)}, pairs AS (
  SELECT event_type, t, value, lag(t) OVER w AS t0, lag(value) OVER w AS v0 FROM s
  WINDOW w AS (PARTITION BY event_type ORDER BY t, value)),
ends AS (SELECT event_type, t, t0, CASE WHEN value >= v0 THEN value - v0 ELSE value END AS grown FROM pairs WHERE t0 IS NOT NULL)
SELECT event_type, timestamp, round(sum(grown) / {_LONG[0] / 1000} + 1e-12, 9) AS value
FROM ends JOIN steps ON t0 > timestamp - {_LONG[0]} AND t <= timestamp GROUP BY 1, 2
"""


def count_over_time(spark, sf_dir):
    counts = ranges.count_over_time(tables.lines(spark, sf_dir), ("service_name",), contains="on")
    return counts.select("service_name", "timestamp", "value")


COUNT_OVER_TIME_SQL = """
SELECT role AS service_name, ceil(((conv_id % 500) * 60 + turn * 10) / 60.0)::BIGINT * 60000 + 1704067200000 AS timestamp,
       count(*) AS value
FROM conversations WHERE contains(text, 'on') GROUP BY 1, 2
"""


def select_labels(spark, sf_dir):
    rows = tables.metric_rows(spark, sf_dir).withColumn("attributes", F.map_from_entries("attributes"))
    return ranges.select_labels(rows, {"kind": "error", "k": "42"}).select("event_id", "value")


SELECT_LABELS_SQL = """
SELECT event_id, value FROM events WHERE event_type = 'error' AND json_extract_string(props, '$.k') = '42'
"""


def step_alignment(spark, sf_dir):
    return ranges.align_to_step(_samples(spark, sf_dir), 1000).select("event_id", "timestamp")


STEP_ALIGNMENT_SQL = "SELECT event_id, ((epoch_us(ts) // 1000) // 1000) * 1000 AS timestamp FROM events"


QUERIES = {
    "training_aggregate": (training_aggregate, TRAINING_SQL),
    "training_aggregate_literal": (training_aggregate_literal, TRAINING_LITERAL_SQL),
    **{
        f"resample_{agg}": (partial(resample, agg=agg), RESAMPLE_SQL.format(agg=sql))
        for agg, sql in _SQL_AGGREGATES.items()
    },
    "resample_damaged": (resample_damaged, RESAMPLE_DAMAGED_SQL),
    "merge_exact": (merge_exact, MERGE_COARSE_SQL),
    "merge_pivot": (merge_pivot, MERGE_FINE_SQL),
    "timeline": (timeline, TIMELINE_SQL),
    "wide_frame": (wide_frame, WIDE_FRAME_SQL),
    "avg_over_time": (avg_over_time, AVG_OVER_TIME_SQL),
    "sum_by_step": (sum_by_step, SUM_BY_STEP_SQL),
    "rate": (rate, RATE_SQL),
    "rate_long_range": (rate_long_range, RATE_LONG_SQL),
    "avg_over_odd_range": (avg_over_odd_range, AVG_OVER_ODD_SQL),
    "count_over_time": (count_over_time, COUNT_OVER_TIME_SQL),
    "select_labels": (select_labels, SELECT_LABELS_SQL),
    "step_alignment": (step_alignment, STEP_ALIGNMENT_SQL),
}
