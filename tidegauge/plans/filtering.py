"""Queries of filters, cleaning, gates and day ranges."""

from __future__ import annotations

import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidegauge.functions.anyvalue import kv_matches
from tidegauge.operators import aggregates, clean, filters, ordering
from tidegauge.plans import tables
from tidegauge.session import checkpoint_root
from tidegauge.sources import chunks

INCLUDE = [
    {"name": "click", "attributes": {"k": "^1"}},
    {"name": "view", "resource_attributes": {"user": "5$"}, "attributes": {"k": "7|8", "kind": "ie"}},
    {"name": "absent"},
]


def metric_include_filter(spark, sf_dir):
    rows = filters.include_metrics(tables.metric_rows(spark, sf_dir), INCLUDE)
    return rows.select("event_id", F.col("__name__").alias("name"), "value")


METRIC_INCLUDE_SQL = """
WITH e AS (SELECT *, json_extract_string(props, '$.k') AS k FROM events)
SELECT event_id, event_type AS name, value FROM e
WHERE (event_type = 'click' AND regexp_matches(k, '^1'))
   OR (event_type = 'view' AND regexp_matches(CAST(user_id AS VARCHAR), '5$') AND regexp_matches(k, '7|8'))
"""


def kv_match(spark, sf_dir):
    both = kv_matches(F.col("attributes"), {"k": "4", "kind": "^(error|signup)$"})
    missing = kv_matches(F.col("attributes"), {"nothing": "."})
    return tables.metric_rows(spark, sf_dir).select(
        "event_id",
        both.alias("both"),
        missing.alias("missing_key"),
        kv_matches(F.col("attributes"), {}).alias("no_pattern"),
    )


KV_MATCH_SQL = """
SELECT event_id,
       contains(json_extract_string(props, '$.k'), '4') AND event_type IN ('error', 'signup') AS "both",
       false AS missing_key, true AS no_pattern
FROM events
"""

RULES = [
    {"service.namespace": "ns-1"},
    {"service.namespace": "ns-2", "service.name": "svc-2"},
    {"service.namespace": "ns-2", "service.name": "svc-3"},
]

ALLOW_SQL = """
SELECT event_id, 'svc-' || (user_id % 7) AS service_name, 'ns-' || (user_id % 5) AS service_namespace
FROM events WHERE user_id % 5 = 1 OR (user_id % 5 = 2 AND user_id % 7 = 2)
"""


def allow_rules(spark, sf_dir):
    rows = tables.metric_rows(spark, sf_dir)
    allowed = filters.allow_predicate(RULES, F.col("service_namespace"), F.col("service_name"))
    return rows.filter(allowed).select("event_id", "service_name", "service_namespace")


def allow_rules_join(spark, sf_dir):
    """Rules taken from a table: every nation allows its namespace, in key order."""
    nation = tables.table(spark, sf_dir, "nation")
    rules = nation.select(
        F.concat(F.lit("ns-"), (F.col("n_regionkey") % 5).cast("string")).alias("service_namespace"),
        F.when(
            F.col("n_nationkey") % 3 != 0,
            F.concat(F.lit("svc-"), (F.col("n_nationkey") % 7).cast("string")),
        ).alias("service_name"),
        F.col("n_nationkey").alias("rule_order"),
    )
    rows = tables.metric_rows(spark, sf_dir)
    return filters.allow_join(rows, rules).select("event_id", "service_name", "service_namespace")


ALLOW_JOIN_SQL = """
WITH rules AS (
  SELECT 'ns-' || (n_regionkey % 5) AS ns,
         CASE WHEN n_nationkey % 3 <> 0 THEN 'svc-' || (n_nationkey % 7) END AS svc,
         row_number() OVER (PARTITION BY n_regionkey % 5 ORDER BY n_nationkey) AS rn
  FROM nation),
e AS (SELECT event_id, 'svc-' || (user_id % 7) AS service_name,
             CASE WHEN user_id % 5 <> 0 THEN 'ns-' || (user_id % 5) END AS service_namespace FROM events)
SELECT event_id, service_name, service_namespace
FROM e JOIN rules ON ns = service_namespace AND rn = 1
WHERE svc IS NULL OR svc = service_name
"""

LOG_RULES = [
    {"service_name": "user", "level": "info"},
    {"service_name": "assistant", "contains": "on"},
]


def log_include_filter(spark, sf_dir):
    rows = filters.include_logs(tables.lines(spark, sf_dir), LOG_RULES)
    return rows.select("conv_id", "turn", "service_name")


LOG_INCLUDE_SQL = """
SELECT conv_id, turn, role AS service_name FROM conversations
WHERE (role = 'user' AND turn % 2 = 0) OR (role = 'assistant' AND contains(text, 'on'))
"""

_DAMAGED = """
d AS (SELECT event_id, (epoch_us(ts) // 1000) AS timestamp, event_type,
             CASE WHEN event_id % 17 = 0 THEN NULL WHEN event_id % 23 = 0 THEN 'nan'::DOUBLE
                  ELSE value END AS value FROM events)
"""


def _without_nan(df):
    return df.select(
        "event_id", F.when(~F.isnan("value"), F.col("value")).alias("value"),
        F.isnan("value").alias("is_nan"),
    )


def clean_series(spark, sf_dir):
    damaged = tables.damaged(spark, sf_dir)
    shifted = damaged.withColumn(
        "timestamp", F.when(F.col("event_id") % 13 == 0, F.lit(0)).otherwise(F.col("timestamp"))
    )
    return clean.clean_series(shifted).select("event_id", "timestamp", "value")


CLEAN_SERIES_SQL = f"""
WITH {_DAMAGED}
SELECT event_id, timestamp, value FROM d WHERE value IS NOT NULL AND NOT isnan(value) AND event_id % 13 <> 0
"""


def drop_nan_rows(spark, sf_dir):
    return _without_nan(clean.drop_nan_rows(tables.damaged(spark, sf_dir)))


DROP_NAN_SQL = f"""
WITH {_DAMAGED}
SELECT event_id, value, coalesce(isnan(value), false) AS is_nan FROM d WHERE value IS NULL OR NOT isnan(value)
"""


def drop_null_rows(spark, sf_dir):
    return _without_nan(clean.drop_null_rows(tables.damaged(spark, sf_dir), "value"))


DROP_NULL_SQL = f"""
WITH {_DAMAGED}
SELECT event_id, CASE WHEN NOT isnan(value) THEN value END AS value, isnan(value) AS is_nan
FROM d WHERE value IS NOT NULL
"""


def fill_nulls(spark, sf_dir):
    return _without_nan(clean.fill_nulls(tables.damaged(spark, sf_dir), "value"))


FILL_NULLS_SQL = f"""
WITH {_DAMAGED}
SELECT event_id, CASE WHEN value IS NULL THEN 0.0 WHEN NOT isnan(value) THEN value END AS value,
       coalesce(isnan(value), false) AS is_nan FROM d
"""


def _wide_damaged(spark, sf_dir):
    eid, value = F.col("event_id"), F.col("value")
    return tables.events(spark, sf_dir).select(
        "event_id",
        F.when(eid % 29 == 0, F.lit(float("nan"))).otherwise(value).alias("cpu"),
        F.when(eid % 17 == 0, F.lit(None)).otherwise(value).alias("queue"),
        F.when(eid % 3 == 0, F.lit(None)).otherwise(value).alias("lines"),
    )


def clean_frame(spark, sf_dir):
    return clean.clean_frame(_wide_damaged(spark, sf_dir), critical="queue", zero_filled="lines")


CLEAN_FRAME_SQL = """
SELECT event_id, value AS cpu, value AS queue, CASE WHEN event_id % 3 = 0 THEN 0.0 ELSE value END AS lines
FROM events WHERE event_id % 29 <> 0 AND event_id % 17 <> 0
"""


def quality_gate(spark, sf_dir):
    """Flags of the raw frame, of the cleaned frame and of an empty one."""
    raw = _wide_damaged(spark, sf_dir)
    cleaned = clean.clean_frame(raw, critical="queue", zero_filled="lines")
    frames = {"raw": raw, "clean": cleaned, "empty": raw.filter("event_id < 0")}
    parts = [clean.quality_flags(df).withColumn("frame", F.lit(name)) for name, df in frames.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


QUALITY_GATE_SQL = """
WITH w AS (SELECT bool_or(event_id % 17 = 0 OR event_id % 3 = 0) AS n, bool_or(event_id % 29 = 0) AS nan FROM events)
SELECT 'raw' AS frame, n AS has_null, nan AS has_nan FROM w
UNION ALL SELECT 'clean', false, false UNION ALL SELECT 'empty', false, false
"""


def recent_window(spark, sf_dir):
    rows = filters.recent_window(tables.metric_rows(spark, sf_dir), 7, tables.AS_OF)
    return rows.select("event_id", F.unix_millis("timestamp").alias("ts_ms"))


RECENT_WINDOW_SQL = """
SELECT event_id, (epoch_us(ts) // 1000) AS ts_ms FROM events WHERE ts > TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 7 DAY
"""


def day_range(spark, sf_dir):
    rows = filters.previous_day(tables.metric_rows(spark, sf_dir), tables.AS_OF, offset_days=3)
    return rows.select("event_id", F.unix_millis("timestamp").alias("ts_ms"))


DAY_RANGE_SQL = """
SELECT event_id, (epoch_us(ts) // 1000) AS ts_ms FROM events
WHERE ts BETWEEN TIMESTAMP '2024-01-27 00:00:00' AND TIMESTAMP '2024-01-27 23:59:59'
"""


def _written_chunks(spark, sf_dir):
    """The wide frame as daily chunks in a folder of this run, cleaned so that the gate lets it through."""
    root = f"{checkpoint_root(spark)}/tidegauge/chunks-{uuid.uuid4().hex}"
    rows = tables.wide(spark, sf_dir)
    for c in tables.WIDE:
        rows = clean.fill_nulls(rows, c)
    chunks.write_chunks(rows, root)
    return root


def day_chunks(spark, sf_dir):
    """The wide frame written as daily chunks, the last three days read back."""
    recent = chunks.read_recent_chunks(spark, _written_chunks(spark, sf_dir), 3, tables.AS_OF)
    return recent.select("timestamp", *[tables.shown(c, 6).alias(c) for c in tables.WIDE])


def day_chunk(spark, sf_dir):
    """One chunk by its key."""
    day = chunks.read_chunk(spark, _written_chunks(spark, sf_dir), "20240115")
    return day.select("timestamp", *[tables.shown(c, 6).alias(c) for c in tables.WIDE])


def chunk_rows(spark, sf_dir):
    """Rows per chunk key."""
    return chunks.with_chunk_date(tables.wide(spark, sf_dir)).groupBy("chunk_date").agg(
        F.count(F.lit(1)).alias("n_rows")
    )


def wide_cte(events: str = "events") -> str:
    """The wide frame in SQL, with the repetition of rows that joins by timestamp bring."""
    stamps = "(epoch_us(ts) // 1000) AS timestamp"
    names = list(tables.WIDE)
    listed = ", ".join(f"'{c}'" for c in names)
    joins = "\n".join(
        f"  LEFT JOIN (SELECT {stamps}, value FROM {events} WHERE event_type = '{c}') AS t_{c} USING (timestamp)" for c in names
    )
    return f"""
timeline AS (SELECT DISTINCT {stamps} FROM {events} WHERE event_type IN ({listed})),
joined AS (
  SELECT t.timestamp, {", ".join(f"t_{c}.value AS {c}" for c in names)}
  FROM timeline t
{joins}),
wide AS (
  SELECT (timestamp // 60000) * 60000 AS timestamp, {", ".join(f"avg({c}) AS {c}" for c in names)}
  FROM joined GROUP BY 1)
"""


WIDE_CTE = wide_cte()

_FILLED = "timestamp, " + ", ".join(f"round(coalesce({c}, 0) + 1e-9, 6) AS {c}" for c in tables.WIDE)

DAY_CHUNKS_SQL = f"""
WITH {WIDE_CTE} SELECT {_FILLED} FROM wide
WHERE timestamp >= epoch_ms(TIMESTAMP '2024-01-29 00:00:00')
"""

DAY_CHUNK_SQL = f"""
WITH {WIDE_CTE} SELECT {_FILLED} FROM wide
WHERE timestamp >= epoch_ms(TIMESTAMP '2024-01-15 00:00:00') AND timestamp < epoch_ms(TIMESTAMP '2024-01-16 00:00:00')
"""

def chunk_order(spark, sf_dir):
    """Rows per chunk, and rows that stand before an earlier one in their file: none."""
    stored = spark.read.parquet(_written_chunks(spark, sf_dir)).select(
        F.col(chunks.CHUNK).cast("string").alias("chunk_date"),
        "timestamp",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.row_index").alias("place"),
    )
    before = F.lag("timestamp").over(Window.partitionBy("file").orderBy("place"))
    return stored.withColumn("late", F.coalesce(before > F.col("timestamp"), F.lit(False))).groupBy("chunk_date").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if("late").alias("n_late")
    )


CHUNK_ORDER_SQL = f"""
WITH {WIDE_CTE} SELECT strftime(make_timestamp(timestamp * 1000), '%Y%m%d') AS chunk_date, count(*) AS n_rows, 0 AS n_late
FROM wide GROUP BY 1
"""


def preview(spark, sf_dir):
    """The first rows after a sort."""
    rows = tables.events(spark, sf_dir).select("event_id", "timestamp", "value")
    return ordering.preview(rows.orderBy("timestamp", "event_id"), 7)


PREVIEW_SQL = """
SELECT event_id, (epoch_us(ts) // 1000) AS timestamp, value FROM events ORDER BY 2, 1 LIMIT 7
"""


CHUNK_ROWS_SQL = f"""
WITH {WIDE_CTE} SELECT strftime(make_timestamp(timestamp * 1000), '%Y%m%d') AS chunk_date, count(*) AS n_rows
FROM wide GROUP BY 1
"""


def dedup_last_wins(spark, sf_dir):
    """Each event type is listed by several users; the last listing wins, errors' kind first."""
    rows = tables.events(spark, sf_dir).select(
        F.col("event_type").alias("query_id"),
        (F.col("user_id") % 2).alias("kind"),
        (F.col("user_id") % 10).alias("ordinal"),
        "event_id",
        "value",
    )
    return aggregates.keep_last_series(rows).select("query_id", "kind", "ordinal", "event_id", "value")


DEDUP_SQL = """
WITH r AS (SELECT event_type AS query_id, user_id % 2 AS kind, user_id % 10 AS ordinal, event_id, value FROM events)
SELECT query_id, kind, ordinal, event_id, value FROM (
  SELECT *, dense_rank() OVER (PARTITION BY query_id ORDER BY kind DESC, ordinal DESC) AS r FROM r) WHERE r = 1
"""


def distinct_names(spark, sf_dir):
    return aggregates.distinct_names(tables.metric_rows(spark, sf_dir))


DISTINCT_NAMES_SQL = "SELECT count(DISTINCT event_type) AS n_names FROM events"


def finite_rows(spark, sf_dir):
    rows = tables.damaged(spark, sf_dir).withColumn(
        "ratio", F.when(F.col("event_id") % 31 == 0, F.lit(float("inf"))).otherwise(F.col("value") / 2)
    )
    return clean.finite_rows(rows, ["value", "ratio"]).select("event_id", "value", "ratio")


FINITE_ROWS_SQL = """
SELECT event_id, value, value / 2 AS ratio FROM events
WHERE event_id % 17 <> 0 AND event_id % 23 <> 0 AND event_id % 31 <> 0
"""


QUERIES = {
    "metric_include_filter": (metric_include_filter, METRIC_INCLUDE_SQL),
    "kv_match": (kv_match, KV_MATCH_SQL),
    "allow_rules": (allow_rules, ALLOW_SQL),
    "allow_rules_join": (allow_rules_join, ALLOW_JOIN_SQL),
    "log_include_filter": (log_include_filter, LOG_INCLUDE_SQL),
    "clean_series": (clean_series, CLEAN_SERIES_SQL),
    "drop_nan_rows": (drop_nan_rows, DROP_NAN_SQL),
    "drop_null_rows": (drop_null_rows, DROP_NULL_SQL),
    "fill_nulls": (fill_nulls, FILL_NULLS_SQL),
    "clean_frame": (clean_frame, CLEAN_FRAME_SQL),
    "quality_gate": (quality_gate, QUALITY_GATE_SQL),
    "recent_window": (recent_window, RECENT_WINDOW_SQL),
    "day_range": (day_range, DAY_RANGE_SQL),
    "day_chunks": (day_chunks, DAY_CHUNKS_SQL),
    "day_chunk": (day_chunk, DAY_CHUNK_SQL),
    "chunk_order": (chunk_order, CHUNK_ORDER_SQL),
    "preview": (preview, PREVIEW_SQL),
    "chunk_rows": (chunk_rows, CHUNK_ROWS_SQL),
    "dedup_last_wins": (dedup_last_wins, DEDUP_SQL),
    "distinct_names": (distinct_names, DISTINCT_NAMES_SQL),
    "finite_rows": (finite_rows, FINITE_ROWS_SQL),
}
