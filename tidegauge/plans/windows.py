"""Queries of seasonality, lags, rolling statistics, splits and sequences."""

from __future__ import annotations

import math
from functools import partial

from pyspark.sql import functions as F

from tidegauge.functions import calendar
from tidegauge.operators import aggregates, features, ordering, rolling
from tidegauge.operators.merge import merge_series, resample
from tidegauge.operators.rolling import DAY, HOUR
from tidegauge.plans import tables
from tidegauge.plans.filtering import WIDE_CTE, wide_cte
from tidegauge.plans.grid import TRAINING_SQL

COLUMNS = list(tables.WIDE)


def _rounded(df, columns, digits=6):
    return df.select("timestamp", *[tables.shown(c, digits).alias(c) for c in columns])


def _grid_times(spark, sf_dir):
    return tables.events(spark, sf_dir).select("event_id", "timestamp")


def _season(spark, sf_dir, make):
    df = make(_grid_times(spark, sf_dir))
    made = [c for c in df.columns if c not in ("event_id", "timestamp")]
    return df.select("event_id", *[tables.shown(F.col(c).cast("double"), 9).alias(c) for c in made])


def _wave_sql(name: str, angle: str) -> str:
    return f"round(sin({angle}) + 1e-12, 9) AS {name.format('sin')}, round(cos({angle}) + 1e-12, 9) AS {name.format('cos')}"


_TAU = repr(2 * math.pi)
_FLAG = "CAST(CASE WHEN isodow(ts) <= 5 THEN 1 ELSE 0 END AS DOUBLE) AS is_business_day"
_HOUR_WAVE = _wave_sql("hour_{}", f"{_TAU} * hour(ts) / 24")
_HARMONICS = ", ".join(_wave_sql("hour_{}_" + str(k), f"{2 * math.pi * k!r} * hour(ts) / 24") for k in (1, 2, 3))


def _season_sql(columns: str) -> str:
    return f"SELECT event_id, {columns} FROM events"


def lag_rows(spark, sf_dir):
    """All lags of the feature set."""
    df = features.lag_rows(tables.wide(spark, sf_dir), COLUMNS)
    return _rounded(df, [f"{c}_lag_{s}" for s in features.LAGS for c in COLUMNS])


LAG_ROWS_SQL = (
    f"WITH {WIDE_CTE} SELECT timestamp, "
    + ", ".join(
        f"round(lag({c}, {n}) OVER (ORDER BY timestamp) + 1e-9, 6) AS {c}_lag_{s}"
        for s, n in features.LAGS.items()
        for c in COLUMNS
    )
    + " FROM wide"
)


def _keyed(spark, sf_dir):
    """Per event type on the one-minute grid: many series in one long frame."""
    return resample(tables.series(spark, sf_dir), {"value": "mean"}, keys=("query_id",))


_KEYED_CTE = """
keyed AS (SELECT event_type AS query_id, ((epoch_us(ts) // 1000) // 60000) * 60000 AS timestamp, avg(value) AS value
          FROM events GROUP BY 1, 2)
"""


def lag_rows_keyed(spark, sf_dir):
    df = features.lag_rows(_keyed(spark, sf_dir), ["value"], {"1m": 1, "12h": 720}, keys=("query_id",))
    return df.select(
        "query_id", "timestamp", *[tables.shown(f"value_lag_{s}", 6).alias(f"value_lag_{s}") for s in ("1m", "12h")]
    )


LAG_ROWS_KEYED_SQL = f"""
WITH {_KEYED_CTE}
SELECT query_id, timestamp, round(lag(value, 1) OVER w + 1e-9, 6) AS value_lag_1m, round(lag(value, 720) OVER w + 1e-9, 6) AS value_lag_12h
FROM keyed WINDOW w AS (PARTITION BY query_id ORDER BY timestamp)
"""

_ROLLING = {
    "mean": (rolling.rolling_mean, "avg({c})", features.WIDTHS),
    "std": (rolling.rolling_std, "stddev_samp({c})", features.WIDTHS),
    "p50": (rolling.rolling_p50, "median({c})", features.WIDTHS),
    "p90": (
        rolling.rolling_p90,
        "list({c}) FILTER (WHERE {c} IS NOT NULL)",
        features.WIDTHS,
    ),
}


def rolling_query(spark, sf_dir, stat):
    make, _, widths = _ROLLING[stat]
    df = make(tables.wide(spark, sf_dir), COLUMNS, widths)
    return _rounded(df, [f"{c}_{stat}_{w}i" for w in widths for c in COLUMNS], 5)


def _rolling_sql(stat: str) -> str:
    _, template, widths = _ROLLING[stat]
    inner, outer = [], []
    for w in widths:
        for c in COLUMNS:
            name = f"{c}_{stat}_{w}i"
            frame = f"(ORDER BY timestamp RANGE BETWEEN {w - 1} PRECEDING AND CURRENT ROW)"
            inner.append(f"{template.format(c=c)} OVER {frame} AS {name}")
            value = f"lag({name}) OVER (ORDER BY timestamp)"
            if stat == "p90":
                value = f"list_sort({value})[1 + CAST(floor((len({value}) - 1) * 0.9 + 0.5) AS BIGINT)]"
            outer.append(f"round({value} + 1e-8, 5) AS {name}")
    return (
        f"WITH {WIDE_CTE}, r AS (SELECT timestamp, {', '.join(inner)} FROM wide)"
        f" SELECT timestamp, {', '.join(outer)} FROM r"
    )


def rolling_std_spiked(spark, sf_dir):
    """Deviations where every 997th value is a billion times too large: spikes must leave no trace.

    Shown as logarithms, as the numbers span nine orders of magnitude.
    """
    spiked = F.when(F.col("event_id") % 997 == 0, F.col("value") * 1e9).otherwise(F.col("value"))
    grid = merge_series(tables.series(spark, sf_dir).withColumn("value", spiked), tables.WIDE)
    df = rolling.rolling_statistics(grid, COLUMNS, _SPIKE_WIDTHS, ("std",))
    names = [f"{c}_std_{w}i" for w in _SPIKE_WIDTHS for c in COLUMNS]
    return df.select("timestamp", *[tables.shown(F.log1p(F.abs(n)), 8).alias(n) for n in names])


_SPIKE_WIDTHS = [HOUR, DAY, 7 * DAY]
ROLLING_STD_SPIKED_SQL = (
    "WITH spiked AS (SELECT * REPLACE (CASE WHEN event_id % 997 = 0 THEN value * 1e9 ELSE value END AS value) FROM events),"
    f" {wide_cte('spiked')} SELECT timestamp, "
    + ", ".join(
        f"round(ln(1 + stddev_samp({c}) OVER (ORDER BY timestamp RANGE BETWEEN {w - 1} PRECEDING AND CURRENT ROW))"
        f" + 1e-11, 8) AS {c}_std_{w}i"
        for w in _SPIKE_WIDTHS
        for c in COLUMNS
    )
    + " FROM wide"
)


def rolling_keyed(spark, sf_dir):
    widths = [HOUR, 7 * DAY]
    df = rolling.rolling_statistics(_keyed(spark, sf_dir), ["value"], widths, keys=("query_id",))
    names = [f"value_{stat}_{w}i" for stat in ("mean", "std") for w in widths]
    return df.select("query_id", "timestamp", *[tables.shown(n, 5).alias(n) for n in names])


ROLLING_KEYED_SQL = (
    f"WITH {_KEYED_CTE} SELECT query_id, timestamp, "
    + ", ".join(
        f"round({fn}(value) OVER (PARTITION BY query_id ORDER BY timestamp RANGE BETWEEN {w - 1} PRECEDING"
        f" AND CURRENT ROW) + 1e-8, 5) AS value_{stat}_{w}i"
        for stat, fn in (("mean", "avg"), ("std", "stddev_samp"))
        for w in (HOUR, 7 * DAY)
    )
    + " FROM keyed"
)

RATIO_COLUMNS = [c for c in COLUMNS if c != tables.TARGET]


def _lagged(spark, sf_dir):
    return features.lagged_features(
        tables.wide(spark, sf_dir), COLUMNS, RATIO_COLUMNS, lags={"1m": 1}, widths=[HOUR, DAY]
    )


def diff_ratio(spark, sf_dir):
    names = [f"{c}_{n}" for c in RATIO_COLUMNS for n in ("diff_mean_1h", "ratio_mean_1h_1d")]
    return _rounded(_lagged(spark, sf_dir), names, 5)


def delta_zscore(spark, sf_dir):
    names = [f"{c}_{n}" for c in RATIO_COLUMNS for n in ("delta_mean_1h", "zscore_1h", "zscore_1d")]
    return _rounded(_lagged(spark, sf_dir), names, 4)


def _feature_sql(lags: dict[str, int], widths: list[int]) -> tuple[str, dict[str, str]]:
    """CTEs up to the moved statistics, and an expression per derived column."""
    raw, moved = [], []
    for w in widths:
        frame = f"(ORDER BY timestamp RANGE BETWEEN {w - 1} PRECEDING AND CURRENT ROW)"
        for c in COLUMNS:
            for stat, fn in (("mean", "avg"), ("std", "stddev_samp")):
                raw.append(f"{fn}({c}) OVER {frame} AS {c}_{stat}_{w}i")
                moved.append(f"lag({c}_{stat}_{w}i) OVER (ORDER BY timestamp) AS {c}_{stat}_{w}i")
    for c in COLUMNS:
        moved += [f"lag({c}, {n}) OVER (ORDER BY timestamp) AS {c}_lag_{s}" for s, n in lags.items()]
        moved.append(f"lag({c}) OVER (ORDER BY timestamp) AS prev_{c}")
        moved.append(f"lag({c}_mean_{HOUR}i, 2) OVER (ORDER BY timestamp) AS older_{c}")
    ctes = (
        f"{WIDE_CTE}, raw AS (SELECT *, {', '.join(raw)} FROM wide),"
        f" moved AS (SELECT timestamp, {', '.join(COLUMNS)}, {', '.join(moved)} FROM raw)"
    )
    expressions = {f"{c}_lag_{s}": f"{c}_lag_{s}" for s in lags for c in COLUMNS}
    expressions |= {f"{c}_{stat}_{w}i": f"{c}_{stat}_{w}i" for stat in ("mean", "std") for w in widths for c in COLUMNS}
    for c in RATIO_COLUMNS:
        h, d = f"{c}_mean_{HOUR}i", f"{c}_mean_{DAY}i"
        sh, sd = f"{c}_std_{HOUR}i", f"{c}_std_{DAY}i"
        expressions |= {
            f"{c}_diff_mean_1h": f"prev_{c} - {h}",
            f"{c}_ratio_mean_1h_1d": f"CASE WHEN abs({d}) > 1e-9 THEN {h} / {d} END",
            f"{c}_delta_mean_1h": f"{h} - older_{c}",
            f"{c}_zscore_1h": f"CASE WHEN abs({sh}) > 1e-9 THEN (prev_{c} - {h}) / {sh} END",
            f"{c}_zscore_1d": f"CASE WHEN abs({sd}) > 1e-9 THEN (prev_{c} - {d}) / {sd} END",
        }
    return ctes, expressions


def _derived_sql(names: list[str], digits: int) -> str:
    ctes, expressions = _feature_sql({"1m": 1}, [HOUR, DAY])
    columns = ", ".join(f"round({expressions[n]} + 1e-{digits + 3}, {digits}) AS {n}" for n in names)
    return f"WITH {ctes} SELECT timestamp, {columns} FROM moved"


DIFF_RATIO_SQL = _derived_sql([f"{c}_{n}" for c in RATIO_COLUMNS for n in ("diff_mean_1h", "ratio_mean_1h_1d")], 5)
DELTA_ZSCORE_SQL = _derived_sql(
    [f"{c}_{n}" for c in RATIO_COLUMNS for n in ("delta_mean_1h", "zscore_1h", "zscore_1d")], 4
)


def ml_features(spark, sf_dir):
    """The full set of derived columns."""
    df = features.generate_features(tables.wide(spark, sf_dir), COLUMNS, tables.TARGET)
    return _rounded(df, [c for c in df.columns if c != "timestamp"], 4)


def _ml_features_sql() -> str:
    ctes, expressions = _feature_sql(features.LAGS, features.WIDTHS)
    at = "make_timestamp(timestamp * 1000)"
    seasons = f"{_HOUR_WAVE}, {_HARMONICS}".replace("hour(ts)", f"hour({at})").replace(", 9)", ", 4)")
    flag = f"CASE WHEN isodow({at}) <= 5 THEN 1 ELSE 0 END::TINYINT AS is_business_day"
    plain = ", ".join(f"round({c} + 1e-7, 4) AS {c}" for c in COLUMNS)
    derived = ", ".join(f"round({e} + 1e-7, 4) AS {n}" for n, e in expressions.items())
    return f"WITH {ctes} SELECT timestamp, {plain}, {seasons}, {flag}, {derived} FROM moved"


def sequence_features(spark, sf_dir):
    """The minimal set: seasonality only, no shuffle beyond the merge."""
    df = features.generate_features(tables.wide(spark, sf_dir), COLUMNS, tables.TARGET, kind="sequence")
    return _rounded(df, [c for c in df.columns if c != "timestamp"], 6)


def _sequence_features_sql() -> str:
    at = "make_timestamp(timestamp * 1000)"
    seasons = f"{_HOUR_WAVE}, {_HARMONICS}".replace("hour(ts)", f"hour({at})").replace(", 9)", ", 6)")
    flag = f"CASE WHEN isodow({at}) <= 5 THEN 1 ELSE 0 END::TINYINT AS is_business_day"
    plain = ", ".join(f"round({c} + 1e-9, 6) AS {c}" for c in COLUMNS)
    return f"WITH {WIDE_CTE} SELECT timestamp, {plain}, {seasons}, {flag} FROM wide"


def chrono_split(spark, sf_dir):
    rows = tables.events(spark, sf_dir).select("event_id", "timestamp")
    return ordering.split_label(rows, tie="event_id").select("event_id", "split")


CHRONO_SPLIT_SQL = """
WITH n AS (SELECT event_id, row_number() OVER (ORDER BY (epoch_us(ts) // 1000), event_id) - 1 AS i, count(*) OVER () AS total FROM events)
SELECT event_id, CASE WHEN i < trunc(total * (1 - 0.15::DOUBLE - 0.15::DOUBLE)) THEN 'train'
                      WHEN i < trunc(total * (1 - 0.15::DOUBLE)) THEN 'val' ELSE 'test' END AS split FROM n
"""


def split_ties(spark, sf_dir):
    """The split of the training aggregate, whose rows share bucket times and hold maps, as counts."""
    rows = aggregates.training_aggregate(tables.metric_rows(spark, sf_dir), tables.AS_OF)
    parts = ordering.split_by_time(rows)
    counted = [df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("part"), "n") for name, df in zip(("train", "val", "test"), parts)]
    return counted[0].unionByName(counted[1]).unionByName(counted[2])


SPLIT_TIES_SQL = f"""
WITH t AS ({TRAINING_SQL}), n AS (SELECT count(*) AS n FROM t),
s AS (SELECT n, trunc(n * (1 - 0.15::DOUBLE - 0.15::DOUBLE))::BIGINT AS a, trunc(n * (1 - 0.15::DOUBLE))::BIGINT AS b FROM n)
SELECT 'train' AS part, a AS n FROM s UNION ALL SELECT 'val', b - a FROM s UNION ALL SELECT 'test', n - b FROM s
"""


def row_index(spark, sf_dir):
    rows = tables.events(spark, sf_dir).select("event_id", "event_type", "timestamp")
    indexed = ordering.with_row_index(rows, ("timestamp", "event_id"))
    per_type = ordering.with_row_index(rows, ("timestamp", "event_id"), keys=("event_type",))
    return indexed.select("event_id", F.col("row_idx").alias("idx")).join(
        per_type.select("event_id", F.col("row_idx").alias("type_idx")), "event_id"
    )


ROW_INDEX_SQL = """
SELECT event_id, row_number() OVER (ORDER BY (epoch_us(ts) // 1000), event_id) - 1 AS idx,
       row_number() OVER (PARTITION BY event_type ORDER BY (epoch_us(ts) // 1000), event_id) - 1 AS type_idx
FROM events
"""

LENGTH = 30


def sequences(spark, sf_dir):
    """Sequences of 30 rows over all events, shown by their sums and edges."""
    rows = tables.events(spark, sf_dir).select("event_id", "timestamp", "value", "user_id")
    indexed = ordering.with_row_index(rows, ("timestamp", "event_id"))
    made = ordering.sequences(indexed, ["value", "user_id"], "value", LENGTH)
    total = F.aggregate("x", F.lit(0.0), lambda acc, row: acc + row[0].cast("double"))
    return made.select(
        "start_idx",
        F.size("x").alias("n_rows"),
        tables.shown(total, 2).alias("total"),
        F.get(F.get("x", F.lit(0)), F.lit(1)).cast("bigint").alias("first_user"),
        F.get(F.get("x", F.lit(LENGTH - 1)), F.lit(1)).cast("bigint").alias("last_user"),
        tables.shown(F.col("y").cast("double"), 2).alias("y"),
    )


SEQUENCES_SQL = f"""
WITH n AS (SELECT row_number() OVER (ORDER BY (epoch_us(ts) // 1000), event_id) - 1 AS i, value, user_id FROM events),
s AS (SELECT i - {LENGTH} AS start_idx, count(*) OVER w AS n_rows,
             round(sum(CAST(CAST(value AS FLOAT) AS DOUBLE)) OVER w + 1e-5, 2) AS total,
             first_value(user_id) OVER w AS first_user, last_value(user_id) OVER w AS last_user,
             round(value + 1e-5, 2) AS y
      FROM n WINDOW w AS (ORDER BY i ROWS BETWEEN {LENGTH} PRECEDING AND 1 PRECEDING))
SELECT * FROM s WHERE n_rows = {LENGTH}
"""


QUERIES = {
    "hour_seasonality": (partial(_season, make=calendar.hour_seasonality), _season_sql(_HOUR_WAVE)),
    "harmonics": (partial(_season, make=calendar.harmonics_hours), _season_sql(_HARMONICS)),
    "week_seasonality": (
        partial(_season, make=calendar.week_seasonality),
        _season_sql(_wave_sql("day_of_week_{}", f"{_TAU} * isodow(ts) / 7")),
    ),
    "month_seasonality": (
        partial(_season, make=calendar.month_seasonality),
        _season_sql(_wave_sql("month_{}", f"{_TAU} * month(ts) / 12")),
    ),
    "business_day": (partial(_season, make=calendar.business_day), _season_sql(_FLAG)),
    "sequence_features": (sequence_features, _sequence_features_sql()),
    "lag_rows": (lag_rows, LAG_ROWS_SQL),
    "lag_rows_keyed": (lag_rows_keyed, LAG_ROWS_KEYED_SQL),
    **{f"rolling_{stat}": (partial(rolling_query, stat=stat), _rolling_sql(stat)) for stat in _ROLLING},
    "rolling_std_spiked": (rolling_std_spiked, ROLLING_STD_SPIKED_SQL),
    "rolling_keyed": (rolling_keyed, ROLLING_KEYED_SQL),
    "diff_ratio": (diff_ratio, DIFF_RATIO_SQL),
    "delta_zscore": (delta_zscore, DELTA_ZSCORE_SQL),
    "ml_features": (ml_features, _ml_features_sql()),
    "chrono_split": (chrono_split, CHRONO_SPLIT_SQL),
    "split_ties": (split_ties, SPLIT_TIES_SQL),
    "row_index": (row_index, ROW_INDEX_SQL),
    "sequences": (sequences, SEQUENCES_SQL),
}
