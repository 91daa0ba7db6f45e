"""Queries of standardisation, error measures and models."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import functions as F

from tidegauge.operators import aggregates, clean, features, learn, ordering, standardize
from tidegauge.operators.merge import merge_series
from tidegauge.plans import tables
from tidegauge.plans.filtering import WIDE_CTE
from tidegauge.session import stored

_COLUMNS = ["l_quantity", "l_extendedprice", "l_discount"]


def _parts(spark, sf_dir):
    lineitem = tables.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", *_COLUMNS, (F.lit(3.0)).alias("constant")
    )
    # Train on the older half of the order keys, apply to everything.
    middle = lineitem.agg(F.max("l_orderkey")).first()[0] // 2
    return lineitem.filter(F.col("l_orderkey") <= middle), lineitem


def standardized(spark, sf_dir):
    train, everything = _parts(spark, sf_dir)
    columns = [*_COLUMNS, "constant"]
    _, (scaled,), _ = standardize.standardize(train, [everything], columns)
    return scaled.select(
        "l_orderkey", "l_linenumber", *[tables.shown(c, 6).alias(c) for c in columns]
    )


_TRAIN = "(SELECT * FROM lineitem WHERE l_orderkey <= (SELECT max(l_orderkey) // 2 FROM lineitem))"
STANDARDIZED_SQL = (
    "WITH s AS (SELECT "
    + ", ".join(f"avg({c}) AS m{i}, stddev_pop({c}) AS s{i}" for i, c in enumerate(_COLUMNS))
    + f" FROM {_TRAIN}) SELECT l_orderkey, l_linenumber, "
    + ", ".join(f"round(({c} - m{i}) / s{i} + 1e-9, 6) AS {c}" for i, c in enumerate(_COLUMNS))
    + ", 0.0::DOUBLE AS constant FROM lineitem, s"
)


def standardized_target(spark, sf_dir):
    """Target scale from the training half, applied and undone."""
    train, everything = _parts(spark, sf_dir)
    scale = standardize.fit_target(train, "l_extendedprice")
    scaled = standardize.apply_scale(everything, scale).withColumn("restored", F.col("l_extendedprice"))
    back = standardize.restore_target(scaled, scale, "restored", "l_extendedprice")
    return back.select(
        "l_orderkey",
        "l_linenumber",
        tables.shown("l_extendedprice", 6).alias("scaled"),
        tables.shown("restored", 4).alias("restored"),
    )


STANDARDIZED_TARGET_SQL = f"""
WITH s AS (SELECT avg(l_extendedprice) AS m, stddev_pop(l_extendedprice) AS s FROM {_TRAIN})
SELECT l_orderkey, l_linenumber, round((l_extendedprice - m) / s + 1e-9, 6) AS scaled, round(l_extendedprice + 1e-7, 4) AS restored
FROM lineitem, s
"""


def clipped(spark, sf_dir):
    train, everything = _parts(spark, sf_dir)
    scale = standardize.fit_scale(train, ["l_extendedprice"])
    scaled = standardize.apply_scale(everything, scale)
    cut = standardize.clip_columns(scaled, ["l_extendedprice"], -1.0, 1.0)
    return cut.select("l_orderkey", "l_linenumber", tables.shown("l_extendedprice", 6).alias("clipped"))


CLIPPED_SQL = f"""
WITH s AS (SELECT avg(l_extendedprice) AS m, stddev_pop(l_extendedprice) AS s FROM {_TRAIN})
SELECT l_orderkey, l_linenumber, round(greatest(least((l_extendedprice - m) / s, 1.0), -1.0) + 1e-9, 6) AS clipped
FROM lineitem, s
"""


def eval_metrics(spark, sf_dir):
    """A naive forecast (price per unit times a flat 25 units) against the real price."""
    rows = tables.table(spark, sf_dir, "lineitem").select(
        "l_returnflag",
        F.col("l_extendedprice").alias("y"),
        (F.col("l_extendedprice") / F.col("l_quantity") * 25).alias("p"),
    )
    scored = aggregates.evaluate(rows, "y", "p", by=("l_returnflag",))
    return scored.select("l_returnflag", *[tables.shown(c, 4).alias(c) for c in ("mae", "rmse", "mape")])


EVAL_METRICS_SQL = """
WITH r AS (SELECT l_returnflag, l_extendedprice AS y, l_extendedprice / l_quantity * 25 AS p FROM lineitem)
SELECT l_returnflag, round(avg(abs(y - p)) + 1e-7, 4) AS mae, round(sqrt(avg((y - p) * (y - p))) + 1e-7, 4) AS rmse,
       round(avg(abs(y - p) / greatest(abs(y), 2.220446049250313e-16)) + 1e-7, 4) AS mape
FROM r GROUP BY 1
"""


def ensemble_mean(spark, sf_dir):
    """Every line number counts as one run over its order."""
    runs = tables.table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("row_id"), F.col("l_extendedprice").alias("prediction")
    )
    return aggregates.ensemble_mean(runs).select("row_id", tables.shown("prediction", 4).alias("prediction"))


ENSEMBLE_MEAN_SQL = """
SELECT l_orderkey AS row_id, round(avg(l_extendedprice) + 1e-7, 4) AS prediction FROM lineitem GROUP BY 1
"""


def _grid_frame(spark, sf_dir):
    """The one-minute grid, cleaned: rows without target out, other gaps 0.

    Splits, features and models read it many times, so the grid is stored: the merge runs once.
    """
    grid = stored(merge_series(tables.series(spark, sf_dir), tables.WIDE), "models/grid")
    others = [c for c in tables.WIDE if c != tables.TARGET]
    cleaned = clean.clean_frame(grid, critical=tables.TARGET, zero_filled=others[0])
    for c in others[1:]:
        cleaned = clean.fill_nulls(cleaned, c)
    return cleaned


def _demand_frame(spark, sf_dir):
    """The grid frame with a target that can be learned: a daily wave, a share of another series, and the
    target's own values as noise."""
    day = 2 * math.pi / 86_400_000
    wave = _WAVE * F.sin(F.lit(day) * (F.col("timestamp") % 86_400_000))
    demand = wave + 0.5 * F.col(_FIRST) + _NOISE * F.col(tables.TARGET)
    return _grid_frame(spark, sf_dir).withColumn(tables.TARGET, demand)


def _model_frame(spark, sf_dir):
    """The demand frame with the full feature set; read by several models, so it is stored."""
    return stored(features.generate_features(_demand_frame(spark, sf_dir), list(tables.WIDE), tables.TARGET), "models/frame")


# Target of the models: height of the wave and share of the noise. A model is good if its error is below so
# much of that of the mean of its training part.
_WAVE, _NOISE, _BETTER = 200.0, 0.1, 0.6


def _measured(scores, frame, part):
    """A model's row beside the error that the training part's mean makes on the same rows."""
    parts = dict(zip(("train", "val", "test"), ordering.split_by_time(frame, 0.15, 0.15)))
    mean = parts["train"].agg(F.avg(tables.TARGET)).first()[0]
    plain = F.lit(parts[part].agg(F.avg(F.abs(F.col(tables.TARGET) - mean))).first()[0])
    better = (F.col("mae") <= F.col("rmse")) & (F.col("mae") < _BETTER * plain)
    counted = ("model", "features_number", "rows_train", "rows_measured")
    return scores.select(*counted, tables.shown(plain, 4).alias("mean_mae"), better.alias("beats_mean"))


# The boosted query's rate and patience: a strong target needs few trees.
_BOOSTING = {"learning_rate": 0.3, "patience": 5}


def forest(spark, sf_dir):
    frame = _model_frame(spark, sf_dir)
    return _measured(learn.train_forest(frame, tables.TARGET)[1], frame, "val")


def boosted(spark, sf_dir):
    frame = _model_frame(spark, sf_dir)
    return _measured(learn.train_boosted(frame, tables.TARGET, **_BOOSTING)[1], frame, "test")


def seasonal_regression(spark, sf_dir):
    frame = _demand_frame(spark, sf_dir)
    return _measured(learn.train_seasonal(frame, tables.TARGET, list(tables.WIDE))[1], frame, "val")


# The planted bend: after this share of the training part's time the target rises by so much a day.
_BEND, _RISE = 0.5, 40.0


def _bent_frame(spark, sf_dir):
    """The demand frame with a bend in its trend, and where the bend is."""
    frame = _demand_frame(spark, sf_dir)
    train = ordering.split_by_time(frame, 0.15, 0.15)[0]
    ends = train.agg(F.min("timestamp"), F.max("timestamp")).first()
    at = int(ends[0] + _BEND * (ends[1] - ends[0]))
    risen = F.greatest(F.col("timestamp") - at, F.lit(0)) * (_RISE / 86_400_000)
    return frame.withColumn(tables.TARGET, F.col(tables.TARGET) + risen), at, ends[1] - ends[0]


def changepoint_trend(spark, sf_dir):
    """The forecaster with changepoints on a target that bends: its errors against the mean's, and whether most of
    the change of slope is found near the planted bend."""
    frame, at, span = _bent_frame(spark, sf_dir)
    model, scores = learn.train_trend(frame, tables.TARGET, list(tables.WIDE))
    near = sum(change for when, change in model.bends if abs(when - at) < 0.1 * span)
    measured = _measured(scores, frame, "val")
    return measured.withColumn("bend_found", F.lit(bool(abs(near - _RISE) < 0.3 * _RISE)))


def model_table(spark, sf_dir):
    """The forecasters' errors on the same frame, one row each; no twin, since SQL does not train."""
    frame = _model_frame(spark, sf_dir)
    scores = [
        learn.train_forest(frame, tables.TARGET)[1],
        learn.train_boosted(frame, tables.TARGET, **_BOOSTING)[1],
        learn.train_seasonal(frame, tables.TARGET, list(tables.WIDE))[1],
        learn.train_trend(frame, tables.TARGET, list(tables.WIDE))[1],
    ]
    table = learn.evaluation_table(scores)
    return table.select("model", "features_number", "rows_train", "rows_measured", *[tables.shown(c, 4).alias(c) for c in ("mae", "rmse", "mape")])


_FIRST = [c for c in tables.WIDE if c != tables.TARGET][0]
_SIZES_CTE = f"""
WITH {WIDE_CTE}, n AS (SELECT count(view) AS n FROM wide),
sizes AS (SELECT n, trunc(n * (1 - 0.15::DOUBLE - 0.15::DOUBLE))::BIGINT AS a, trunc(n * (1 - 0.15::DOUBLE))::BIGINT AS b FROM n)
"""
_DEMAND_CTE = f"""
demand AS (
  SELECT timestamp, {_WAVE} * sin(2 * pi() * (timestamp % 86400000) / 86400000.0) + 0.5 * coalesce({_FIRST}, 0) + {_NOISE} * view AS y,
    row_number() OVER (ORDER BY timestamp) - 1 AS i
  FROM wide WHERE view IS NOT NULL),
parts AS (SELECT timestamp, y, CASE WHEN i < a THEN 'train' WHEN i < b THEN 'val' ELSE 'test' END AS part FROM demand, sizes)
"""
_PLAIN_CTE = """
mean AS (SELECT avg(y) AS mean, count(*) AS rows_train FROM parts WHERE part = 'train'),
plain AS (SELECT part, avg(abs(y - mean)) AS mae, count(*) AS n FROM parts, mean GROUP BY part)
"""
# timestamp, other series, seasons, lags, means, deviations, ratios, scores; and trend, waves, other series
_OTHERS = len(tables.WIDE) - 1
_N_FEATURES = 1 + _OTHERS + 9 + len(tables.WIDE) * (len(features.LAGS) + 2 * len(features.WIDTHS)) + 5 * _OTHERS
_N_SEASONAL = 1 + 2 * (4 + 3) + _OTHERS


def _model_sql(name: str, number: int, part: str) -> str:
    return f"""{_SIZES_CTE}, {_DEMAND_CTE}, {_PLAIN_CTE}
SELECT '{name}' AS model, {number} AS features_number, rows_train, n AS rows_measured,
  round(mae + 1e-7, 4) AS mean_mae, true AS beats_mean FROM plain, mean WHERE part = '{part}'"""


CHANGEPOINT_SQL = f"""{_SIZES_CTE}, {_DEMAND_CTE},
bend AS (
  SELECT trunc(min(timestamp) + {_BEND} * (max(timestamp) - min(timestamp))) AS middle FROM parts WHERE part = 'train'),
bent AS (SELECT part, y + greatest(timestamp - middle, 0) * ({_RISE} / 86400000) AS y FROM parts, bend),
mean AS (SELECT avg(y) AS mean, count(*) AS rows_train FROM bent WHERE part = 'train'),
plain AS (SELECT avg(abs(y - mean)) AS mae, count(*) AS n FROM bent, mean WHERE part = 'val')
SELECT 'changepoint_trend' AS model, {len(tables.WIDE)} AS features_number, rows_train, n AS rows_measured,
  round(mae + 1e-7, 4) AS mean_mae, true AS beats_mean, true AS bend_found FROM plain, mean
"""
_FOREST = ("random_forest", _N_FEATURES, "val")
_BOOSTED = ("boosted_trees", _N_FEATURES, "test")
_SEASONAL = ("seasonal_regression", _N_SEASONAL, "val")
# A sequence of a day, and a short one for tables whose parts are shorter than that.
LENGTHS = (1440, 12)


def sequence_training_table(spark, sf_dir):
    """Prepared sequences of all three parts, by place, length and target, sliced from stored blocks."""
    frame = _grid_frame(spark, sf_dir)

    def shown_sequences(start, x, y):
        return {"start_idx": start, "n_rows": np.full(len(start), x.shape[1]), "y": y.astype("f8"), "total": x[:, :, 1].sum(axis=1, dtype="f8")}

    out = None
    for length in LENGTHS:
        made, _, _ = learn.prepare_sequences(frame, tables.TARGET, length=length, blocks=True, short="empty")
        for name, blocks in made.items():
            rows = ordering.map_sequences(blocks, length, shown_sequences, "start_idx long, n_rows long, y double, total double")
            part = rows.select(F.lit(name).alias("part"), "start_idx", "n_rows", tables.shown("y", 4).alias("y"), tables.shown("total", 3).alias("total"))
            out = part if out is None else out.unionByName(part)
    return out


def _sequences_sql(length):
    return f"""SELECT part, j - {length} AS start_idx, count(*) OVER w AS n_rows, y, sum(x) OVER w AS total
  FROM scaled WINDOW w AS (PARTITION BY part ORDER BY j ROWS BETWEEN {length} PRECEDING AND 1 PRECEDING) QUALIFY n_rows = {length}"""


SEQUENCE_TRAINING_SQL = f"""
{_SIZES_CTE},
numbered AS (
  SELECT timestamp, view, coalesce({_FIRST}, 0) AS x, row_number() OVER (ORDER BY timestamp) - 1 AS i FROM wide WHERE view IS NOT NULL),
parts AS (
  SELECT *, CASE WHEN i < a THEN 'train' WHEN i < b THEN 'val' ELSE 'test' END AS part FROM numbered, sizes),
scale AS (
  SELECT avg(view) AS my, stddev_pop(view) AS sy, avg(x) AS mx, stddev_pop(x) AS sx FROM parts WHERE part = 'train'),
scaled AS (
  SELECT part, row_number() OVER (PARTITION BY part ORDER BY timestamp) - 1 AS j,
    CAST(CAST((view - my) / sy AS FLOAT) AS DOUBLE) AS y,
    CAST(CAST(greatest(least((x - mx) / sx, 20), -20) AS FLOAT) AS DOUBLE) AS x
  FROM parts, scale),
made AS ({" UNION ALL ".join(f"({_sequences_sql(n)})" for n in LENGTHS)})
SELECT part, start_idx, n_rows, round(y + 1e-7, 4) AS y, round(total + 1e-6, 3) AS total FROM made
"""


QUERIES = {
    "standardize": (standardized, STANDARDIZED_SQL),
    "standardize_target": (standardized_target, STANDARDIZED_TARGET_SQL),
    "clip": (clipped, CLIPPED_SQL),
    "eval_metrics": (eval_metrics, EVAL_METRICS_SQL),
    "ensemble_mean": (ensemble_mean, ENSEMBLE_MEAN_SQL),
    "forest": (forest, _model_sql(*_FOREST)),
    "boosted": (boosted, _model_sql(*_BOOSTED)),
    "seasonal_regression": (seasonal_regression, _model_sql(*_SEASONAL)),
    "changepoint_trend": (changepoint_trend, CHANGEPOINT_SQL),
    "model_table": (model_table, None),
    "sequence_training_table": (sequence_training_table, SEQUENCE_TRAINING_SQL),
}
