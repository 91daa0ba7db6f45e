"""Forecaster with changepoints: a piecewise linear trend, daily and weekly waves, extra regressors.

The trend may bend at points of a grid over the first part of the history; each bend is a hinge, a column that
is zero before its point and rises after it. All columns meet in one aggregation, which adds up their normal
equations about their means: terms times terms numbers, however many rows there are. On that matrix the bends are chosen by
coordinate descent with an L1 penalty, so only points where the slope changes keep a bend; waves and
regressors are shrunk a little, level and slope not at all.

``multiplicative`` seasons scale with the trend: there the logarithm of the target is modelled, which has to be
positive; rows where it is not are left out.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.functions.numbers import is_finite

MODES = ("additive", "multiplicative")
DAY_MS = 86_400_000


@dataclass
class TrendSettings:
    """``changepoints`` points over the first ``reach`` of the history; ``sparsity`` is the penalty of a bend as a
    share of the largest one that any bend would survive, ``shrink`` that of waves and regressors."""

    changepoints: int = 25
    reach: float = 0.8
    sparsity: float = 0.02
    shrink: float = 1e-3
    daily_order: int = 4
    weekly_order: int = 3
    mode: str = "additive"
    rounds: int = 5000
    tolerance: float = 1e-9


@dataclass
class Trend:
    """A fitted forecaster: ``weights`` by term; the bends are (epoch milliseconds, change of slope a day)."""

    settings: TrendSettings
    regressors: list[str]
    start: int
    span: int
    points: np.ndarray
    centre: np.ndarray
    weights: np.ndarray
    level: float

    @property
    def bends(self) -> list[tuple[int, float]]:
        changes = self.weights[1 : 1 + len(self.points)] * DAY_MS / self.span
        return [(int(self.start + p * self.span), float(c)) for p, c in zip(self.points, changes) if c]

    def transform(self, df: DataFrame, prediction: str = "prediction", ts: str = "timestamp") -> DataFrame:
        terms = term_columns(self.settings, self.points, self.start, self.span, self.regressors, ts)
        total = F.lit(self.level)
        for term, weight, centre in zip(terms, self.weights, self.centre):
            if weight:
                total = total + (term - F.lit(float(centre))) * F.lit(float(weight))
        return df.withColumn(prediction, F.exp(total) if self.settings.mode == "multiplicative" else total)


def term_columns(settings: TrendSettings, points: np.ndarray, start: int, span: int, regressors: list[str], ts: str) -> list[Column]:
    """Slope, hinges, waves, regressors; the level comes from the means."""
    place = (F.col(ts) - F.lit(start)) / F.lit(float(span))
    terms = [place, *[F.greatest(place - F.lit(float(p)), F.lit(0.0)) for p in points]]
    for period, order in ((DAY_MS, settings.daily_order), (7 * DAY_MS, settings.weekly_order)):
        phase = F.pmod(F.col(ts) - F.lit(start), F.lit(period)) / F.lit(float(period))
        for k in range(1, order + 1):
            terms += [F.sin(F.lit(2 * np.pi * k) * phase), F.cos(F.lit(2 * np.pi * k) * phase)]
    return terms + [F.col(f"`{c}`").cast("double") for c in regressors]


def normal_equations(df: DataFrame, columns: list[Column]) -> tuple[int, np.ndarray, np.ndarray]:
    """(rows, means, products about the means) of the columns.

    The means come first; then every task adds up its rows' products about them, and one aggregation adds up
    those of all tasks. Nothing is subtracted from large sums.
    """
    number = len(columns)
    rows = df.select(*[c.alias(f"c{k}") for k, c in enumerate(columns)])
    head = rows.agg(F.count(F.lit(1)).alias("n"), *[F.avg(f"c{k}").alias(f"m{k}") for k in range(number)]).first()
    if not head["n"]:
        return 0, np.zeros(number), np.zeros((number, number))
    mean = np.array([head[f"m{k}"] for k in range(number)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        products = np.zeros((number, number))
        for batch in batches:
            values = np.stack([np.array(c) for c in batch.columns], axis=1) - mean
            products += values.T @ values
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(number * number)), pa.array(products.reshape(-1))], ["k", "p"])

    sums = rows.mapInArrow(run, "k long, p double").groupBy("k").agg(F.sum("p").alias("p")).collect()
    products = np.zeros(number * number)
    for r in sums:
        products[r["k"]] = r["p"]
    return int(head["n"]), mean, products.reshape(number, number)


def descend(products: np.ndarray, with_target: np.ndarray, sparse: np.ndarray, ridge: np.ndarray, rounds: int, tolerance: float) -> np.ndarray:
    """Minimise 1/2 w'Aw - c'w + sum(sparse |w|) + 1/2 sum(ridge w^2), one coordinate after the other."""
    w = np.zeros(len(with_target))
    diagonal = np.diag(products) + ridge
    gradient = -with_target.astype("f8")
    for _ in range(rounds):
        largest = 0.0
        for k in np.flatnonzero(diagonal > 0):
            pull = diagonal[k] * w[k] - (gradient[k] + ridge[k] * w[k])
            new = np.sign(pull) * max(abs(pull) - sparse[k], 0.0) / diagonal[k]
            if new != w[k]:
                gradient += products[:, k] * (new - w[k])
                largest = max(largest, abs(new - w[k]) * diagonal[k] ** 0.5)
                w[k] = new
        if largest < tolerance:
            break
    return w


def fit_trend(df: DataFrame, target: str, regressors: list[str] | None = None, settings: TrendSettings | None = None, ts: str = "timestamp") -> Trend:
    settings = settings or TrendSettings()
    if settings.mode not in MODES:
        raise ValueError(f"the mode must be one of {MODES}")
    regressors = list(regressors or [])
    y = F.col(f"`{target}`").cast("double")
    numbers = [y, *[F.col(f"`{c}`").cast("double") for c in regressors]]
    usable = df.filter(F.col(ts).isNotNull())
    for number in numbers:
        usable = usable.filter(is_finite(number))
    if settings.mode == "multiplicative":
        usable = usable.filter(y > 0)
        y = F.log(y)
    span = usable.agg(F.min(ts).alias("a"), F.max(ts).alias("b")).first()
    if span["a"] is None:
        raise ValueError("no row with finite numbers is left to train on")
    start, length = int(span["a"]), max(1, int(span["b"]) - int(span["a"]))
    points = np.linspace(0, settings.reach, settings.changepoints + 2)[1:-1] if settings.changepoints else np.zeros(0)
    terms = term_columns(settings, points, start, length, regressors, ts)
    rows, mean, products = normal_equations(usable, [*terms, y])
    # columns of one size, so that penalties mean the same for all
    size = np.sqrt(np.maximum(np.diag(products), 0) / rows)
    size[size == 0] = 1.0
    scaled = products / np.outer(size, size) / rows
    inner, c = scaled[:-1, :-1], scaled[:-1, -1]
    bend = np.zeros(len(terms), bool)
    bend[1 : 1 + len(points)] = True
    ridge = np.where(bend, 0.0, settings.shrink)
    ridge[0] = 0.0
    # the smallest penalty without any bend: what the other terms leave over
    fixed = ~bend
    left = c - inner[:, fixed] @ np.linalg.lstsq(inner[np.ix_(fixed, fixed)] + np.diag(ridge[fixed]), c[fixed], rcond=None)[0]
    most = np.abs(left[bend]).max() if bend.any() else 0.0
    w = descend(inner, c, np.where(bend, settings.sparsity * most, 0.0), ridge, settings.rounds, settings.tolerance)
    weights = w * size[-1] / size[:-1]
    return Trend(settings, regressors, start, length, points, mean[:-1], weights, float(mean[-1]))
