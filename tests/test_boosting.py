"""Histogram booster: the same trees as a plain trainer, missing values, early stop."""

from __future__ import annotations

import numpy as np
import pytest

from tidegauge.operators import boosting

FEATURES = ["a", "b", "c"]


def rows(number=240, seed=5):
    rng = np.random.default_rng(seed)
    x = np.round(rng.normal(size=(number, 3)), 2)
    x[rng.random(x.shape) < 0.15] = np.nan
    y = np.where(np.isnan(x[:, 0]), 3.0, np.nan_to_num(x[:, 0]) * 2) + (np.nan_to_num(x[:, 1]) > 0.3) + 0.1 * rng.normal(size=number)
    return x, np.round(y, 3)


def frame(spark, x, y):
    data = [(*[None if np.isnan(v) else float(v) for v in row], float(t)) for row, t in zip(x, y)]
    return spark.createDataFrame(data, "a double, b double, c double, y double").repartition(3)


def plain_tree(bins, residual, settings, columns):
    """Every split of every node tried, row by row sums; the tree as nodes of a heap."""
    splits, values = {}, {}
    open_nodes = {0: np.arange(len(bins))}
    while open_nodes:
        node, own = open_nodes.popitem()
        g, h = residual[own].sum(), float(len(own))
        value = lambda a, n: np.sign(a) * max(abs(a) - settings.alpha, 0) ** 2 * np.sign(a) / (n + settings.lambda_)
        best = None
        if node < 2**settings.max_depth - 1:
            for f in np.flatnonzero(columns):
                for border in range(1, settings.bins):
                    for missing_left in (False, True):
                        left = np.where(bins[own, f] == 0, missing_left, bins[own, f] <= border)
                        n_left, n_right = left.sum(), (~left).sum()
                        if min(n_left, n_right) < max(1, settings.min_child_weight):
                            continue
                        a, b = residual[own][left].sum(), residual[own][~left].sum()
                        gain = 0.5 * (value(a, n_left) + value(b, n_right) - value(g, h)) - settings.gamma
                        if gain > 1e-9 and (best is None or round(gain, 9) > best[0]):
                            best = round(gain, 9), f, border, missing_left, own[left], own[~left]
        if best is None:
            values[node] = -np.sign(g) * max(abs(g) - settings.alpha, 0) / (h + settings.lambda_) * settings.learning_rate
        else:
            splits[node] = best[1:4]
            open_nodes |= {2 * node + 1: best[4], 2 * node + 2: best[5]}
    return splits, values


@pytest.mark.parametrize("alpha,lambda_,weight,gamma,colsample", [(0.0, 1.0, 1.0, 0.0, 1.0), (2.0, 0.5, 9.0, 0.2, 0.7)])
def test_same_trees_as_a_plain_trainer(spark, monkeypatch, alpha, lambda_, weight, gamma, colsample):
    monkeypatch.setattr(boosting, "STORE_EVERY", 2)
    settings = boosting.Settings(4, 3, 0.3, 1.0, colsample, weight, gamma, alpha, lambda_, patience=10, bins=8)
    x, y = rows()
    df = frame(spark, x[:180], y[:180])
    model = boosting.fit(df, df.limit(0), FEATURES, "y", settings)
    bins = boosting.binned(x[:180], model.edges)
    running = np.full(180, model.base)
    assert len(model.trees) == 4 and model.base == pytest.approx(y[:180].mean())
    for number, tree in enumerate(model.trees):
        columns = boosting.drawn_columns(3, number, settings)
        assert columns.sum() == max(1, int(colsample * 3))
        splits, values = plain_tree(bins, running - y[:180], settings, columns)
        assert {n: (s.feature, s.bin, s.missing_left) for n, s in tree.splits.items()} == splits
        assert tree.values == pytest.approx(values)
        running += tree.predict(bins)
    got = {tuple(r) for r in model.transform(df).select("y", "prediction").collect()}
    assert sorted(p for _, p in got) == pytest.approx(sorted({(t, p): p for t, p in zip(y[:180].tolist(), running.tolist())}.values()))


def test_missing_values_learn_their_side(spark):
    x, y = rows(600)
    df = frame(spark, x, y)
    model = boosting.fit(df, df, FEATURES, "y", boosting.Settings(60, 3, 0.3, patience=60))
    scored = model.transform(df).toPandas()
    error = np.abs(scored["prediction"] - scored["y"])
    assert error.mean() < 0.25 * np.abs(y - y.mean()).mean() and error[scored["a"].isna()].mean() < 0.3


def test_early_stop_and_empty_parts(spark):
    rng = np.random.default_rng(0)
    x, y = rng.normal(size=(200, 3)), rng.normal(size=200)
    df = frame(spark, x, y)
    model = boosting.fit(df.limit(100), df, FEATURES, "y", boosting.Settings(80, 3, 0.5, patience=4))
    assert len(model.trees) < 76
    with pytest.raises(ValueError, match="no row"):
        boosting.fit(df.limit(0), df, FEATURES, "y", boosting.Settings(2))
    nothing = boosting.fit(frame(spark, x[:5] * np.nan, y[:5]), df.limit(0), FEATURES, "y", boosting.Settings(2, 2))
    assert nothing.transform(df).filter("prediction IS NULL").count() == 0
