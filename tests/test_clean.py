from __future__ import annotations

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from tidegauge.operators import clean

NAN = float("nan")


def frame(spark, rows, schema="a double, b double"):
    return spark.createDataFrame(rows, schema)


def shown(df):
    return [tuple("nan" if isinstance(v, float) and v != v else v for v in r) for r in df.collect()]


def test_nan_rows_go_and_nulls_stay(spark):
    df = frame(spark, [(1.0, 2.0), (NAN, 2.0), (None, 2.0), (None, NAN)])
    assert shown(clean.drop_nan_rows(df)) == [(1.0, 2.0), (None, 2.0)]
    ints = frame(spark, [(1,), (None,)], "a int")
    assert clean.drop_nan_rows(ints).count() == 2


def test_null_rows_are_counted(spark):
    seen = Observation()
    df = clean.drop_null_rows(frame(spark, [(1.0, 2.0), (None, 2.0), (NAN, 1.0)]), "a", seen)
    assert shown(df) == [(1.0, 2.0), ("nan", 1.0)]
    assert seen.get == {"rows": 3, "dropped_rows": 1}


def test_fill_leaves_nan(spark):
    df = clean.fill_nulls(frame(spark, [(None, 1.0), (NAN, None)]), "a")
    assert shown(df) == [(0.0, 1.0), ("nan", None)]


def test_clean_frame_order(spark):
    rows = [(1.0, 1.0, None), (None, 1.0, 1.0), (1.0, NAN, 1.0), (2.0, None, 3.0)]
    df = frame(spark, rows, "queue double, cpu double, lines double")
    assert shown(clean.clean_frame(df, "queue", "lines")) == [(1.0, 1.0, 0.0), (2.0, None, 3.0)]


def test_clean_series(spark):
    df = frame(spark, [(-1, 1.0), (0, 1.0), (1000, 1.0), (2000, NAN), (3000, None)], "timestamp long, value double")
    assert shown(clean.clean_series(df)) == [(1000, 1.0)]


@pytest.mark.parametrize(
    "rows, null, nan",
    [
        ([(1.0, 2.0)], False, False),
        ([(1.0, None)], True, False),
        ([(1.0, NAN)], False, True),
        ([(None, NAN)], True, True),
        ([], False, False),
    ],
)
def test_gate(spark, rows, null, nan):
    df = frame(spark, rows)
    assert (clean.is_null_present(df), clean.is_nan_present(df)) == (null, nan)
    if null or nan:
        with pytest.raises(clean.QualityError):
            clean.require_clean(df)
    else:
        clean.require_clean(df)


def test_gate_without_float_columns(spark):
    assert not clean.is_nan_present(frame(spark, [(1,)], "a int"))


def test_finite_rows(spark):
    df = frame(spark, [(1.0, 1.0), (float("inf"), 1.0), (1.0, float("-inf")), (NAN, 1.0), (None, 1.0)])
    assert shown(clean.finite_rows(df, ["a", "b"])) == [(1.0, 1.0)]


def test_row_counters(spark):
    rows = frame(spark, [(1.0, 1.0), (None, 2.0), (-3.0, 3.0)])
    df, seen = clean.count_rows(rows, "raw", kept=F.col("a") > 0)
    df.collect()
    assert seen.get == {"rows": 3, "kept_rows": 1, "filtered_rows": 2}
