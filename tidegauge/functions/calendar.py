"""Seasonality columns, day keys and day ranges, all in UTC."""

from __future__ import annotations

import math
from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.functions.numbers import floor_div

DAY_KEY = "yyyyMMdd"


def from_millis(ms: Column) -> Column:
    return F.timestamp_millis(ms)


def from_nanos(ns: Column) -> Column:
    """Nanoseconds to a microsecond timestamp."""
    return F.timestamp_micros(floor_div(ns, 1000))


def _wave(df: DataFrame, angle: Column, sin_name: str, cos_name: str) -> DataFrame:
    return df.withColumns({sin_name: F.sin(angle), cos_name: F.cos(angle)})


def hour_seasonality(df: DataFrame, ts: str = "timestamp") -> DataFrame:
    angle = F.lit(2 * math.pi) * F.hour(from_millis(F.col(ts))) / 24
    return _wave(df, angle, "hour_sin", "hour_cos")


def harmonics_hours(df: DataFrame, ts: str = "timestamp", harmonics: int = 3) -> DataFrame:
    hour = F.hour(from_millis(F.col(ts)))
    columns = {}
    for k in range(1, harmonics + 1):
        angle = F.lit(2 * math.pi * k) * hour / 24
        columns[f"hour_sin_{k}"] = F.sin(angle)
        columns[f"hour_cos_{k}"] = F.cos(angle)
    return df.withColumns(columns)


def week_seasonality(df: DataFrame, ts: str = "timestamp") -> DataFrame:
    """Monday counts as 1 and Sunday as 7."""
    angle = F.lit(2 * math.pi) * (F.weekday(from_millis(F.col(ts))) + 1) / 7
    return _wave(df, angle, "day_of_week_sin", "day_of_week_cos")


def month_seasonality(df: DataFrame, ts: str = "timestamp") -> DataFrame:
    angle = F.lit(2 * math.pi) * F.month(from_millis(F.col(ts))) / 12
    return _wave(df, angle, "month_sin", "month_cos")


def business_day(df: DataFrame, ts: str = "timestamp") -> DataFrame:
    flag = (F.weekday(from_millis(F.col(ts))) < 5).cast("tinyint")
    return df.withColumn("is_business_day", flag)


def day_key(ts: Column) -> Column:
    return F.date_format(ts, DAY_KEY)


def parse_day_key(text: str) -> str:
    """Return the key unchanged when it is a real day written as YYYYMMDD."""
    try:
        parsed = datetime.strptime(text, "%Y%m%d")
    except ValueError as error:
        raise ValueError(f"not a day key (year, month, day as eight digits): {text!r}") from error
    if parsed.strftime("%Y%m%d") != text:
        raise ValueError(f"not a day key (year, month, day as eight digits): {text!r}")
    return text


def previous_day_range(as_of: datetime | None = None, offset_days: int = 0) -> tuple[datetime, datetime]:
    """First and last second of the UTC day before ``as_of``, moved back by ``offset_days``."""
    now = as_of or datetime.now(timezone.utc)
    if now.tzinfo is None:
        now = now.replace(tzinfo=timezone.utc)
    midnight = now.astimezone(timezone.utc).replace(hour=0, minute=0, second=0, microsecond=0)
    start = midnight - timedelta(days=1 + offset_days)
    return start, start + timedelta(seconds=86399)
