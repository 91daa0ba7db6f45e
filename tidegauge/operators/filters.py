"""Row filters: include rules, allow rules, log rules and time windows."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.functions.anyvalue import kv_matches, last_match
from tidegauge.functions.calendar import previous_day_range
from tidegauge.functions.numbers import all_of, any_of


def include_predicate(rules: list[dict]) -> Column:
    """OR over rules of exact name AND resource pairs AND point pairs.

    A rule is ``{"name": ..., "resource_attributes": {key: pattern}, "attributes": {...}}``; the
    names also stand alone in front so that the scan can use them.
    """
    names = F.col("__name__").isin(sorted({rule["name"] for rule in rules}))
    matches = [
        (F.col("__name__") == rule["name"])
        & kv_matches(F.col("resource_attributes"), rule.get("resource_attributes") or {})
        & kv_matches(F.col("attributes"), rule.get("attributes") or {})
        for rule in rules
    ]
    return names & any_of(matches)


def include_metrics(df: DataFrame, rules: list[dict]) -> DataFrame:
    """Keep the rows some rule asks for; no rules keep everything."""
    return df.filter(include_predicate(rules)) if rules else df


def allow_predicate(rules: list[dict], namespace: Column, service: Column) -> Column:
    """The first rule of a namespace decides; unknown and missing namespaces are dropped.

    A rule is ``{"service.namespace": ..., "service.name": optional}``. A row without a service
    name passes a rule that names one.
    """
    first: dict[str, str | None] = {}
    for rule in rules:
        first.setdefault(rule["service.namespace"], rule.get("service.name"))
    if not first:
        return F.lit(False)
    named = {ns: name for ns, name in first.items() if name is not None}
    verdict = F.coalesce(namespace.isin(list(first)), F.lit(False))
    for ns, name in named.items():
        verdict = verdict & F.coalesce((namespace != ns) | (service == name), F.lit(True))
    return verdict


def first_rules(rules: DataFrame) -> DataFrame:
    """First rule per namespace of a rule table (service_namespace, service_name, rule_order)."""
    return rules.groupBy("service_namespace").agg(
        F.min_by("service_name", "rule_order").alias("rule_service_name")
    )


def allow_join(df: DataFrame, rules: DataFrame) -> DataFrame:
    """Allow rules from a table instead of a list.

    No broadcast hint: the planner broadcasts the rules while their size allows it and otherwise
    shuffles, splitting hot namespaces at run time.
    """
    joined = df.join(first_rules(rules), "service_namespace", "inner")
    same = F.col("rule_service_name") == F.col("service_name")
    return joined.filter(F.coalesce(same, F.lit(True))).drop("rule_service_name")


def include_logs(df: DataFrame, rules: list[dict]) -> DataFrame:
    """Keep log rows matching some rule on every field the rule sets.

    Fields: ``service_name`` (equal), ``level`` (the attribute ``level``, or else the word in the
    line, in any case), ``contains`` (text within the line).
    """
    if not rules:
        return df

    def match(rule: dict) -> Column:
        tests = []
        if rule.get("service_name") is not None:
            tests.append(F.col("service_name") == rule["service_name"])
        if rule.get("level") is not None:
            level = rule["level"].lower()
            attribute = F.lower(last_match(F.col("attributes"), "level"))
            word = F.lower("line").rlike(rf"(?<![a-z0-9_])\Q{level}\E(?![a-z0-9_])")
            tests.append(F.coalesce(attribute == level, word))
        if rule.get("contains") is not None:
            tests.append(F.contains("line", F.lit(rule["contains"])))
        return F.coalesce(all_of(tests), F.lit(False))

    return df.filter(any_of([match(rule) for rule in rules]))


def _utc(moment: datetime) -> datetime:
    return moment if moment.tzinfo else moment.replace(tzinfo=timezone.utc)


def _instant(moment: datetime) -> Column:
    micros = round((_utc(moment) - datetime(1970, 1, 1, tzinfo=timezone.utc)) / timedelta(microseconds=1))
    return F.timestamp_micros(F.lit(micros).cast("bigint"))


def recent_window(
    df: DataFrame,
    days: int = 7,
    as_of: datetime | None = None,
    ts: str = "timestamp",
    day: str | None = None,
) -> DataFrame:
    """Rows later than ``days`` before ``as_of``.

    With ``day`` (a DATE partition column) the same limit is also put on the partition, since
    plain Parquet cannot infer it from the timestamp.
    """
    start = _utc(as_of or datetime.now(timezone.utc)) - timedelta(days=days)
    kept = df.filter(F.col(ts) > _instant(start))
    if day is not None:
        kept = kept.filter(F.col(day) >= F.lit(start.astimezone(timezone.utc).date()))
    return kept


def previous_day(
    df: DataFrame,
    as_of: datetime | None = None,
    offset_days: int = 0,
    ts: str = "timestamp",
) -> DataFrame:
    """Rows of the UTC day before ``as_of``; both ends belong to the range."""
    start, end = previous_day_range(as_of, offset_days)
    return df.filter(F.col(ts).between(_instant(start), _instant(end)))
