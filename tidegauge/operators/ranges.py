"""Range-vector functions over raw samples, evaluated on a regular step grid.

A sample belongs to every step t with t - range < ts <= t. Samples are folded per series into panes, the greatest
slices of time that both the range and the step are made of. The time axis is cut into chunks of one range, so
a range reaches over the end of one chunk and the beginning of the next: what it holds is a sum from the end of
the one and a sum from the start of the other, both running sums. Nothing is subtracted, nothing is copied more than
once, and the cost does not grow with the number of steps a range spans. A group is one chunk of one series:
at most twice the panes of a range, and the steps in it.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegauge.functions.numbers import floor_div, floor_to, step_at_or_after

MINUTE_MS = 60_000
# Samples whose panes and steps one task sorts and sums, at most on average.
TASK_SAMPLES = 1 << 17


def select_labels(df: DataFrame, labels: dict[str, str], attributes: str = "attributes") -> DataFrame:
    """Rows whose attribute map holds every given label with exactly that value."""
    for key, value in labels.items():
        found = F.try_element_at(F.col(attributes), F.lit(key))
        df = df.filter(F.coalesce(found == value, F.lit(False)))
    return df


def align_to_step(df: DataFrame, step_ms: int, ts: str = "timestamp") -> DataFrame:
    """Timestamps floored to the step of a range query."""
    return df.withColumn(ts, floor_to(F.col(ts), step_ms))


_OWN, _STEP, _PREVIOUS = 0, 1, 2


def _folded(df: DataFrame, series: tuple[str, ...], range_ms: int, step_ms: int, ts: str, *measures: Column) -> DataFrame:
    """One row per series and pane, named by the pane's end."""
    pane = step_at_or_after(F.col(ts), math.gcd(range_ms, step_ms)).alias("_end")
    return df.groupBy(*series, pane).agg(*measures)


def _tasks(samples: DataFrame) -> int:
    """In how many tasks the chunks are summed, so that the memory of a task does not grow with the samples."""
    return max(samples.sparkSession.sparkContext.defaultParallelism, -(-samples.count() // TASK_SAMPLES))


def _in_chunks(panes: DataFrame, range_ms: int) -> DataFrame:
    """Each pane in its own chunk and, at the time it leaves a range that ends there, in the next one."""
    own = floor_div(F.col("_end") - 1, range_ms)
    places = F.array(
        F.struct(own.alias("_chunk"), F.col("_end").alias("_at"), F.lit(_OWN).alias("_role")),
        F.struct((own + 1).alias("_chunk"), (F.col("_end") + range_ms).alias("_at"), F.lit(_PREVIOUS).alias("_role")),
    )
    return panes.withColumn("_p", F.explode(places)).select("*", "_p.*").drop("_p", "_end")


def _at_steps(
    chunked: DataFrame, series: tuple[str, ...], range_ms: int, step_ms: int, own: dict, previous: dict, tasks: int
) -> DataFrame:
    """Steps of all chunks with the sums of ``own`` up to them and of ``previous`` not yet gone.

    Both map names to columns of ``chunked``.
    """
    first = step_at_or_after(F.col("_chunk") * range_ms + 1, step_ms)
    last = (F.col("_chunk") + 1) * range_ms
    steps = F.when(first <= last, F.sequence(first, last, F.lit(step_ms).cast("bigint")))
    chunks = chunked.select(*series, "_chunk").repartition(tasks, *series, "_chunk").distinct()
    asked = chunks.withColumn("_at", F.explode(steps)).withColumn("_role", F.lit(_STEP))
    group = Window.partitionBy(*series, "_chunk")
    so_far = group.orderBy("_at", "_role").rowsBetween(Window.unboundedPreceding, 0)
    to_go = group.orderBy(F.col("_at").desc(), "_role").rowsBetween(Window.unboundedPreceding, 0)
    entries = chunked.unionByName(asked, allowMissingColumns=True).repartition(tasks, *series, "_chunk")
    sums = {n: F.sum(F.when(F.col("_role") == _OWN, c)).over(so_far) for n, c in own.items()}
    sums |= {n: F.sum(F.when(F.col("_role") == _PREVIOUS, c)).over(to_go) for n, c in previous.items()}
    return entries.withColumns(sums).filter(F.col("_role") == _STEP)


def _sum_of(*names: str) -> Column:
    """Sum of columns, of which some may be NULL; NULL if all are."""
    total = F.coalesce(F.col(names[0]), F.lit(0))
    for name in names[1:]:
        total = total + F.coalesce(F.col(name), F.lit(0))
    return F.when(F.coalesce(*names).isNotNull(), total)


def _over_panes(
    panes: DataFrame, series: tuple[str, ...], range_ms: int, step_ms: int, names: list[str], tasks: int
) -> DataFrame:
    """The sums of the range at every step that sees a pane: (series, _at, names)."""
    counted = panes.withColumn("_panes", F.lit(1))
    every = [*names, "_panes"]
    own, previous = ({f"{side}{n}": F.col(n) for n in every} for side in ("_o", "_p"))
    seen = _at_steps(_in_chunks(counted, range_ms), series, range_ms, step_ms, own, previous, tasks)
    seen = seen.filter(_sum_of("_o_panes", "_p_panes") > 0)
    return seen.select(*series, "_at", *[_sum_of(f"_o{n}", f"_p{n}").alias(n) for n in names])


def avg_over_time(
    samples: DataFrame,
    series: tuple[str, ...],
    range_ms: int = MINUTE_MS,
    step_ms: int = MINUTE_MS,
    ts: str = "timestamp",
    value: str = "value",
) -> DataFrame:
    """Mean of the samples in the range, per series and step."""
    panes = _folded(samples, series, range_ms, step_ms, ts, F.sum(value).alias("_sum"), F.count(value).alias("_n"))
    seen = _over_panes(panes, series, range_ms, step_ms, ["_sum", "_n"], _tasks(samples))
    mean = F.when(F.col("_n") > 0, F.col("_sum") / F.col("_n"))
    return seen.select(*series, F.col("_at").alias(ts), mean.alias(value))


def count_over_time(
    lines: DataFrame,
    series: tuple[str, ...],
    contains: str | None = None,
    range_ms: int = MINUTE_MS,
    step_ms: int = MINUTE_MS,
    ts: str = "timestamp",
    line: str = "line",
) -> DataFrame:
    """How many lines (holding a text) the range saw, per series and step."""
    wanted = lines if contains is None else lines.filter(F.contains(line, F.lit(contains)))
    panes = _folded(wanted, series, range_ms, step_ms, ts, F.count(F.lit(1)).alias("_n"))
    seen = _over_panes(panes, series, range_ms, step_ms, ["_n"], _tasks(wanted))
    return seen.select(*series, F.col("_at").alias(ts), F.col("_n").alias("value"))


def rate(
    samples: DataFrame,
    series: tuple[str, ...],
    range_ms: int = MINUTE_MS,
    step_ms: int = MINUTE_MS,
    ts: str = "timestamp",
    value: str = "value",
) -> DataFrame:
    """Increase per second of a counter, per series and step with two samples in the range.

    A drop counts as a restart from 0. The increase is not stretched to the edges of the range.
    Samples of one timestamp count as rising, so they are folded to their lowest and highest value
    first. A pane keeps its first and last value and the growth inside; panes are chained within a chunk, from
    its start and from its end, and the two chains of a range are tied where the chunks meet. So a range never
    looks at its samples, and restarts need no offsets.
    """
    moments = (
        samples.filter(F.col(value).isNotNull())
        .groupBy(*series, ts)
        .agg(F.min(value).alias("_low"), F.max(value).alias("_high"), F.count(value).alias("_n"))
        .withColumn("_end", step_at_or_after(F.col(ts), math.gcd(range_ms, step_ms)))
    )

    def step(before: Column, after: Column) -> Column:
        return F.when(after >= before, after - before).otherwise(F.when(before.isNotNull(), after))

    inside = Window.partitionBy(*series, "_end").orderBy(ts)
    grown = F.col("_high") - F.col("_low") + F.coalesce(step(F.lag("_high").over(inside), F.col("_low")), F.lit(0.0))
    panes = moments.withColumn("_grown", grown).groupBy(*series, "_end").agg(
        F.min_by("_low", ts).alias("_first"), F.max_by("_high", ts).alias("_last"), F.sum("_grown").alias("_grown"), F.sum("_n").alias("_n")
    )
    tasks = _tasks(samples)
    chunked = _in_chunks(panes, range_ms).repartition(tasks, *series, "_chunk")
    side = Window.partitionBy(*series, "_chunk", "_role").orderBy("_at")
    whole = Window.partitionBy(*series, "_chunk")
    own, previous = F.col("_role") == _OWN, F.col("_role") == _PREVIOUS
    end = F.max_by(F.when(previous, F.col("_last")), F.when(previous, F.col("_at"))).over(whole)
    start = F.min_by(F.when(own, F.col("_first")), F.when(own, F.col("_at"))).over(whole)
    linked = chunked.withColumns(
        {
            "_behind": F.col("_grown") + F.coalesce(step(F.lag("_last").over(side), F.col("_first")), F.lit(0.0)),
            "_ahead": F.col("_grown") + F.coalesce(step(F.col("_last"), F.lead("_first").over(side)), F.lit(0.0)),
            # what ties the chunks stands at the first own pane
            "_tie": F.when(own & F.lag("_at").over(side).isNull(), step(end, start)),
        }
    )
    sums = {"_o_grown": F.col("_behind"), "_o_n": F.col("_n"), "_o_tie": F.col("_tie")}
    seen = _at_steps(linked, series, range_ms, step_ms, sums, {"_p_grown": F.col("_ahead"), "_p_n": F.col("_n")}, tasks)
    tie = F.when(F.col("_p_n") > 0, F.coalesce(F.col("_o_tie"), F.lit(0.0))).otherwise(F.lit(0.0))
    increase = (_sum_of("_o_grown", "_p_grown") + tie) / (range_ms / 1000)
    return seen.filter(_sum_of("_o_n", "_p_n") > 1).select(*series, F.col("_at").alias(ts), increase.alias(value))


def sum_by_step(
    df: DataFrame, by: tuple[str, ...] = (), ts: str = "timestamp", value: str = "value"
) -> DataFrame:
    """Sum across series at each step."""
    return df.groupBy(*by, ts).agg(F.sum(value).alias(value))
