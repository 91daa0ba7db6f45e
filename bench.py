"""Time the headline queries; prints one JSON line.

``BENCH_SF_DIR`` (default /root/testdata/sf0.1) and ``BENCH_CPUS`` (default: all cores) choose the
data and the cores. Every query runs once to warm up and then ``BENCH_RUNS`` times (default 3); the
median counts. Results are computed whole and thrown away.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time
from pathlib import Path

from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from tidegauge.operators import decode, merge, rolling  # noqa: E402
from tidegauge.plans import catalogue, tables  # noqa: E402
from tidegauge.plans.decoding import RULES  # noqa: E402

HEADLINES = [
    "training_aggregate",
    "metric_include_filter",
    "allow_rules_join",
    "clean_frame",
    "dedup_last_wins",
    "merge_exact",
    "merge_pivot",
    "resample_first",
    "avg_over_time",
    "rate",
    "lag_rows",
    "rolling_mean",
    "rolling_keyed",
    "rolling_p90",
    "ml_features",
    "sequences",
    "chrono_split",
    "standardize",
    "eval_metrics",
    "response_to_otlp",
    "stream_ingest",
    "stream_training_aggregate",
]


def session(cpus: str) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", cpus if cpus != "*" else "8")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def prepared(spark: SparkSession, sf_dir: str, folder: str) -> dict:
    """Decoding is timed on stored messages, without the cost of making them up."""
    path = f"{folder}/messages"
    tables.otlp_messages(spark, sf_dir).repartition(32).write.parquet(path)
    messages = spark.read.parquet(path)
    return {
        "decode_lake": lambda: decode.flatten_metrics(decode.parse_messages(messages)),
        "decode_stream": lambda: decode.flatten_stream_metrics(decode.parse_messages(messages), RULES),
        "wide_frame": lambda: merge.merge_series(tables.series(spark, sf_dir), tables.WIDE),
        "rolling_statistics": lambda: rolling.rolling_statistics(
            tables.wide(spark, sf_dir), list(tables.WIDE), [rolling.HOUR, rolling.DAY]
        ),
    }


def timed(make) -> float:
    start = time.perf_counter()
    make().write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = session(os.environ.get("BENCH_CPUS", "*"))
    queries = {name: (lambda run=catalogue.QUERIES[name]: run(spark, sf_dir)) for name in HEADLINES}
    queries |= prepared(spark, sf_dir, tempfile.mkdtemp(prefix="bench-"))
    wanted = sys.argv[1:] or list(queries)
    seconds = {}
    for name in wanted:
        timed(queries[name])
        seconds[name] = round(statistics.median(timed(queries[name]) for _ in range(runs)), 3)
        print(f"{name}: {seconds[name]}", file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "headline queries, total of medians",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(sf_dir).name.removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
