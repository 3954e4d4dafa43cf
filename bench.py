"""Time the headline queries; prints one JSON line.

Each query is run once to warm up and then ``RUNS`` times; the median counts. Session
start is left out. The second part sets the operators against the plain way of doing
the same work on the same data.
"""

from __future__ import annotations

import json
import os
import statistics
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from helio.functions import disturbance_score
from helio.operators import aggregates as agg
from helio.operators.clean import clean_observations, prepare_observations, with_event_time
from helio.operators.serving import latest_snapshots
from helio.operators.trailing import rolling_snapshot
from helio.operators.windows import SPECS, speed_windows
from helio.plans.catalogue import QUERIES, write_snapshot_log
from helio.plans.obs import iso_text, observations
from helio.session import configure, shared_path
from helio.sources import read_observations, read_snapshot_log

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "2"))

HEADLINE = [
    "benchmark_stats",
    "daily_speed",
    "monthly_speed",
    "hourly_speed",
    "storm_events",
    "disturbance_breakdown",
    "summary",
    "correlations",
    "percentiles",
    "percentiles_exact",
    "speed_windows",
    "speed_windows_stream",
    "rolling_snapshot",
    "rolling_snapshot_stream",
    "normalize_rows",
    "normalize_payloads",
    "parse_events",
    "latest_snapshots",
    "serving_view",
    "roundtrip_outputs",
]


def run(build: Callable[[], DataFrame | None]) -> float:
    def once() -> float:
        start = time.perf_counter()
        df = build()
        if df is not None:
            df.write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    once()
    return round(statistics.median(once() for _ in range(RUNS)), 4)


def comparisons(spark: SparkSession) -> dict[str, Callable[[], DataFrame | None]]:
    obs = observations(spark, SF_DIR)
    csv = shared_path(spark, "bench-csv")
    table = shared_path(spark, "bench-parquet")
    obs.withColumn("time_tag", iso_text()).write.option("header", True).csv(csv)
    obs.write.parquet(table)
    stored = spark.read.parquet(table)
    prepared = prepare_observations(stored)
    live = with_event_time(stored, "event_ts").withColumn(
        "disturbance_score", disturbance_score("stream")
    )

    def separate_actions() -> None:
        for x, y in agg.PAIRS.values():
            prepared.stat.corr(x, y)
        prepared.approxQuantile("speed", list(agg.PERCENTILES.values()), agg.RANK_ERROR)
        prepared.agg(F.avg("speed"), F.avg("density"), F.avg("bt")).collect()
        prepared.count()
        prepared.agg(F.max("speed")).collect()
        prepared.agg(F.min("speed")).collect()

    @F.udf("int")
    def score_row(speed, density, bt):
        def points(value, *bounds):
            return next((p for bound, p in zip(bounds, (5, 4, 3), strict=True) if value >= bound), 1)

        return points(speed, 700, 600, 500) + points(density, 10, 9, 8) + points(bt, 8, 7, 6)

    def window_union() -> DataFrame:
        parts = [
            live.groupBy(F.window("event_ts", f"{s.length} seconds", f"{s.slide} seconds"))
            .agg(
                F.avg("speed"),
                F.min("speed"),
                F.max("speed"),
                F.avg("density"),
                F.avg("disturbance_score"),
                F.stddev_pop("speed"),
            )
            .withColumn("window_label", F.lit(s.label))
            for s in SPECS
        ]
        return parts[0].unionByName(parts[1]).unionByName(parts[2])

    def one_window(minutes: int) -> DataFrame:
        rows = stored.dropna(subset=["speed", "density", "bt"])
        frame = W.orderBy(F.unix_micros("time_tag")).rangeBetween(-minutes * 60_000_000, 0)
        return rows.select(
            F.avg("speed").over(frame),
            F.min("speed").over(frame),
            F.max("speed").over(frame),
            F.avg("density").over(frame),
            F.avg("bt").over(frame),
            F.count("*").over(frame),
        )

    cleaned = clean_observations(stored)
    log = write_snapshot_log(spark, SF_DIR)
    return {
        "stats_csv": lambda: agg.benchmark_stats(read_observations(spark, csv)),
        "stats_csv_inferred": lambda: agg.benchmark_stats(
            spark.read.csv(csv, header=True, inferSchema=True)
        ),
        "stats_parquet": lambda: agg.benchmark_stats(stored),
        "statistics_fused": lambda: agg.statistics(prepared),
        "statistics_separate": separate_actions,
        "score_builtin": lambda: cleaned.select(disturbance_score()),
        "score_python_udf": lambda: cleaned.select(score_row("speed", "density", "bt")),
        "windows_panes": lambda: speed_windows(live),
        "windows_union": window_union,
        "latest_from_written_log": lambda: latest_snapshots(read_snapshot_log(spark, log)),
        "rolling_5m_panes": lambda: rolling_snapshot(stored),
        "rolling_5m_one_task": lambda: one_window(5),
        "rolling_1h_panes": lambda: rolling_snapshot(stored, minutes=60),
        "rolling_1h_one_task": lambda: one_window(60),
    }


def main() -> None:
    spark = configure(
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("helio-bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = {name: run(lambda q=QUERIES[name]: q(spark, SF_DIR)) for name in HEADLINE}
    compared = {name: run(build) for name, build in comparisons(spark).items()}
    rows = observations(spark, SF_DIR).count()
    print(
        json.dumps(
            {
                "metric": "headline queries, total of medians",
                "value": round(sum(queries.values()), 3),
                "unit": "sec",
                "queries": queries,
                "comparisons": compared,
                "rows_per_sec_stream_windows": round(rows / queries["speed_windows_stream"]),
                "rows": rows,
                "sf": SF_DIR.rstrip("/").rpartition("sf")[2],
                "cpus": int(CPUS),
                "runs": RUNS,
                "spark": spark.version,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
