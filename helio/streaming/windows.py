"""Tumbling and sliding windows over a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.windows import SPECS, WINDOW_COLUMNS, WindowSpec, windows_of
from ..sources.layout import spark_uri

DEFAULT_DELAY = 600


def stream_speed_windows(
    df: DataFrame, specs: tuple[WindowSpec, ...] = SPECS, delay: int = DEFAULT_DELAY
) -> DataFrame:
    """All window sizes as one aggregation, so the source is read once.

    Every record is copied to the windows holding it and these are grouped by window;
    a union of one aggregation per size would read the source, and keep state, three
    times. The watermark runs on the window ends: a window closes once the latest end
    seen is ``delay`` seconds plus the longest window ahead of its own. A record that
    comes later than that is dropped from the closed windows only.
    """
    longest = max(spec.length for spec in specs)
    second = F.unix_seconds("event_ts")
    placed = (
        df.where(F.col("event_ts").isNotNull())
        .select("speed", "density", "disturbance_score", F.inline(windows_of(second, specs)))
        .withColumn("end", F.timestamp_seconds("end"))
        .withWatermark("end", f"{delay + longest} seconds")
    )
    grouped = placed.groupBy("window_label", "start", "end").agg(
        F.avg("speed").alias("rolling_avg_speed"),
        F.min("speed").alias("rolling_min_speed"),
        F.max("speed").alias("rolling_max_speed"),
        F.avg("density").alias("rolling_avg_density"),
        F.avg("disturbance_score").alias("rolling_avg_disturbance"),
        F.stddev_pop("speed").alias("speed_volatility"),
    )
    window = F.struct(F.timestamp_seconds("start").alias("start"), F.col("end").alias("end"))
    return grouped.withColumn("window", window).select(*WINDOW_COLUMNS)


def start_speed_windows(
    windows: DataFrame, path: str, checkpoint: str, **trigger
) -> StreamingQuery:
    """Append closed windows to parquet; a restart goes on from ``checkpoint``."""
    writer = (
        windows.writeStream.format("parquet")
        .outputMode("append")
        .option("path", spark_uri(path))
        .option("checkpointLocation", spark_uri(checkpoint))
    )
    return (writer.trigger(**trigger) if trigger else writer).start()
