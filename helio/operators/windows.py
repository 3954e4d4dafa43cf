"""Tumbling and sliding event-time windows over bounded data."""

from __future__ import annotations

from math import gcd
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class WindowSpec(NamedTuple):
    label: str
    length: int
    slide: int


# Label, length and slide in seconds; each length is a multiple of its slide.
ONE_MINUTE = WindowSpec("1 minute", 60, 60)
FIVE_MINUTES = WindowSpec("5 minutes", 300, 60)
FIFTEEN_MINUTES = WindowSpec("15 minutes", 900, 300)
SPECS = (ONE_MINUTE, FIVE_MINUTES, FIFTEEN_MINUTES)

# Spread is summed around this speed, in km/s. Any value gives the same result; one near
# the data leaves the most digits.
TYPICAL_SPEED = 500.0

WINDOW_COLUMNS = (
    "window",
    "rolling_avg_speed",
    "rolling_min_speed",
    "rolling_max_speed",
    "rolling_avg_density",
    "rolling_avg_disturbance",
    "speed_volatility",
    "window_label",
)


def windows_of(second: Column, specs: tuple[WindowSpec, ...]) -> Column:
    """Array of (window_label, start, end) for every window holding ``second``."""
    return F.array(
        *[
            F.struct(
                F.lit(spec.label).alias("window_label"),
                (start := second - F.pmod(second, F.lit(spec.slide)) - back).alias("start"),
                (start + spec.length).alias("end"),
            )
            for spec in specs
            for back in range(0, spec.length, spec.slide)
        ]
    )


def _panes(df: DataFrame, width: int) -> DataFrame:
    second = F.unix_seconds("event_ts")
    return (
        df.where(F.col("event_ts").isNotNull())
        .groupBy((second - F.pmod(second, F.lit(width))).alias("pane"))
        .agg(
            F.count("speed").alias("n"),
            F.avg("speed").alias("mean"),
            (F.var_pop("speed") * F.count("speed")).alias("m2"),
            F.min("speed").alias("lo"),
            F.max("speed").alias("hi"),
            F.sum("density").alias("density"),
            F.count("density").alias("n_density"),
            F.sum("disturbance_score").alias("score"),
            F.count("disturbance_score").alias("n_score"),
        )
    )


def speed_windows(df: DataFrame, specs: tuple[WindowSpec, ...] = SPECS) -> DataFrame:
    """Per-window speed, density and score figures for all ``specs``, from one scan.

    Every record is aggregated once, into the pane of the windows' common step; only
    panes are copied to the windows they belong to. Spread is merged from the panes'
    squared deviations and the distances of their means from a typical speed, which
    keeps every buffer of fixed size.
    """
    width = gcd(*[value for spec in specs for value in (spec.length, spec.slide)])
    placed = _panes(df, width).select("*", F.inline(windows_of(F.col("pane"), specs)))
    offset = F.col("mean") - TYPICAL_SPEED
    merged = placed.groupBy("window_label", "start", "end").agg(
        F.sum("n").alias("n"),
        F.sum(F.col("n") * F.col("mean")).alias("speed"),
        F.sum(F.col("n") * offset).alias("first"),
        F.sum(F.col("m2") + F.col("n") * offset * offset).alias("second"),
        F.min("lo").alias("rolling_min_speed"),
        F.max("hi").alias("rolling_max_speed"),
        F.try_divide(F.sum("density"), F.sum("n_density")).alias("rolling_avg_density"),
        F.try_divide(F.sum("score"), F.sum("n_score")).alias("rolling_avg_disturbance"),
    )
    shift = F.try_divide(F.col("first"), F.col("n"))
    variance = F.try_divide(F.col("second"), F.col("n")) - shift * shift
    # equal speeds have no spread; what is left of it after rounding must not show
    same = F.col("rolling_min_speed") == F.col("rolling_max_speed")
    spread = F.when(same, 0.0).when(variance < 0, 0.0).otherwise(F.sqrt(variance))
    return (
        merged.withColumn("rolling_avg_speed", F.try_divide(F.col("speed"), F.col("n")))
        .withColumn("speed_volatility", spread)
        .withColumn("window", window_struct())
        .select(*WINDOW_COLUMNS)
    )


def window_struct() -> Column:
    return F.struct(
        F.timestamp_seconds("start").alias("start"), F.timestamp_seconds("end").alias("end")
    )
