"""Batch tables and one-row statistics over prepared observations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import STORM_SPEED, rounded
from .ordering import globally_sorted

# The reported percentiles of speed and the rank error they may have.
PERCENTILES = {"p25": 0.25, "p50": 0.5, "p75": 0.75, "p90": 0.9, "p95": 0.95, "p99": 0.99}
RANK_ERROR = 0.01
# The reported correlations.
PAIRS = {
    "speed_density": ("speed", "density"),
    "speed_bt": ("speed", "bt"),
    "density_bt": ("density", "bt"),
}
STORM_COLUMNS = ("timestamp", "speed", "density", "bt", "disturbance_score", "risk_band")

ROLLUP_KEYS = ("year", "month", "day", "hour", "risk_band")
ROLLED = {"speed": "speed", "density": "density", "disturbance": "disturbance_score"}


def rollup(df: DataFrame) -> DataFrame:
    """Counts and sums per hour and band: at most 96 rows a day, however dense the data.

    The daily, monthly, hourly and per-band tables can all be read off it, so a run that
    writes all four aggregates the observations once.
    """
    return df.groupBy(*ROLLUP_KEYS).agg(
        F.count("*").alias("n"),
        *[F.sum(source).alias(f"sum_{name}") for name, source in ROLLED.items()],
    )


def _means(df: DataFrame, keys: tuple[str, ...], names: dict[str, str]) -> DataFrame:
    """Group means from raw observations or from their rollup."""
    if "sum_speed" in df.columns:
        total = F.sum("n")
        means = {name: F.sum(f"sum_{name}") / total for name in names}
    else:
        total = F.count("*")
        means = {name: F.avg(ROLLED[name]) for name in names}
    return df.groupBy(*keys).agg(
        total.alias("event_count"), *[means[name].alias(alias) for name, alias in names.items()]
    )


def _calendar_table(df: DataFrame, keys: tuple[str, ...], prefix: str) -> DataFrame:
    names = {name: f"{prefix}_avg_{name}" for name in ROLLED}
    return _means(df, keys, names).drop("event_count").orderBy(*keys)


def daily_speed(df: DataFrame) -> DataFrame:
    return _calendar_table(df, ("year", "month", "day"), "daily")


def monthly_speed(df: DataFrame) -> DataFrame:
    return _calendar_table(df, ("year", "month"), "monthly")


def hourly_speed(df: DataFrame) -> DataFrame:
    """Profile of the 24 hours of the day over all days."""
    return _calendar_table(df, ("hour",), "hourly")


def disturbance_breakdown(df: DataFrame) -> DataFrame:
    names = {"speed": "avg_speed", "density": "avg_density"}
    return _means(df, ("risk_band",), names).orderBy("risk_band")


def storm_events(df: DataFrame) -> DataFrame:
    storms = df.where(F.col("speed") >= STORM_SPEED).select(*STORM_COLUMNS)
    return globally_sorted(storms, "timestamp")


def _summary_columns() -> list[Column]:
    averages = {
        "avg_speed": "speed",
        "avg_density": "density",
        "avg_bt": "bt",
        "avg_disturbance_score": "disturbance_score",
    }
    return [
        F.count("*").alias("record_count"),
        *[rounded(F.avg(source)).alias(name) for name, source in averages.items()],
        F.max("speed").alias("max_speed"),
        F.min("speed").alias("min_speed"),
    ]


def _correlation_columns() -> list[Column]:
    # corr() divides by zero on a constant column under ANSI mode; this form gives null
    return [
        F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y)).alias(name)
        for name, (x, y) in PAIRS.items()
    ]


def _percentile_columns(accuracy: int) -> list[Column]:
    probabilities = F.array(*[F.lit(p) for p in PERCENTILES.values()])
    found = F.approx_percentile("speed", probabilities, accuracy)
    return [F.get(found, F.lit(i)).alias(name) for i, name in enumerate(PERCENTILES)]


def summary(df: DataFrame) -> DataFrame:
    return df.agg(*_summary_columns())


def correlations(df: DataFrame) -> DataFrame:
    """Pearson correlation of the three pairs; null where a column is constant."""
    return df.agg(*_correlation_columns())


def percentiles(df: DataFrame, rank_error: float = RANK_ERROR) -> DataFrame:
    """Approximate percentiles of speed; each value's rank is off by ``rank_error`` at most."""
    return df.agg(*_percentile_columns(round(1 / rank_error)))


def statistics(df: DataFrame) -> DataFrame:
    """Summary, correlations and percentiles as three structs of one row, from one scan."""
    flat = df.agg(
        *_summary_columns(), *_correlation_columns(), *_percentile_columns(round(1 / RANK_ERROR))
    )
    first = flat.columns.index(next(iter(PAIRS)))
    return flat.select(
        F.struct(*flat.columns[:first]).alias("summary"),
        F.struct(*PAIRS).alias("correlations"),
        F.struct(*PERCENTILES).alias("percentiles"),
    )


def benchmark_stats(df: DataFrame) -> DataFrame:
    return df.agg(
        F.count("*").alias("records"),
        rounded(F.avg("speed")).alias("avg_speed"),
        F.max("speed").alias("max_speed"),
    )
