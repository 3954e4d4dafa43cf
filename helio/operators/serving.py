"""Serving views: batch documents joined with the newest live snapshots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import rounded, snapshot_key
from ..schema import SNAPSHOT
from ..sources.readers import snapshot_days

SNAPSHOT_LIMIT = 50
DISPLAY_COLUMNS = (
    "time_tag",
    "current_speed",
    "rolling_avg_speed",
    "disturbance_score",
    "risk_band",
)


def _document(df: DataFrame, *fields: str) -> Column:
    """Fields of a one-row document as a scalar; more than one row is an error."""
    return df.select(F.struct(*fields)).scalar()


def newest_per_key(snapshots: DataFrame, order: tuple[str, ...], *more: str) -> DataFrame:
    """One snapshot per key, the newest by ``order``, with the columns ``more``; combines before it shuffles.

    Rows that tie on ``order`` are told apart by their content.
    """
    fields = [*SNAPSHOT.fieldNames(), *more]
    newest = F.max_by(F.struct(*fields), F.struct(*order, *fields)).alias("s")
    keyed = snapshots.withColumn("key", snapshot_key(F.col("time_tag")))
    return keyed.groupBy("key").agg(newest).select("key", "s.*")


def _newest_days(log: DataFrame, n: int) -> DataFrame:
    """The part of a log by days that holds its ``n`` highest keys.

    Days are opened from the newest on, twice as many each time, until they hold ``n`` keys. Which days there
    are is known from the names of files; of a day that is not opened nothing is read.
    """
    days = sorted(snapshot_days(log), reverse=True)
    taken = 1
    while taken < len(days):
        opened = log.where(F.col("day").isin(days[:taken]))
        if opened.select(snapshot_key(F.col("time_tag")).alias("key")).distinct().limit(n).count() >= n:
            return opened
        taken *= 2
    return log


def latest_snapshots(
    log: DataFrame, n: int = SNAPSHOT_LIMIT, order: tuple[str, ...] = ("batch_id",)
) -> DataFrame:
    """The ``n`` snapshots with the highest keys, in ascending key order.

    The keys are picked first, so only versions of those ``n`` keys are compared. A log that has
    its days (``read_snapshot_log``) is read from the newest day on as far as needed.
    """
    if "day" in log.columns:
        log = _newest_days(log, n)
    keyed = log.withColumn("key", snapshot_key(F.col("time_tag")))
    top = keyed.select("key").distinct().orderBy(F.desc("key")).limit(n)
    # top holds n keys at most
    wanted = keyed.join(F.broadcast(top), "key", "left_semi")
    return newest_per_key(wanted, order).orderBy("key").drop("key")


def display_rows(snapshots: DataFrame, n: int = 10) -> DataFrame:
    """Last ``n`` rows of the snapshots for a table on screen."""
    keyed = snapshots.select(snapshot_key(F.col("time_tag")).alias("key"), *DISPLAY_COLUMNS)
    return keyed.orderBy(F.desc("key")).limit(n).orderBy("key").drop("key")


def live_series(snapshots: DataFrame) -> DataFrame:
    """Current and rolling average speed over time."""
    return snapshots.select(
        F.try_to_timestamp("time_tag").alias("time_tag"), "current_speed", "rolling_avg_speed"
    )


def serving_merge(live: DataFrame, summary: DataFrame, percentiles: DataFrame) -> DataFrame:
    """Live snapshots with the historical average and upper percentiles beside them."""
    ranks = _document(percentiles, "p95", "p99")
    return live.select(
        "time_tag",
        "current_speed",
        "rolling_avg_speed",
        _document(summary, "avg_speed")["avg_speed"].alias("historical_avg_speed"),
        ranks["p95"].alias("historical_p95_speed"),
        ranks["p99"].alias("historical_p99_speed"),
        "disturbance_score",
        "risk_band",
    )


def serving_view(snapshots: DataFrame, summary: DataFrame, percentiles: DataFrame) -> DataFrame:
    """The newest snapshot against history, with its gap to the average speed."""
    keyed = snapshots.withColumn("key", snapshot_key(F.col("time_tag")))
    newest = keyed.orderBy(F.desc("key")).limit(1)
    average = _document(summary, "avg_speed")["avg_speed"]
    return newest.select(
        average.alias("historical_avg_speed"),
        _document(percentiles, "p95")["p95"].alias("historical_p95_speed"),
        F.col("current_speed").alias("latest_current_speed"),
        F.col("rolling_avg_speed").alias("latest_rolling_avg_speed"),
        F.col("disturbance_score").alias("latest_disturbance_score"),
        F.col("risk_band").alias("latest_risk_band"),
        rounded(F.col("current_speed") - average).alias("freshness_gap"),
    )


def overview(summary: DataFrame, percentiles: DataFrame) -> DataFrame:
    """Headline figures of the batch layer."""
    return summary.select(
        "record_count",
        "avg_speed",
        "max_speed",
        "min_speed",
        "avg_disturbance_score",
        _document(percentiles, "p95")["p95"].alias("p95_speed"),
    )


def daily_series(daily: DataFrame) -> DataFrame:
    """Daily average speed by date."""
    return daily.select(F.make_date("year", "month", "day").alias("date"), "daily_avg_speed")
