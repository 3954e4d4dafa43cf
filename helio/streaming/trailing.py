"""Trailing-window snapshots over a stream.

The series has no key. Time is cut into panes of some windows' length, and Spark's state store keeps for
each pane the ticks that the windows ending in it can reach: its own, and those of the last window of the pane before.
A record is sent to its pane, and to the next one if it can be seen from there. A micro-batch visits
the panes of its records only, and computes the windows of its records only. A pane's state is
dropped by an event-time timer, once records of the pane would be refused as late.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..functions import parse_event_time
from ..operators.once import computed_once
from ..operators.trailing import MICROS, as_snapshots, window_seconds
from ..sources.layout import spark_uri
from .windows import DEFAULT_DELAY

Sink = Callable[[DataFrame, int], None]

#: Seconds that a record's time may be ahead of its arrival; one beyond that has a wrong clock.
DEFAULT_LEAD = 86_400
#: Windows of a pane. With fewer a task holds less at a time, and more records are sent to two panes.
PANE_WINDOWS = 12
#: Tasks that refused records, which belong to no pane, are spread over.
REFUSED_SLOTS = 64
#: Seconds that the watermark's column runs ahead of a record's time: more than records are late.
AHEAD = 100 * 365 * 86_400
NO_DATA_BATCHES = "spark.sql.streaming.noDataMicroBatches.enabled"

TICK = np.dtype([("us", "<i8"), ("n", "<i8"), ("speed", "<f8"), ("density", "<f8"), ("bt", "<f8"), ("lo", "<f8"), ("hi", "<f8")])
STATE = T.StructType([T.StructField("ticks", T.BinaryType())])
FOUND = """time_tag string, speed double, density double, bt double, reason string,
    w_n bigint, w_speed double, w_density double, w_bt double, w_lo double, w_hi double"""


def merged_ticks(ticks: np.ndarray) -> np.ndarray:
    """One entry for each time, in order."""
    ticks = ticks[np.argsort(ticks["us"], kind="stable")]
    first = np.flatnonzero(np.diff(ticks["us"], prepend=ticks["us"][:1] - 1))
    out = np.empty(len(first), dtype=TICK)
    out["us"] = ticks["us"][first]
    for name in ("n", "speed", "density", "bt"):
        out[name] = np.add.reduceat(ticks[name], first)
    out["lo"], out["hi"] = np.minimum.reduceat(ticks["lo"], first), np.maximum.reduceat(ticks["hi"], first)
    return out


def _best(values: np.ndarray, lo: np.ndarray, hi: np.ndarray, pick: np.ufunc) -> np.ndarray:
    """``pick`` over each range ``[lo, hi)``, from two overlapping ranges of a power of two."""
    levels, size = [values], 1
    while 2 * size <= (hi - lo).max():
        levels.append(pick(levels[-1][:-size], levels[-1][size:]))
        size *= 2
    level = np.log2(hi - lo).astype(np.int64)
    out = np.empty(len(lo))
    for k, own in enumerate(levels):
        at = np.flatnonzero(level == k)
        out[at] = pick(own[lo[at]], own[hi[at] - (1 << k)])
    return out


def window_stats(ticks: np.ndarray, us: np.ndarray, span: int) -> dict[str, np.ndarray]:
    """The totals of the merged ``ticks`` in ``[us - span, us]``; each ``us`` is the time of a tick."""
    lo, hi = np.searchsorted(ticks["us"], us - span), np.searchsorted(ticks["us"], us, "right")
    out = {}
    for name in ("n", "speed", "density", "bt"):
        # wide sums, so that differences of them keep all digits of a window's total
        sums = np.concatenate(([0], np.cumsum(ticks[name], dtype=np.int64 if name == "n" else np.longdouble)))
        out[f"w_{name}"] = (sums[hi] - sums[lo]).astype(ticks[name].dtype)
    out["w_lo"] = _best(ticks["lo"], lo, hi, np.minimum)
    out["w_hi"] = _best(ticks["hi"], lo, hi, np.maximum)
    return out


def _as_ticks(frame: pd.DataFrame) -> np.ndarray:
    out = np.empty(len(frame), dtype=TICK)
    out["n"] = 1
    for name in ("us", "speed", "density", "bt"):
        out[name] = frame[name].to_numpy()
    out["lo"] = out["hi"] = out["speed"]
    return merged_ticks(out) if len(out) else out


def _advance(span: int, width: int):
    """Takes in what a pane is sent, and gives the windows of the pane's own new records."""
    given, totals = ("time_tag", "speed", "density", "bt"), ("n", "speed", "density", "bt", "lo", "hi")

    def refused(frame: pd.DataFrame, reason: object) -> pd.DataFrame:
        return pd.DataFrame({**{c: frame[c] for c in given}, "reason": reason, **{f"w_{c}": None for c in totals}})

    def advance(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        if pd.isna(key[0]):
            for frame in frames:
                yield refused(frame, frame["reason"])
            return
        floor = state.getCurrentWatermarkMs()
        oldest = floor * 1000 if floor > 0 else -(1 << 62)
        ticks = [np.frombuffer(state.get[0], dtype=TICK)] if state.exists else []
        news = []
        for frame in frames:
            late = frame["us"].to_numpy() < oldest
            own = frame["own"].to_numpy()
            if late.any():
                yield refused(frame[late & own], "late")
                frame, own = frame[~late], own[~late]
            ticks.append(_as_ticks(frame))
            news.append(frame if own.all() else frame[own])
        kept = merged_ticks(np.concatenate(ticks))
        if not len(kept):
            return
        state.update((kept.tobytes(),))
        state.setTimeoutTimestamp(max(-(-(int(key[0]) + 1) * width // 1000), floor + 1))
        for frame in news:
            if len(frame):
                stats = window_stats(kept, frame["us"].to_numpy(), span)
                yield pd.DataFrame({**{c: frame[c].to_numpy() for c in given}, "reason": None, **stats})

    return advance


def trailing_stream(df: DataFrame, minutes: int = 5, delay: int = DEFAULT_DELAY, lead: int | None = DEFAULT_LEAD) -> DataFrame:
    """Each record of a stream with the totals of its window, or with the reason why it has none."""
    span = window_seconds(minutes) * MICROS
    width = span * PANE_WINDOWS
    dtype = df.schema["time_tag"].dataType
    rows = df.select(F.col("time_tag").cast("string"), *[F.col(c).cast("double").alias(c) for c in ("speed", "density", "bt")], F.col("time_tag").alias("at"))
    rows = computed_once(rows, "us", F.unix_micros(parse_event_time(F.col("at"), dtype))).drop("at")
    missing = F.col("speed").isNull() | F.col("density").isNull() | F.col("bt").isNull()
    reason = F.when(missing, "measure").when(F.col("us").isNull(), "time")
    if lead is not None:
        reason = reason.when(F.col("us") > F.unix_micros(F.current_timestamp()) + lead * MICROS, "ahead")
    rows = computed_once(rows, "reason", reason)
    # Only usable records move the watermark. Its column runs ahead and its delay is longer by as much, so that
    # no record is dropped unseen: the state function compares times with the watermark and says which are late.
    ahead = F.when(F.col("reason").isNull(), F.timestamp_micros(F.col("us") + AHEAD * MICROS))
    timed = rows.withColumn("ahead", ahead).withWatermark("ahead", f"{delay + AHEAD} seconds")
    within = F.pmod("us", F.lit(width))
    pane = ((F.col("us") - within) / width).cast("bigint")
    own = F.struct(pane.alias("pane"), F.lit(True).alias("own"))
    seen = F.struct((pane + 1).alias("pane"), F.lit(False).alias("own"))
    nowhere = F.struct(F.lit(None).cast("bigint").alias("pane"), F.lit(True).alias("own"))
    places = F.when(F.col("reason").isNotNull(), F.array(nowhere)).when(within >= width - span, F.array(own, seen)).otherwise(F.array(own))
    sent = timed.select("*", F.inline(places)).withColumn("us", F.coalesce("us", F.lit(0)))
    slot = F.when(F.col("pane").isNull(), F.pmod(F.xxhash64("time_tag", "speed", "density", "bt"), F.lit(REFUSED_SLOTS))).otherwise(0)
    keyed = sent.withColumn("slot", slot).groupBy("pane", "slot")
    return keyed.applyInPandasWithState(_advance(span, width), FOUND, STATE, "append", GroupStateTimeout.EventTimeTimeout)


def start_rolling_snapshots(
    df: DataFrame,
    sink: Sink,
    checkpoint: str,
    minutes: int = 5,
    delay: int = DEFAULT_DELAY,
    lead: int | None = DEFAULT_LEAD,
    rejects: Sink | None = None,
    **trigger,
) -> StreamingQuery:
    """Give ``sink`` a snapshot per record, micro-batch by micro-batch.

    A record's window holds what has arrived up to its batch with a time in
    ``[t - W, t]``. Records more than ``delay`` seconds older than the newest of earlier
    batches, in whole milliseconds, are left out, as their window may have been forgotten. So are records more than
    ``lead`` seconds ahead of their arrival, which would make all others late. ``rejects`` is given
    both, and those without a readable time or a measure, with the reason.
    """
    spark = df.sparkSession

    def hand_over(found: DataFrame, batch_id: int) -> None:
        # both sinks need the batch; its state is computed once
        found = found.persist() if rejects else found
        try:
            if rejects:
                rejects(found.where(F.col("reason").isNotNull()).select("time_tag", "speed", "density", "bt", "reason"), batch_id)
            sink(as_snapshots(found.where(F.col("reason").isNull())), batch_id)
        finally:
            if rejects:
                found.unpersist()

    found = trailing_stream(df, minutes, delay, lead)
    writer = found.writeStream.foreachBatch(hand_over).outputMode("append").option("checkpointLocation", spark_uri(checkpoint))
    # a batch without data would only drop old panes, which the next batch does as well
    before = spark.conf.get(NO_DATA_BATCHES, "true")
    spark.conf.set(NO_DATA_BATCHES, "false")
    try:
        return (writer.trigger(**trigger) if trigger else writer).start()
    finally:
        spark.conf.set(NO_DATA_BATCHES, before)
