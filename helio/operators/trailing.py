"""Trailing window ``[t - W, t]`` per record, without a partition key and without hot tasks.

A window function over the whole series would run in one task, and one bucket per
stretch of time would overload the task of a busy stretch. Here the records are first
aggregated per distinct time (a *tick*), and the window of a tick is put together from

* the ticks of its own pane up to it,
* the whole panes between, and
* the ticks of the oldest pane from ``t - W`` on,

where panes are a fixed fraction of ``W``. Within a pane both ends are running
aggregates. A pane holds no more ticks than it has microseconds, whatever the number of
records, and records of one time meet their tick in a salted join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import WindowSpec

from ..functions import disturbance_score, parse_event_time, risk_band, rounded
from ..schema import SNAPSHOT
from .once import computed_once

MICROS = 1_000_000
MIN_SECONDS = 60
PANES_PER_WINDOW = 60
PANES_PER_BLOCK = 1024
# a running window's blocks of time, and how many of them make a group: all years that times can have
# make a million groups
RUN_BLOCK = 60 * MICROS
BLOCKS_PER_GROUP = 4096
# a time is hot from this many records on, and from this share of all records on;
# the second bound keeps the broadcast list of hot times below HOT_SHARE entries
HOT_ROWS = 1_000_000
HOT_SHARE = 10_000

MERGE = {
    "n": F.sum,
    "speed": F.sum,
    "density": F.sum,
    "bt": F.sum,
    "lo": F.min,
    "hi": F.max,
}


def window_seconds(minutes: int) -> int:
    return max(MIN_SECONDS, minutes * 60)


def live_rows(df: DataFrame) -> DataFrame:
    """The columns a trailing window needs, with the time in microseconds as ``us``."""
    dtype = df.schema["time_tag"].dataType
    us = F.unix_micros(parse_event_time(F.col("time_tag"), dtype))
    rows = df.select("time_tag", "speed", "density", "bt").where(
        "speed is not null and density is not null and bt is not null"
    )
    if isinstance(dtype, T.StringType):
        rows = computed_once(rows, "us", us)
    else:
        rows = rows.withColumn("us", us)
    return rows.where(F.col("us").isNotNull())


def ticks_of(rows: DataFrame) -> DataFrame:
    """One row per distinct time; many records of one time are combined before the shuffle."""
    return rows.groupBy("us").agg(
        F.count("*").alias("n"),
        F.sum("speed").alias("speed"),
        F.sum("density").alias("density"),
        F.sum("bt").alias("bt"),
        F.min("speed").alias("lo"),
        F.max("speed").alias("hi"),
    )


def _pane(us: Column, width: int) -> Column:
    return us - F.pmod(us, F.lit(width))


def _whole_panes(ticks: DataFrame, span: int, width: int) -> DataFrame:
    """For every pane, the aggregate of the panes strictly inside its records' windows."""
    block = width * PANES_PER_BLOCK
    panes = ticks.groupBy(_pane(F.col("us"), width).alias("pane")).agg(
        *[merge(name).alias(name) for name, merge in MERGE.items()]
    )
    # a pane is copied to the next block too when windows there reach back to it
    copies = F.sequence(
        F.floor(F.col("pane") / block), F.floor((F.col("pane") + (span - width)) / block)
    )
    before = W.partitionBy("block").orderBy("pane").rangeBetween(-(span - width), -width)
    return (
        panes.withColumn("block", F.explode(copies))
        .select(
            "pane",
            "block",
            *[merge(name).over(before).alias(f"mid_{name}") for name, merge in MERGE.items()],
        )
        .where(F.col("block") == F.floor(F.col("pane") / block))
        .drop("block")
    )


def trailing_stats(ticks: DataFrame, span: int) -> DataFrame:
    """Per tick ``us``: the aggregates of all ticks in ``[us - span, us]`` (microseconds)."""
    width = span // PANES_PER_WINDOW
    own = F.struct(
        F.col("us").alias("at"), F.col("us").alias("tick"), *[F.col(c).alias(c) for c in MERGE]
    )
    probe = F.struct(
        (F.col("us") - span).alias("at"),
        F.col("us").alias("tick"),
        *[F.lit(None).cast(ticks.schema[c].dataType).alias(c) for c in MERGE],
    )
    placed = ticks.select(F.inline(F.array(own, probe))).withColumn(
        "pane", _pane(F.col("at"), width)
    )
    is_own = F.col("at") == F.col("tick")
    up_to = W.partitionBy("pane").orderBy("at").rangeBetween(W.unboundedPreceding, 0)
    from_on = W.partitionBy("pane").orderBy(F.desc("at")).rangeBetween(W.unboundedPreceding, 0)
    ends = placed.select(
        "pane",
        "tick",
        is_own.alias("is_own"),
        *[merge(name).over(up_to).alias(f"head_{name}") for name, merge in MERGE.items()],
        *[merge(name).over(from_on).alias(f"tail_{name}") for name, merge in MERGE.items()],
    )
    parts = ends.join(_whole_panes(ticks, span, width), "pane", "left")

    def combined(name: str) -> Column:
        # a tick's own row carries its head and the middle, its probe row the tail
        merge = MERGE[name]
        head = F.when(F.col("is_own"), F.col(f"head_{name}")).otherwise(F.col(f"tail_{name}"))
        middle = F.when(F.col("is_own"), F.col(f"mid_{name}"))
        if merge is F.sum:
            return F.sum(F.coalesce(head, F.lit(0)) + F.coalesce(middle, F.lit(0)))
        pick = F.least if merge is F.min else F.greatest
        return merge(pick(head, middle))

    return parts.groupBy(F.col("tick").alias("us")).agg(
        *[combined(name).alias(f"w_{name}") for name in MERGE]
    )


def attach_stats(rows: DataFrame, ticks: DataFrame, stats: DataFrame) -> DataFrame:
    """Join every record to the window of its time, splitting times with very many records."""
    limit = F.greatest(F.lit(HOT_ROWS), F.ceil(F.sum("n") / HOT_SHARE))
    bound = ticks.agg(limit.alias("bound")).scalar()
    hot = (
        ticks.select("us", "n")
        .where(F.col("n") > bound)
        .select("us", F.ceil(F.col("n") / bound).alias("salts"))
    )
    salts = F.coalesce(F.col("salts"), F.lit(1))
    # content and input partition only, so that a retried task salts its rows alike
    pick = F.xxhash64(F.spark_partition_id(), "time_tag", "speed", "density", "bt")
    salted_rows = rows.join(F.broadcast(hot), "us", "left").select(
        *rows.columns, F.pmod(pick, salts).alias("salt")
    )
    salted_stats = stats.join(F.broadcast(hot), "us", "left").select(
        *stats.columns, F.explode(F.sequence(F.lit(0).cast("bigint"), salts - 1)).alias("salt")
    )
    return salted_rows.join(salted_stats, ["us", "salt"]).drop("salt")


def as_snapshots(joined: DataFrame) -> DataFrame:
    means = {name: rounded(F.col(f"w_{name}") / F.col("w_n")) for name in ("speed", "density", "bt")}
    scored = joined.select(
        F.col("time_tag").cast("string").alias("time_tag"),
        F.col("speed").alias("current_speed"),
        means["speed"].alias("rolling_avg_speed"),
        F.col("w_lo").alias("rolling_min_speed"),
        F.col("w_hi").alias("rolling_max_speed"),
        means["speed"].alias("window_avg_speed"),
        means["density"].alias("window_avg_density"),
        means["bt"].alias("window_avg_bt"),
        F.col("w_n").alias("window_size"),
    )
    # the rounded averages are scored, on the batch scale
    score = disturbance_score("batch", "window_avg_speed", "window_avg_density", "window_avg_bt")
    return (
        scored.withColumn("disturbance_score", score)
        .withColumn("risk_band", risk_band())
        .select(*SNAPSHOT.fieldNames())
    )


def rolling_snapshot(df: DataFrame, minutes: int = 5) -> DataFrame:
    """One snapshot per record over the records of the last ``minutes`` (both ends included).

    Records of the same time see each other. Records without a readable time or with a
    missing measure give no snapshot.
    """
    rows = live_rows(df)
    ticks = ticks_of(rows)
    stats = trailing_stats(ticks, window_seconds(minutes) * MICROS)
    return as_snapshots(attach_stats(rows, ticks, stats))


def running_stats(ticks: DataFrame) -> DataFrame:
    """Per tick ``us``: the aggregates of all ticks up to it, by a scan in three levels.

    Ticks run within their block of time, blocks within their group of blocks, and groups, a row
    each, over all: no task holds more than a block's ticks, a group's blocks, or the groups.
    """
    block = _pane(F.col("us"), RUN_BLOCK)
    group = F.floor(F.col("block") / (RUN_BLOCK * BLOCKS_PER_GROUP))
    totals = [merge(name).alias(name) for name, merge in MERGE.items()]
    blocks = ticks.groupBy(block.alias("block")).agg(*totals).withColumn("group", group)
    # a group is some days, so all groups are fewer rows than a block has ticks
    groups = blocks.groupBy("group").agg(*totals)

    def before(level: str, window: WindowSpec) -> list[Column]:
        frame = window.rowsBetween(W.unboundedPreceding, -1)
        return [merge(name).over(frame).alias(f"{level}_{name}") for name, merge in MERGE.items()]

    earlier_groups = groups.select("group", *before("g", W.orderBy("group")))
    earlier_blocks = blocks.select("block", "group", *before("b", W.partitionBy("group").orderBy("block")))
    starts = earlier_blocks.join(F.broadcast(earlier_groups), "group").drop("group")
    up_to = W.partitionBy("block").orderBy("us").rowsBetween(W.unboundedPreceding, 0)
    inside = ticks.withColumn("block", block).select("us", "block", *[merge(name).over(up_to).alias(f"t_{name}") for name, merge in MERGE.items()])

    def combined(name: str) -> Column:
        parts = [F.col(f"{level}_{name}") for level in "tbg"]
        if MERGE[name] is F.sum:
            return parts[0] + F.coalesce(parts[1], F.lit(0)) + F.coalesce(parts[2], F.lit(0))
        return (F.least if MERGE[name] is F.min else F.greatest)(*parts)

    return inside.join(starts, "block").select("us", *[combined(name).alias(f"w_{name}") for name in MERGE])


def running_snapshot(df: DataFrame) -> DataFrame:
    """One snapshot per record over all records up to its time: a window that never evicts."""
    rows = live_rows(df)
    ticks = ticks_of(rows)
    return as_snapshots(attach_stats(rows, ticks, running_stats(ticks)))
