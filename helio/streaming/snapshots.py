"""The log of live snapshots: a folder for each day, and in it one for each batch that wrote to it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import snapshot_key
from ..operators.serving import newest_per_key
from ..schema import SNAPSHOT
from ..sources.layout import spark_uri
from ..sources.readers import read_snapshot_log, snapshot_days

#: Letters of a key that make its day. Keys are ordered by them first, whatever form their times have.
DAY_LETTERS = 10


def _write(rows: DataFrame, path: str, order: tuple[str, ...]) -> None:
    day = F.substring(snapshot_key(F.col("time_tag")), 1, DAY_LETTERS)
    newest = newest_per_key(rows, order, "batch_id").drop("key").withColumn("day", day)
    # busy days are split over tasks, quiet ones share one
    dealt = newest.select(*SNAPSHOT.fieldNames(), "day", "batch_id").hint("rebalance", "day")
    writer = dealt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("day", "batch_id").parquet(spark_uri(path))


def upsert_snapshots(
    updates: DataFrame, path: str, batch_id: int, order: tuple[str, ...] = ()
) -> None:
    """Add a batch of snapshots, one per key; the newest batch wins when the log is read.

    Nothing written by other batches is rewritten, and a repeated batch replaces its own folders.
    Within a batch the newest by ``order`` is kept.
    """
    _write(updates.withColumn("batch_id", F.lit(batch_id).cast("bigint")), path, order)


def compact_snapshots(spark: SparkSession, path: str, before: str | None = None) -> list[str]:
    """Keep one version of each key in the days before ``before`` (all without it); returns the days rewritten.

    A day's newest versions are written in place of its newest batch. Its older batches go after that, so a
    run that is lost in between leaves versions that readers pass over.
    """
    log = read_snapshot_log(spark, path)
    folders = snapshot_days(log)
    days = sorted(d for d, batches in folders.items() if len(batches) > 1 and (before is None or d < before))
    if not days:
        return []
    newest = F.create_map(*[F.lit(x) for d in days for x in (d, max(folders[d]))])
    versions = newest_per_key(log.where(F.col("day").isin(days)), ("batch_id",), "day").withColumn("batch_id", newest[F.col("day")])
    _write(versions.drop("day", "key"), path, ())
    files = spark._jvm.org.apache.hadoop.fs.Path
    for day in days:
        for batch in sorted(folders[day])[:-1]:
            folder = files(f"{spark_uri(path).rstrip('/')}/day={day}/batch_id={batch}")
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
    return days
