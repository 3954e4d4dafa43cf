"""Session settings and the shared folder used for intermediate tables."""

from __future__ import annotations

import tempfile
import threading
import uuid

from pyspark.sql import DataFrame, SparkSession


def configure(spark: SparkSession) -> SparkSession:
    """Pin the settings results depend on; safe to call on a running session."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def build_session(app_name: str) -> SparkSession:
    store = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    builder = SparkSession.builder.appName(app_name)
    builder = builder.config("spark.sql.streaming.stateStore.providerClass", store)
    return configure(builder.getOrCreate())


def shared_path(spark: SparkSession, purpose: str) -> str:
    """A fresh path below the cluster's ``spark.checkpoint.dir``.

    Executors on other machines must see what is written here, so a local temporary
    folder is used only by a local master that names no checkpoint folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="helio-")
    return f"{base.rstrip('/')}/helio/{purpose}-{uuid.uuid4().hex}"


class Written(threading.local):
    """Folders that ``materialize`` wrote and nobody deleted, oldest first, of each thread."""

    def __init__(self) -> None:
        self.paths: list[str] = []


#: So that a caller can delete those nothing reads any more.
WRITTEN = Written()

#: Whether Spark deletes the shuffle files of a query when it ends, and not when the driver happens to collect its garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def materialize(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` once and read it back, so that several consumers share one computation.

    Unlike a cached table the result outlives lost executors. The write's shuffle files go with it.
    """
    spark, path = df.sparkSession, shared_path(df.sparkSession, purpose)
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)
    WRITTEN.paths.append(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, paths: list[str]) -> None:
    """Delete folders that ``materialize`` wrote and that no table still to be read comes from."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for path in paths:
        folder = jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(conf).delete(folder, True)
    WRITTEN.paths = [path for path in WRITTEN.paths if path not in paths]
