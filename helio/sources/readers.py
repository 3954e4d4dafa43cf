"""Reading observations, events and earlier outputs."""

from __future__ import annotations

import re
from collections.abc import Callable
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..schema import OBSERVATION, SNAPSHOT
from .layout import OutputLayout, spark_uri

# Start positions of a stream in the words of its source.
STARTS = {
    "kafka": {"LATEST": ("startingOffsets", "latest"), "TRIM_HORIZON": ("startingOffsets", "earliest")},
    "kinesis": {
        "LATEST": ("initialPosition", "LATEST"),
        "TRIM_HORIZON": ("initialPosition", "TRIM_HORIZON"),
    },
}
SNAPSHOT_FOLDER = re.compile(r"/day=([^/]+)/batch_id=(\d+)/")
STREAM_NAMES = {"kafka": "subscribe", "kinesis": "streamName"}
CSV_OPTIONS = {"header": True, "mode": "PERMISSIVE"}


def _csv_schema(spark: SparkSession, path: str, schema: T.StructType) -> T.StructType:
    """The file's own columns in the file's own order, typed by ``schema``, others as text."""
    header = spark.read.options(header=True).csv(path).columns
    types = {field.name: field.dataType for field in schema}
    return T.StructType([T.StructField(c, types.get(c, T.StringType())) for c in header])


def read_observations(
    spark: SparkSession,
    path: str,
    fmt: str = "csv",
    typed: bool = True,
    corrupt: str | None = None,
) -> DataFrame:
    """Observations from files. CSV types are fixed, not guessed from the content.

    With ``typed=False`` every CSV column stays text, for ``normalize_rows``. ``corrupt`` names a
    column for the whole line where a value of it cannot be read. Files whose header differs from
    the first one's, in names or order, raise an error instead of being read by position.
    """
    uri = spark_uri(path)
    if fmt != "csv":
        return spark.read.format(fmt).load(uri)
    schema = _csv_schema(spark, uri, OBSERVATION if typed else T.StructType([]))
    reader = spark.read.options(**CSV_OPTIONS, enforceSchema=False)
    if corrupt:
        schema = T.StructType([*schema.fields, T.StructField(corrupt, T.StringType())])
        reader = reader.option("columnNameOfCorruptRecord", corrupt)
    return reader.schema(schema).csv(uri)


def stream_files(
    spark: SparkSession,
    path: str,
    fmt: str = "csv",
    schema: T.StructType = OBSERVATION,
    max_files_per_trigger: int | None = None,
    **options: str,
) -> DataFrame:
    """Replay files as a stream; ``max_files_per_trigger`` sets the pace."""
    reader = spark.readStream.format(fmt).schema(schema).options(**options)
    if fmt == "csv":
        reader = reader.options(**CSV_OPTIONS, enforceSchema=False)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(spark_uri(path))


def stream_observations(
    spark: SparkSession,
    fmt: str,
    stream_name: str | None = None,
    start: str = "LATEST",
    **options: str,
) -> DataFrame:
    """A record stream from any connector on the class path, all shards or partitions.

    ``start`` is LATEST or TRIM_HORIZON, put in the words of the connector where known.
    """
    if start not in STARTS["kinesis"]:
        raise ValueError(f"unknown start position {start!r}")
    reader = spark.readStream.format(fmt).options(**options)
    if stream_name is not None:
        reader = reader.option(STREAM_NAMES.get(fmt, "streamName"), stream_name)
    if fmt in STARTS:
        reader = reader.option(*STARTS[fmt][start])
    return reader.load()


def read_document(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """One JSON document, over one line or many."""
    reader = spark.read.option("multiLine", True)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.json(spark_uri(path))


def _if_present(read: Callable[[], DataFrame]) -> DataFrame | None:
    try:
        return read()
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def read_document_if_present(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame | None:
    return _if_present(lambda: read_document(spark, path, schema))


def read_parquet_if_present(spark: SparkSession, path: str) -> DataFrame | None:
    return _if_present(lambda: spark.read.parquet(spark_uri(path)))


def read_output(spark: SparkSession, base: str, table: str) -> DataFrame | None:
    """A batch table written earlier, or None where there is none."""
    return read_parquet_if_present(spark, OutputLayout(base).table(table))


def read_snapshot_log(spark: SparkSession, path: str) -> DataFrame:
    """The log of live snapshots with the ``day`` that holds them, a folder whose files need not be opened."""
    versions = [T.StructField("day", T.StringType()), T.StructField("batch_id", T.LongType())]
    return spark.read.schema(T.StructType([*SNAPSHOT.fields, *versions])).parquet(spark_uri(path))


def read_snapshots(spark: SparkSession, path: str) -> DataFrame:
    """The log of live snapshots; ``batch_id`` tells the versions of a key apart."""
    return read_snapshot_log(spark, path).drop("day")


def snapshot_days(log: DataFrame) -> dict[str, set[int]]:
    """The days of a log and the batches of each, from the names of its files."""
    days: dict[str, set[int]] = {}
    for name in log.inputFiles():
        if found := SNAPSHOT_FOLDER.search(name):
            # names in URIs are escaped once more
            days.setdefault(unquote(unquote(found[1])), set()).add(int(found[2]))
    return days
