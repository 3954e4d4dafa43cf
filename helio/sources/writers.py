"""Writing documents, tables and events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .layout import spark_uri


def write_table(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(spark_uri(path))


def write_document(df: DataFrame, path: str) -> None:
    """A one-row table as one JSON file; absent values are written as null."""
    writer = df.coalesce(1).write.mode("overwrite").option("ignoreNullFields", False)
    writer.json(spark_uri(path))


def emit_events(df: DataFrame, key: str = "time_tag") -> DataFrame:
    """Records as key and JSON text, the form key/value sinks take.

    A ``key`` that is no column falls back to the time.
    """
    name = key if key in df.columns else "time_tag"
    body = F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"})
    return df.select(F.col(name).cast("string").alias("key"), body.alias("value"))


def write_json_lines(df: DataFrame, path: str) -> None:
    emit_events(df).select("value").write.mode("append").text(spark_uri(path))


def publish(df: DataFrame, fmt: str, key: str = "time_tag", **options: str) -> None:
    """Send records to a key/value sink such as Kafka; the connector does the sending."""
    emit_events(df, key).write.format(fmt).options(**options).mode("append").save()
