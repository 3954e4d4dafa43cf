"""Archive of raw stream records as JSON lines by arrival time."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..sources.layout import spark_uri

PARTITIONS = ("year", "month", "day", "hour")
#: Records of a file at most, and the innermost folder, by the second of arrival.
FILE_RECORDS, SECOND = 100, "second"
FORMATS = {"year": "yyyy", "month": "MM", "day": "dd", "hour": "HH", SECOND: "HHmmss"}


def decode_records(df: DataFrame, data: str = "data", arrival: str = "arrival_ts") -> DataFrame:
    """Base64 records as text lines with the calendar columns of their arrival.

    An archive keeps everything: what is no base64 stays as it came, null as an empty line.
    """
    text = F.try_to_binary(F.col(data), F.lit("base64")).cast("string")
    return df.select(
        F.coalesce(text, F.col(data).cast("string"), F.lit("")).alias("value"),
        *[F.date_format(arrival, form).alias(name) for name, form in FORMATS.items()],
    )


def archive_batch(df: DataFrame, path: str, **names: str) -> None:
    """Archive records already at hand; busy hours are split and quiet ones share a task."""
    lines = decode_records(df, **names).hint("rebalance", *PARTITIONS)
    writer = lines.write.mode("append").option("maxRecordsPerFile", FILE_RECORDS)
    writer.partitionBy(*FORMATS).text(spark_uri(path))


def start_archive(
    df: DataFrame, path: str, checkpoint: str, names: dict[str, str] | None = None, **trigger
) -> StreamingQuery:
    """Append records to hourly folders, and in them to one for each second of arrival with files of some records.

    Records are dealt to tasks by their folder, so that folders are written side by side and each
    by one task, whatever the files of the source. A batch without records writes nothing.
    """
    writer = (
        decode_records(df, **(names or {}))
        .repartition(*FORMATS)
        .writeStream.format("text")
        .outputMode("append")
        .partitionBy(*FORMATS)
        .option("maxRecordsPerFile", FILE_RECORDS)
        .option("path", spark_uri(path))
        .option("checkpointLocation", spark_uri(checkpoint))
    )
    return (writer.trigger(**trigger) if trigger else writer).start()
