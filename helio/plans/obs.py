"""Observations derived from the ``events`` test table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def as_observations(rows: DataFrame) -> DataFrame:
    """Events as solar-wind records, with some missing and some impossible measures."""
    parsed = rows.select("*", F.expr("cast(get_json_object(props, '$.k') as int) AS k"))
    return parsed.selectExpr(
        "event_id",
        "cast(ts as timestamp) AS time_tag",
        """CASE WHEN event_id % 53 = 0 THEN -1D WHEN event_id % 59 = 0 THEN NULL
           ELSE 300D + 4D * value END AS speed""",
        "k / 8D AS density",
        "100000D + 1000D * k AS temperature",
        "-(event_id % 7) / 2D AS bx",
        "(event_id % 11) / 2D AS by",
        "(event_id % 13 - 6) / 2D AS bz",
        """CASE WHEN event_id % 41 = 0 THEN NULL WHEN event_id % 43 = 0 THEN -0.5D
           ELSE (user_id % 100) / 10D END AS bt""",
    )


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_observations(events(spark, sf_dir))


def iso_text(column: str = "time_tag"):
    return F.date_format(column, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
