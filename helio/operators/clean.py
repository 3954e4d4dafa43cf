"""Cleaning, event time, calendar and score columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import disturbance_score, risk_band, to_event_time
from ..schema import validate_columns
from .once import computed_once


def clean_observations(df: DataFrame) -> DataFrame:
    """Keep rows with a time, positive speed and density, and a non-negative field.

    The comparisons reach the scan as pushed filters; ``dropna`` also removes NaN.
    """
    return (
        df.where(F.col("time_tag").isNotNull())
        .where((F.col("speed") > 0) & (F.col("density") > 0) & (F.col("bt") >= 0))
        .dropna(subset=["speed", "density", "bt"])
    )


def with_event_time(df: DataFrame, target: str = "timestamp") -> DataFrame:
    dtype = df.schema["time_tag"].dataType
    value = to_event_time(F.col("time_tag"), dtype)
    if isinstance(dtype, T.StringType):
        return computed_once(df, target, value)
    return df.withColumn(target, value)


def with_calendar(df: DataFrame, source: str = "timestamp") -> DataFrame:
    return df.withColumns(
        {
            "year": F.year(source),
            "month": F.month(source),
            "day": F.dayofmonth(source),
            "hour": F.hour(source),
        }
    )


def with_score(df: DataFrame, kind: str = "batch") -> DataFrame:
    scored = df.withColumn("disturbance_score", disturbance_score(kind))
    return scored.withColumn("risk_band", risk_band())


def prepare_observations(df: DataFrame) -> DataFrame:
    """Batch rows ready for the tables: checked, cleaned, dated and scored."""
    dated = with_event_time(clean_observations(validate_columns(df)))
    return with_score(with_calendar(dated.where(F.col("timestamp").isNotNull())))


def rejected_observations(df: DataFrame) -> DataFrame:
    """Rows that pass cleaning but whose time cannot be read."""
    dated = with_event_time(clean_observations(validate_columns(df)))
    return dated.where(F.col("timestamp").isNull()).select(*df.columns)
