"""Decoding of stream records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import disturbance_score
from ..operators.clean import clean_observations
from ..schema import OBSERVATION


def parse_events(df: DataFrame, data: str = "data") -> DataFrame:
    """Binary JSON records as observations with ``event_ts`` and ``ingested_at``.

    A record that is no JSON, or whose time cannot be read, has a null ``event_ts``.
    """
    event = F.from_json(F.col(data).cast("string"), OBSERVATION)
    return (
        df.select(event.alias("event"))
        .select("event.*")
        .withColumn("event_ts", F.try_to_timestamp("time_tag"))
        .withColumn("ingested_at", F.current_timestamp())
    )


def rejected_events(df: DataFrame, data: str = "data") -> DataFrame:
    """Raw records ``parse_events`` finds no time in."""
    payload = F.col(data).cast("string")
    time_tag = F.from_json(payload, OBSERVATION)["time_tag"]
    return df.select(payload.alias("payload")).where(F.try_to_timestamp(time_tag).isNull())


def score_events(df: DataFrame, clean: bool = False) -> DataFrame:
    """Add the stream score; rows are taken as they come unless ``clean`` is set."""
    kept = clean_observations(df) if clean else df
    return kept.withColumn("disturbance_score", disturbance_score("stream"))
