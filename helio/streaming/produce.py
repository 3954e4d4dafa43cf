"""Payloads as they arrive, normalised and handed on as keyed records."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.normalize import normalize_payloads, rejected_payloads
from ..sources.layout import spark_uri
from ..sources.writers import emit_events

Sink = Callable[[DataFrame, int], None]
ARRIVAL_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"


def once_per_batch(path: str, fmt: str = "json") -> Sink:
    """A sink that writes each micro-batch to a folder of its own, so that a repeated one replaces itself."""
    return lambda rows, batch_id: rows.write.format(fmt).mode("overwrite").save(f"{spark_uri(path).rstrip('/')}/batch_id={batch_id}")


def start_produce(
    raw: DataFrame,
    sink: Sink,
    checkpoint: str,
    payload: str = "value",
    key: str = "time_tag",
    arrival: str | None = None,
    rejects: Sink | None = None,
    keep: tuple[str, ...] = (),
    **trigger,
) -> StreamingQuery:
    """Give ``sink`` the records of each micro-batch of payloads as key and JSON text, ``rejects`` what cannot be read.

    Both get the micro-batch's number; a sink that keeps to it (``once_per_batch``) has each record once
    however often a micro-batch is repeated. The time of a payload without one is that of ``arrival``, or of the
    micro-batch. ``keep`` names columns that stand beside rejected payloads.
    """

    def hand_on(batch: DataFrame, batch_id: int) -> None:
        named = batch if arrival else batch.withColumn("arrival", F.date_format(F.current_timestamp(), ARRIVAL_FORMAT))
        # both sinks need the batch; its source is read once
        named = named.persist() if rejects else named
        try:
            if rejects:
                rejects(rejected_payloads(named, payload, keep), batch_id)
            sink(emit_events(normalize_payloads(named, payload, arrival or "arrival"), key), batch_id)
        finally:
            if rejects:
                named.unpersist()

    writer = raw.writeStream.foreachBatch(hand_on).option("checkpointLocation", spark_uri(checkpoint))
    return (writer.trigger(**trigger) if trigger else writer).start()
