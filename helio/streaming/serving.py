"""Live snapshots beside the historical figures, which the batch layer replaces while the stream runs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..operators.serving import serving_merge
from ..sources.layout import OutputLayout, spark_uri
from ..sources.readers import read_document_if_present

#: The fields of the two documents that a merge takes.
SUMMARY, PERCENTILES = "avg_speed double", "p95 double, p99 double"


def _document(spark: SparkSession, path: str, schema: str) -> DataFrame:
    found = read_document_if_present(spark, path, schema)
    # a document that is not there yet has no figures: a merge then has nulls
    return spark.createDataFrame([], schema) if found is None else found


def start_serving_merge(
    snapshots: DataFrame,
    base: str,
    sink: Callable[[DataFrame, int], None],
    checkpoint: str,
    **trigger,
) -> StreamingQuery:
    """Give ``sink`` the snapshots of each micro-batch with the figures of the documents below ``base``.

    The documents are read anew for each micro-batch: what a batch run has replaced shows from the
    next one on.
    """
    layout, spark = OutputLayout(base), snapshots.sparkSession

    def merge(batch: DataFrame, batch_id: int) -> None:
        summary = _document(spark, layout.document("summary"), SUMMARY)
        percentiles = _document(spark, layout.document("percentiles"), PERCENTILES)
        sink(serving_merge(batch, summary, percentiles), batch_id)

    writer = snapshots.writeStream.foreachBatch(merge).option("checkpointLocation", spark_uri(checkpoint))
    return (writer.trigger(**trigger) if trigger else writer).start()
