"""Global sorts that stay balanced when one key holds many rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TIE_SLOTS = 4096


def globally_sorted(df: DataFrame, *keys: str) -> DataFrame:
    """Sort by ``keys``, letting rows of equal keys spread over several partitions.

    A range exchange cannot cut inside one key. A trailing tie-break gives it somewhere
    to cut; it depends only on the row and its input partition, so a retried task sends
    every row to the same place.
    """
    tie = F.pmod(F.xxhash64(F.spark_partition_id(), *df.columns), F.lit(TIE_SLOTS))
    return df.withColumn("_tie", tie).orderBy(*keys, "_tie").drop("_tie")
