"""Keep a costly expression from being evaluated more than once per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def computed_once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """``df`` with ``value`` as column ``name``, computed here and nowhere else.

    A filter on a projected column is moved below the projection, and the expression
    is then evaluated for the filter and again for the column. The output of a
    generator is a plain column, which filters cannot be moved through.
    """
    return df.select("*", F.explode_outer(F.array(value)).alias(name))
