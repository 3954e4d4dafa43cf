"""The observation record and the check that a table carries its columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

MEASURES = ("speed", "density", "temperature", "bx", "by", "bz", "bt")
REQUIRED_COLUMNS = ("time_tag", *MEASURES)

OBSERVATION = T.StructType(
    [T.StructField("time_tag", T.StringType())]
    + [T.StructField(name, T.DoubleType()) for name in MEASURES]
)

SNAPSHOT = T.StructType(
    [
        T.StructField("time_tag", T.StringType()),
        T.StructField("current_speed", T.DoubleType()),
        T.StructField("rolling_avg_speed", T.DoubleType()),
        T.StructField("rolling_min_speed", T.DoubleType()),
        T.StructField("rolling_max_speed", T.DoubleType()),
        T.StructField("window_avg_speed", T.DoubleType()),
        T.StructField("window_avg_density", T.DoubleType()),
        T.StructField("window_avg_bt", T.DoubleType()),
        T.StructField("disturbance_score", T.IntegerType()),
        T.StructField("risk_band", T.StringType()),
        T.StructField("window_size", T.LongType()),
    ]
)


def validate_columns(df: DataFrame) -> DataFrame:
    """Return ``df`` unchanged, or raise ``ValueError`` naming every missing column."""
    missing = sorted(set(REQUIRED_COLUMNS).difference(df.columns))
    if missing:
        raise ValueError(f"observations lack required columns: {', '.join(missing)}")
    return df
