"""Twenty sample observations: two stretches of five-minute steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from helio.schema import OBSERVATION

# Speed, density, bt
FIRST_DAY = [
    (412, 5.8, 4.2), (615, 8.5, 6.8), (642, 8.8, 7.0), (688, 9.4, 7.8), (705, 10.1, 8.5),
    (731, 10.4, 8.9), (690, 9.8, 7.9), (658, 8.9, 7.1), (603, 8.0, 6.2), (556, 7.2, 5.6),
]
SECOND_DAY = [
    (438, 6.1, 4.0), (447, 6.4, 4.1), (455, 6.7, 4.2), (470, 7.0, 4.4), (485, 7.4, 4.8),
    (502, 7.9, 5.1), (518, 8.2, 5.4), (540, 8.7, 5.7), (575, 9.1, 6.1), (620, 9.6, 6.7),
]


def sample_rows() -> list[tuple]:
    days = (("2026-07-25T10", FIRST_DAY), ("2026-07-26T09", SECOND_DAY))
    return [
        (f"{hour}:{5 * i:02d}:00Z", float(speed), density, 1e5, 0.0, 0.0, 0.0, bt)
        for hour, day in days
        for i, (speed, density, bt) in enumerate(day)
    ]


def sample(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(sample_rows(), OBSERVATION)


def record(time_tag, speed=500.0, density=5.0, bt=1.0) -> tuple:
    return (time_tag, speed, density, 1e5, 0.0, 0.0, 0.0, bt)


def records(spark: SparkSession, *rows: tuple) -> DataFrame:
    return spark.createDataFrame([record(*row) for row in rows], OBSERVATION)
