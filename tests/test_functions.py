from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from helio.functions import (
    coerce_float,
    disturbance_score,
    parse_event_time,
    risk_band,
    rounded,
    snapshot_key,
    to_event_time,
)
from helio.schema import validate_columns
from tests.samples import sample


def column(spark, values, dtype="string"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {dtype}")


def evaluate(df, expression):
    return [row[0] for row in df.orderBy("i").select(expression).collect()]


@pytest.mark.parametrize(
    ("kind", "measure", "values", "points"),
    [
        ("batch", "speed", [499.9, 500.0, 599.9, 600.0, 699.9, 700.0], [1, 3, 3, 4, 4, 5]),
        ("batch", "density", [7.0, 7.9, 8.0, 9.0, 10.0], [1, 1, 3, 4, 5]),
        ("batch", "bt", [5.9, 6.0, 7.0, 8.0], [1, 3, 4, 5]),
        ("stream", "speed", [449.9, 450.0, 499.9, 500.0, 600.0, 700.0], [1, 2, 2, 3, 4, 5]),
        ("stream", "density", [6.9, 7.0, 8.0, 9.0, 10.0], [1, 2, 3, 4, 5]),
        ("stream", "bt", [4.9, 5.0, 6.0, 7.0, 8.0, None], [1, 2, 3, 4, 5, 1]),
    ],
)
def test_score_edges(spark, kind, measure, values, points):
    measures = {name: "0D" for name in ("speed", "density", "bt")}
    measures[measure] = "v"
    found = evaluate(column(spark, values, "double"), disturbance_score(kind, **measures))
    assert found == [p + 2 for p in points]


def test_band_edges(spark):
    scores = column(spark, [3, 6, 7, 9, 10, 12, 13, 15], "int")
    assert evaluate(scores, risk_band("v")) == [
        *["baseline"] * 2, *["elevated"] * 2, *["high"] * 2, *["extreme"] * 2
    ]


def test_coerce_float(spark):
    texts = [" 1.5 ", "", "abc", "inf", None, "1_000", "1__0", "1.5d", "0x1p3", "-2e3", ".5", "7.", "\t3\n"]
    found = evaluate(column(spark, texts), coerce_float(F.col("v")))
    assert found == [1.5, 0.0, 0.0, float("inf"), 0.0, 1000.0, 0.0, 0.0, 0.0, -2000.0, 0.5, 7.0, 3.0]


def test_rounded_ignores_summation_noise(spark):
    values = [400.0025, 400.00249999999994, 400.00250000000005, 2.0005, None]
    assert evaluate(column(spark, values, "double"), rounded(F.col("v"))) == [
        400.003, 400.003, 400.003, 2.001, None
    ]


def test_parse_event_time_texts(spark):
    cases = {
        "2026-07-25T10:00:00Z": datetime(2026, 7, 25, 10),
        "2026-07-25T10:00:00+05:30": datetime(2026, 7, 25, 4, 30),
        "2026-07-25 10:00:00": datetime(2026, 7, 25, 10),
        " 2026-07-25T10:00:00.25 ": datetime(2026, 7, 25, 10, 0, 0, 250000),
        "2026-07-25T10": datetime(2026, 7, 25, 10),
        "2026-07-25": datetime(2026, 7, 25),
        "20240105T101112": datetime(2024, 1, 5, 10, 11, 12),
        "20240105T101112Z": datetime(2024, 1, 5, 10, 11, 12),
        "20240105T101112+0130": datetime(2024, 1, 5, 8, 41, 12),
        "2024-W01-5": datetime(2024, 1, 5),
        "2020-W53-7": datetime(2021, 1, 3),
        "2021-W53-1": None,
        "2024-1-5 00:00:00": datetime(2024, 1, 5),
        "1700000000": datetime(2023, 11, 14, 22, 13, 20),
        "1700000000123": datetime(2023, 11, 14, 22, 13, 20, 123000),
        "-60": datetime(1969, 12, 31, 23, 59),
        "": None,
        "garbage": None,
        "2026-02-30T00:00:00Z": None,
        "T10:00": None,
        "2026-07": None,
        "99999999999999999999": None,
    }
    found = evaluate(column(spark, list(cases)), parse_event_time(F.col("v")))
    assert found == list(cases.values())


def test_parse_event_time_numbers(spark):
    numbers = column(spark, [1.7e9, 1.7e12, 0.5, None, 1e300], "double")
    found = evaluate(numbers, parse_event_time(F.col("v"), T.DoubleType()))
    second = datetime(2023, 11, 14, 22, 13, 20)
    assert found == [second, second, datetime(1970, 1, 1, 0, 0, 0, 500000), None, None]


def test_to_event_time_is_null_when_malformed(spark):
    texts = column(spark, ["2026-07-25T10:00:00Z", "garbage", None])
    assert evaluate(texts, to_event_time(F.col("v"))) == [datetime(2026, 7, 25, 10), None, None]


def test_snapshot_key(spark):
    assert evaluate(column(spark, ["2026/07/25 10:00"]), snapshot_key(F.col("v"))) == ["2026-07-25 10-00"]
    assert evaluate(column(spark, [17], "bigint"), snapshot_key(F.col("v"))) == ["17"]


def test_validate_columns(spark):
    rows = sample(spark)
    assert validate_columns(rows.withColumn("extra", F.lit(1))).columns[-1] == "extra"
    with pytest.raises(ValueError, match="bt, speed$"):
        validate_columns(rows.drop("speed", "bt"))
