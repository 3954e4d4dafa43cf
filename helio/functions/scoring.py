"""Disturbance score and risk band as built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values: (lower bound, points), highest bound first; below the last bound a measure scores 1.
BATCH_LEVELS = {
    "speed": ((700.0, 5), (600.0, 4), (500.0, 3)),
    "density": ((10.0, 5), (9.0, 4), (8.0, 3)),
    "bt": ((8.0, 5), (7.0, 4), (6.0, 3)),
}
STREAM_LEVELS = {
    "speed": ((700.0, 5), (600.0, 4), (500.0, 3), (450.0, 2)),
    "density": ((10.0, 5), (9.0, 4), (8.0, 3), (7.0, 2)),
    "bt": ((8.0, 5), (7.0, 4), (6.0, 3), (5.0, 2)),
}
# Fixed values: (lowest total score, band); any lower score is the base band.
BANDS = ((13, "extreme"), (10, "high"), (7, "elevated"))
BASE_BAND = "baseline"

LEVELS = {"batch": BATCH_LEVELS, "stream": STREAM_LEVELS}
STORM_SPEED = BATCH_LEVELS["speed"][0][0]


def _case(value: str, steps, otherwise: str) -> str:
    whens = " ".join(f"WHEN {value} >= {bound} THEN {result}" for bound, result in steps)
    return f"CASE {whens} ELSE {otherwise} END"


def disturbance_score(
    kind: str = "batch", speed: str = "speed", density: str = "density", bt: str = "bt"
) -> Column:
    """Sum of the points of the three measures; a null measure scores 1.

    ``kind`` picks the scale: ``batch`` (four steps) or ``stream`` (five steps).
    """
    columns = {"speed": speed, "density": density, "bt": bt}
    return F.expr(
        " + ".join(
            _case(columns[name], [(f"{bound}D", points) for bound, points in steps], "1")
            for name, steps in LEVELS[kind].items()
        )
    )


def risk_band(score: str = "disturbance_score") -> Column:
    return F.expr(_case(score, [(bound, f"'{band}'") for bound, band in BANDS], f"'{BASE_BAND}'"))
