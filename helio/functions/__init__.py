"""Column expressions shared by batch and streaming plans."""

from .numbers import coerce_float, rounded
from .scoring import STORM_SPEED, disturbance_score, risk_band
from .times import parse_event_time, snapshot_key, to_event_time

__all__ = [
    "STORM_SPEED",
    "coerce_float",
    "disturbance_score",
    "parse_event_time",
    "risk_band",
    "rounded",
    "snapshot_key",
    "to_event_time",
]
