"""Structured Streaming jobs."""

from .archive import archive_batch, decode_records, start_archive
from .events import parse_events, rejected_events, score_events
from .produce import once_per_batch, start_produce
from .serving import start_serving_merge
from .snapshots import compact_snapshots, upsert_snapshots
from .trailing import start_rolling_snapshots
from .windows import start_speed_windows, stream_speed_windows

__all__ = [
    "archive_batch",
    "compact_snapshots",
    "decode_records",
    "once_per_batch",
    "parse_events",
    "rejected_events",
    "score_events",
    "start_archive",
    "start_produce",
    "start_rolling_snapshots",
    "start_serving_merge",
    "start_speed_windows",
    "stream_speed_windows",
    "upsert_snapshots",
]
