"""Readers, writers and the names of outputs."""

from .layout import OutputLayout, spark_uri
from .readers import (
    read_document,
    read_observations,
    read_output,
    read_snapshot_log,
    read_snapshots,
    stream_files,
    stream_observations,
)
from .writers import emit_events, publish, write_document, write_json_lines, write_table

__all__ = [
    "OutputLayout",
    "emit_events",
    "publish",
    "read_document",
    "read_observations",
    "read_output",
    "read_snapshot_log",
    "read_snapshots",
    "spark_uri",
    "stream_files",
    "stream_observations",
    "write_document",
    "write_json_lines",
    "write_table",
]
