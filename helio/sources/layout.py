"""Names of everything a run writes, used by writers and readers alike."""

from __future__ import annotations

from dataclasses import dataclass

# Output tables and documents of the batch layer, and the live folder.
TABLES = ("daily_speed", "monthly_speed", "hourly_speed", "storm_events", "disturbance_breakdown")
DOCUMENTS = ("summary", "percentiles", "correlations")
BATCH_FOLDER = "batch"
LIVE_FOLDER = "speed/live"


def spark_uri(uri: str) -> str:
    """The address Spark's S3 connector wants for an ``s3://`` one; others are kept."""
    scheme, mark, rest = uri.partition("://")
    return f"s3a://{rest}" if mark and scheme == "s3" else uri


@dataclass(frozen=True)
class OutputLayout:
    """Paths below one batch output folder."""

    base: str

    @property
    def root(self) -> str:
        return spark_uri(self.base).rstrip("/")

    def table(self, name: str) -> str:
        if name not in TABLES:
            raise ValueError(f"unknown table {name!r}")
        return f"{self.root}/{name}"

    def document(self, name: str) -> str:
        if name not in DOCUMENTS:
            raise ValueError(f"unknown document {name!r}")
        return f"{self.root}/{name}.json"

    @property
    def rejects(self) -> str:
        return f"{self.root}/rejects"

    @property
    def snapshots(self) -> str:
        """The live folder lies beside a folder named ``batch``, else inside the base."""
        parent, _, last = self.root.rpartition("/")
        return f"{parent if last == BATCH_FOLDER else self.root}/{LIVE_FOLDER}"
