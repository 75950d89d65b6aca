"""What varies between datasets and deployments, as frozen dataclasses."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from siltstone.operators.checks import Check
from siltstone.operators.routing import Rule

# Metadata columns stamped on every ingested row.
INGESTED_AT = "_ingestion_timestamp"
SOURCE_FILE = "_source_file"
BATCH_ID = "_batch_id"
INGEST_METADATA = (INGESTED_AT, SOURCE_FILE, BATCH_ID)
PROCESSED_AT = "_silver_processed_at"


@dataclass(frozen=True)
class GoldColumns:
    """Which column of the clean table plays which role in the summaries."""

    date: str = "pickup_date"
    year: str = "pickup_year"
    month: str = "pickup_month"
    location: str = "pickup_location_id"
    category: str = "payment_type"
    amount: str = "total_amount"
    distance: str = "trip_distance"
    tip: str = "tip_amount"
    passengers: str = "passenger_count"
    labels: Mapping[int, str] = field(default_factory=dict)
    default_label: str = "Other"
    # How locations are ranked: "distributed", or "window" (one task) where their
    # number is bounded by what they are.
    rank_mode: str = "distributed"


@dataclass(frozen=True)
class DatasetSpec:
    """Column-level description of one dataset, from raw file to summaries.

    ``raw_casts`` are applied to raw columns that are present; ``casts`` are
    required of the renamed columns.
    """

    raw_casts: Mapping[str, str]
    renames: Mapping[str, str]
    casts: Mapping[str, str]
    event_time: str
    event_prefix: str
    rules: tuple[Rule, ...]
    dedup_keys: tuple[str, ...]
    checks: tuple[Check, ...]
    gold: GoldColumns
    dedup_order: tuple[str, ...] | None = None


@dataclass(frozen=True)
class Layout:
    """Where the tables of one deployment live (any Hadoop-readable URI)."""

    raw: str
    bronze: str
    ledger: str
    silver: str
    rejects: str
    gold: str
    stream_checkpoint: str
    # Where the stages that write several tables publish them; beside gold by default.
    snapshots: str = ""

    @classmethod
    def under(cls, base: str, raw: str | None = None) -> Layout:
        base = base.rstrip("/")
        return cls(
            raw=raw or f"{base}/raw",
            bronze=f"{base}/bronze/trips",
            ledger=f"{base}/bronze/ledger",
            silver=f"{base}/silver/trips_clean",
            rejects=f"{base}/silver/trips_rejected",
            gold=f"{base}/gold",
            stream_checkpoint=f"{base}/checkpoints/bronze_stream",
            snapshots=f"{base}/snapshots",
        )

    def group(self, stage: str) -> str:
        """The folder in which a stage publishes its tables."""
        return f"{self.snapshots or self.gold + '-snapshots'}/{stage}"

    def gold_table(self, name: str) -> str:
        return f"{self.gold}/{name}"


@dataclass(frozen=True)
class RunConfig:
    """A dataset bound to a layout, with the knobs of a run."""

    spec: DatasetSpec
    layout: Layout
    fmt: str = "parquet"
    glob: str = "*.parquet"
    # A plan names at most this many files, so that its list of paths stays bounded.
    # A batch of more files is written in several steps, all in the same columns; where
    # this is less than the cores, plans run side by side and a step takes several.
    max_files_per_write: int = 10_000
    # Size that stored files of bronze shall have about, however large the raw files are.
    file_bytes: int = 128 << 20
    # Batches that the ledger holds in folders of their own before they are compacted.
    ledger_batches: int = 1_000
    # Whether files may bring columns that the stored table does not have.
    evolve: bool = False
    # "executors" reads footers with pyarrow in parallel; "spark" asks Spark to
    # infer each file's schema, for filesystems only Hadoop can reach.
    footer_reader: str = "executors"
    # Columns to lay the clean table out by; empty means unpartitioned.
    silver_partition_by: tuple[str, ...] = ()
