"""The ledger: which files are stored, in which batch, with how many rows.

A batch adds a folder of its own, which is what makes writing it safe, and what makes a
long ledger slow to read. ``compact_ledger`` moves the folders' entries into one table
beside it, cut into few files by name.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.config import BATCH_ID
from siltstone.sources.paths import delete_folder
from siltstone.sources.tables import (
    FOLDER_FORMATS,
    overwrite_table,
    read_batches,
    read_table,
    stored_batches,
    table_exists,
)

LEDGER_SCHEMA = f"file_name string, rows long, {BATCH_ID} string"


def compacted(ledger: str) -> str:
    """Where the entries of compacted batches are."""
    return f"{ledger}_compacted"


def _compacted_batches(spark: SparkSession, ledger: str, fmt: str) -> set[str]:
    path = compacted(ledger)
    if not table_exists(spark, path, fmt):
        return set()
    ids = read_table(spark, path, fmt).select(BATCH_ID).distinct()
    return {row[0] for row in ids.toLocalIterator()}


def recorded_batches(spark: SparkSession, ledger: str, fmt: str = "parquet") -> set[str]:
    """Ids of the batches that have entries, compacted or not."""
    return _compacted_batches(spark, ledger, fmt) | stored_batches(spark, ledger, fmt)


def read_ledger(spark: SparkSession, ledger: str, fmt: str = "parquet") -> DataFrame:
    """All entries: (file_name, rows, ``_batch_id``); none if there is no ledger.

    A folder whose batch has been compacted is not read, as it waits to be deleted.
    """
    columns = ("file_name", F.col("rows").cast("long").alias("rows"), BATCH_ID)
    done = _compacted_batches(spark, ledger, fmt)
    own = stored_batches(spark, ledger, fmt) - done
    parts = []
    if done:
        parts.append(read_table(spark, compacted(ledger), fmt).select(*columns))
    if own:
        parts.append(read_batches(spark, ledger, own, fmt).select(*columns))
    if not parts:
        return spark.createDataFrame([], LEDGER_SCHEMA)
    return parts[0] if len(parts) == 1 else parts[0].unionAll(parts[1])


def compact_ledger(
    spark: SparkSession,
    ledger: str,
    fmt: str = "parquet",
    entries_per_file: int = 1_000_000,
) -> int:
    """Move the entries of all batch folders to the compacted table; how many batches.

    The table's new version counts as soon as its marker is there, the folders are
    deleted afterwards. An interruption before the marker leaves everything as it was;
    after it, folders that are left are passed over, and deleted the next time. Not to be
    run beside an ingest into the same ledger.
    """
    if fmt not in FOLDER_FORMATS:
        raise ValueError(f"tables of {fmt} keep their own files")
    folders = stored_batches(spark, ledger, fmt)
    fresh = folders - _compacted_batches(spark, ledger, fmt)
    if fresh:
        entries = read_ledger(spark, ledger, fmt)
        files = -(-entries.count() // entries_per_file)
        overwrite_table(entries.repartition(max(files, 1), "file_name"), compacted(ledger), fmt)
    for batch in folders:
        delete_folder(spark, f"{ledger}/{BATCH_ID}={batch}")
    return len(fresh)
