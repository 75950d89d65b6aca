"""Stored tables: existence, scan, append, overwrite."""

from __future__ import annotations

import uuid
from collections.abc import Collection, Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, DataFrameReader, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import NullType, StringType, StructField, StructType

from siltstone.config import BATCH_ID
from siltstone.sources.paths import child_names, delete_folder, path_exists
from siltstone.sources.snapshots import (
    CURRENT,
    SnapshotError,
    current_folder,
    group_of,
    next_marker,
    versions,
)

# Formats that keep each batch in a folder of its own and nothing elsewhere.
FOLDER_FORMATS = ("parquet", "orc")


class SchemaDriftError(ValueError):
    """A batch does not fit the stored table."""


def table_exists(spark: SparkSession, path: str, fmt: str = "parquet") -> bool:
    """Whether a table can be read at ``path``; other read errors propagate."""
    path = current_folder(spark, path)
    if not path_exists(spark, path):
        return False
    try:
        spark.read.format(fmt).load(path)
    except AnalysisException as e:
        # The folder is there, but no data file in it yet.
        if e.getCondition() == "UNABLE_TO_INFER_SCHEMA":
            return False
        raise
    return True


def is_stream_table(spark: SparkSession, path: str) -> bool:
    """Whether a streaming file sink owns the table at ``path``."""
    return path_exists(spark, f"{path}/_spark_metadata")


def read_table(
    spark: SparkSession, path: str, fmt: str = "parquet", merge: bool = False
) -> DataFrame:
    """Scan a stored table. Batch ids are text, whatever they look like.

    ``merge`` unites the columns of all files, for tables that gain columns.
    """
    reader = spark.read.format(fmt)
    if merge:
        reader = reader.option("mergeSchema", "true")
    return _load(reader, current_folder(spark, path))


def _load(reader: DataFrameReader, paths: str | list[str]) -> DataFrame:
    df = reader.load(paths)
    if BATCH_ID in df.columns and df.schema[BATCH_ID].dataType != StringType():
        # Read again with the partition column's type given, not inferred.
        schema = StructType(
            [
                StructField(BATCH_ID, StringType()) if f.name == BATCH_ID else f
                for f in df.schema.fields
            ]
        )
        df = reader.schema(schema).load(paths)
    return df


def stored_batches(spark: SparkSession, path: str, fmt: str = "parquet") -> set[str]:
    """Ids of the batches in a table; there is one per ingest run.

    Taken from the names of the partition folders, so the cost does not depend on
    the size of the table. Other formats keep the list in their own metadata.
    """
    if fmt not in FOLDER_FORMATS:
        if not table_exists(spark, path, fmt):
            return set()
        ids = read_table(spark, path, fmt).select(BATCH_ID).distinct()
        return {r[BATCH_ID] for r in ids.toLocalIterator()}
    prefix = f"{BATCH_ID}="
    names = child_names(spark, path)
    return {n.removeprefix(prefix) for n in names if n.startswith(prefix)}


def read_batches(
    spark: SparkSession,
    path: str,
    ids: Collection[str],
    fmt: str = "parquet",
    merge: bool = False,
) -> DataFrame:
    """Scan some batches of a table, without listing the files of the others."""
    if fmt not in FOLDER_FORMATS:
        return read_table(spark, path, fmt).filter(F.col(BATCH_ID).isin(list(ids)))
    folders = [f"{path}/{BATCH_ID}={i}" for i in sorted(ids)]
    reader = spark.read.format(fmt).option("basePath", path)
    return _load(reader.option("mergeSchema", "true") if merge else reader, folders)


def write_version(
    df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] = ()
) -> str:
    """Write ``df`` as a new version of the table at ``path``; the folder's name.

    Readers go on seeing the version before, until ``publish``.
    """
    folder = f"v-{uuid.uuid4().hex}"
    if partition_by:
        # Gather each partition value in few tasks; adaptive execution splits
        # the large ones again, so a value may hold any share of the rows.
        df = df.hint("rebalance", *partition_by)
    writer = df.write.format(fmt)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(f"{path}/{folder}")
    return folder


def publish(spark: SparkSession, path: str, folder: str) -> None:
    """Make a written version of the table at ``path`` the one that counts.

    Creating a marker is atomic. What a running reader may still need, the version
    before, is deleted by the next one; so are versions that were never published.
    Tables of a group change with it, by ``publish_together``.
    """
    if group_of(spark, path):
        raise SnapshotError(f"{path} is published with its group")
    before = versions(child_names(spark, path))
    next_marker(spark, path, folder)
    keep = {folder, *(f for _, f in before[-1:])}
    for name in child_names(spark, path):
        stale = name.split(".", 2)[-1] if name.startswith(CURRENT) else name
        if stale not in keep:
            delete_folder(spark, f"{path}/{name}")


def overwrite_table(
    df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] = ()
) -> None:
    """Replace the table at ``path``. If the write fails, the old one stays."""
    publish(df.sparkSession, path, write_version(df, path, fmt, partition_by))


def fit_to_table(df: DataFrame, target: StructType, evolve: bool = False) -> DataFrame:
    """Order and complete a batch's columns for the table it is appended to.

    Absent columns become NULL; changed types are errors, and so are unknown columns,
    unless the table is to ``evolve``: then they come last.
    """
    known = {f.name: f.dataType for f in target.fields}
    extra = [c for c in df.columns if c not in known]
    changed = [
        f"{f.name} ({f.dataType.simpleString()}, stored as {known[f.name].simpleString()})"
        for f in df.schema.fields
        if f.name in known and f.dataType not in (known[f.name], NullType())
    ]
    if (extra and not evolve) or changed:
        raise SchemaDriftError(f"new columns: {extra}; changed types: {changed}")
    present = {f.name for f in df.schema.fields if f.dataType != NullType()}
    return df.select(
        *[
            F.col(c) if c in present else F.lit(None).cast(t).alias(c)
            for c, t in known.items()
        ],
        *extra,
    )


def append_batch(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    more: bool = False,
    rows_per_file: int = 0,
) -> None:
    """Add one batch, a frame with a single ``_batch_id``, to the table.

    The batch is a partition of its own and is written by dynamic partition
    overwrite: a retry of the same batch replaces it instead of doubling it. With
    ``more``, the rows are added to what the batch has. No file gets more than
    ``rows_per_file`` rows, unless that is 0.
    """
    spark = df.sparkSession
    if is_stream_table(spark, path):
        raise ValueError(f"{path} is written by a stream; do not append batches to it")
    (
        df.write.format(fmt)
        .mode("append" if more else "overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("maxRecordsPerFile", rows_per_file)
        .partitionBy(BATCH_ID)
        .save(path)
    )


def stored_schema(
    spark: SparkSession, path: str, fmt: str = "parquet", merge: bool = False
) -> StructType | None:
    """Schema that batches have to fit; None if no batch is stored.

    Every batch was fitted to the first, so any one tells it, unless columns were
    added since.
    """
    stored = stored_batches(spark, path, fmt)
    if not stored:
        return None
    if merge:
        return read_table(spark, path, fmt, merge).schema
    return read_batches(spark, path, [max(stored)], fmt).schema


def write_with_counts(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    counts: Mapping[str, Column] | None = None,
    partition_by: Sequence[str] = (),
) -> tuple[str, dict[str, int]]:
    """``write_version`` that also returns ``rows`` and further aggregates.

    The counters sit on top of the plan, in the stage that writes, where Spark
    counts a repeated task once; no second pass over the data is made. Partitioned
    tables are shuffled on the way and are counted when they are written.
    """
    observation = Observation()
    exprs = {"rows": F.count(F.lit(1)), **(counts or {})}
    named = [e.alias(n) for n, e in exprs.items()]
    if partition_by:
        folder = write_version(df, path, fmt, partition_by)
        row = df.sparkSession.read.format(fmt).load(f"{path}/{folder}").agg(*named).first()
        return folder, row.asDict()
    folder = write_version(df.observe(observation, *named), path, fmt)
    return folder, {n: observation.get[n] for n in exprs}


def overwrite_with_counts(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    counts: Mapping[str, Column] | None = None,
) -> dict[str, int]:
    """``overwrite_table`` that also returns ``rows`` and further aggregates."""
    folder, found = write_with_counts(df, path, fmt, counts)
    publish(df.sparkSession, path, folder)
    return found
