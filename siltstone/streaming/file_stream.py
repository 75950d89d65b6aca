"""Exactly-once file ingestion by Structured Streaming."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from siltstone.config import BATCH_ID, INGESTED_AT, RunConfig
from siltstone.operators.schema import stamp, standardize
from siltstone.plans.stages import free_id, ingest_files, new_batch_id
from siltstone.sources.files import stream_source_files, tag_source
from siltstone.sources.paths import child_names, create_empty
from siltstone.sources.ledger import recorded_batches
from siltstone.sources.tables import is_stream_table, stored_batches, table_exists

# In a checkpoint of drifting files: an empty file that names its batches' prefix.
PREFIX = "_batches."


def start_ingest_stream(
    spark: SparkSession,
    cfg: RunConfig,
    schema: StructType,
    batch_id: str | None = None,
) -> StreamingQuery:
    """Append the files that arrived since the last run to bronze, then stop.

    The checkpoint takes the ledger's part: it remembers the files, and the file
    sink commits each micro-batch once. For directories whose files share one
    schema; files that drift go through ``ingest_drifting_stream``, into another table.
    """
    out = cfg.layout
    if table_exists(spark, out.bronze, cfg.fmt) and not is_stream_table(spark, out.bronze):
        raise ValueError(f"{out.bronze} is written by batches; use another table")
    files = (
        spark.readStream.schema(schema)
        .option("pathGlobFilter", cfg.glob)
        .option("maxFilesPerTrigger", cfg.max_files_per_write)
        .parquet(out.raw)
    )
    # The tag is added before the names are lowered; both keep it last.
    rows = standardize(tag_source(files), cfg.spec.raw_casts)
    rows = stamp(stamp(rows, INGESTED_AT), BATCH_ID, batch_id or new_batch_id())
    return (
        rows.writeStream.format(cfg.fmt)
        .option("checkpointLocation", out.stream_checkpoint)
        .partitionBy(BATCH_ID)
        .trigger(availableNow=True)
        .start(out.bronze)
    )


def ingest_stream(
    spark: SparkSession,
    cfg: RunConfig,
    schema: StructType,
    batch_id: str | None = None,
) -> None:
    """``start_ingest_stream`` and wait for it; its failure is raised here."""
    start_ingest_stream(spark, cfg, schema, batch_id).awaitTermination()


def batch_prefix(spark: SparkSession, cfg: RunConfig, wanted: str) -> str:
    """What the ids of a checkpoint's batches begin with.

    It is chosen when the checkpoint is new and kept with it, and no other batch has it:
    a checkpoint that was lost, and counts from 0 again, does not replace older batches.
    """
    out = cfg.layout
    names = child_names(spark, out.stream_checkpoint)
    kept = sorted(n.removeprefix(PREFIX) for n in names if n.startswith(PREFIX))
    if kept:
        return kept[0]
    stored = stored_batches(spark, out.bronze, cfg.fmt)
    stored |= recorded_batches(spark, out.ledger, cfg.fmt)
    prefix = free_id({i.rsplit("-", 1)[0] for i in stored} | stored, wanted)
    create_empty(spark, f"{out.stream_checkpoint}/{PREFIX}{prefix}")
    return prefix


def start_drifting_stream(
    spark: SparkSession, cfg: RunConfig, batch_id: str | None = None
) -> StreamingQuery:
    """Append the files that arrived since the last run, whatever their schemas.

    The stream carries the files' names; each micro-batch takes the schemas from the
    footers and appends the rows the way ``ingest`` does, as the batch
    ``<batch_id>-<number>``. A micro-batch that is run again, after a crash, replaces
    its batch, or finds its files in the ledger if that was written; either way no row
    doubles. As the ledger decides, the table can be fed by ``ingest`` as well.

    A micro-batch has ``max_files_per_write`` files at most. Files of one are united;
    those of a later one must fit the stored table, unless the run says ``evolve``.
    """
    out = cfg.layout
    if is_stream_table(spark, out.bronze):
        raise ValueError(f"{out.bronze} is written by a file stream; use another table")
    prefix = batch_prefix(spark, cfg, batch_id or new_batch_id())
    files = stream_source_files(spark, out.raw, cfg.glob, cfg.max_files_per_write)

    def append(batch: DataFrame, number: int) -> None:
        ingest_files(batch.sparkSession, cfg, batch, f"{prefix}-{number:08d}")

    return (
        files.select("path", "file_name", "length")
        .writeStream.foreachBatch(append)
        .option("checkpointLocation", out.stream_checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def ingest_drifting_stream(
    spark: SparkSession, cfg: RunConfig, batch_id: str | None = None
) -> None:
    """``start_drifting_stream`` and wait for it; its failure is raised here."""
    start_drifting_stream(spark, cfg, batch_id).awaitTermination()
