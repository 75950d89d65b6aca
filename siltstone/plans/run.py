"""The stages in order, and the report of a run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from siltstone.config import RunConfig
from siltstone.plans.stages import StageRow, aggregate, clean, ingest, validate


def run_pipeline(
    spark: SparkSession,
    cfg: RunConfig,
    batch_id: str | None = None,
    as_of: str | None = None,
) -> list[StageRow]:
    """Ingest, clean, gate, summarise. A stage that raises stops the rest."""
    return [
        *ingest(spark, cfg, batch_id),
        *clean(spark, cfg, as_of),
        *validate(spark, cfg),
        *aggregate(spark, cfg),
    ]


def run_report(spark: SparkSession, rows: list[StageRow]) -> DataFrame:
    """What each stage read and wrote: (stage, table, rows_in, rows_out)."""
    return spark.createDataFrame(
        rows, "stage string, table string, rows_in bigint, rows_out bigint"
    )
