"""Deterministic removal of duplicates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, VariantType


def dedup(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[str] | None = None
) -> DataFrame:
    """Keep one row per key, the first by ``order_by`` (NULL keys are equal).

    Columns not named in ``order_by`` break the remaining ties, so that only
    identical rows are interchangeable and the result never depends on how the
    input is partitioned. Spark turns the ``= 1`` filter into a group limit below
    the shuffle as well: every map task sends at most one row per key, also for
    a key that holds a large share of the table.
    """
    lead = list(order_by or ())
    order = lead + [
        f.name
        for f in df.schema.fields
        if f.name not in keys
        and f.name not in lead
        and not isinstance(f.dataType, (MapType, VariantType))
    ]
    if not order:
        return df.dropDuplicates(list(keys))
    w = Window.partitionBy(*keys).orderBy(*order)
    return (
        df.withColumn("_position", F.row_number().over(w))
        .filter("_position = 1")
        .drop("_position")
    )


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their row count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1")
