"""Reading tables and splitting them, for the operators of this package."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.sources.scratch import materialize

__all__ = ["empty_text", "few_parts", "label_sizes", "load", "materialize", "parts_for", "row_slices", "sampled", "short_batches", "shuffles_freed", "whole_row"]


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def short_batches(df: DataFrame, rows: int = 2000) -> None:
    """Let Arrow batches have few rows, as texts are long.

    The default of 10,000 rows is for numbers; of texts it takes each Python worker, and
    the JVM beside it, hundreds of megabytes. A number set by the caller is kept.
    """
    conf, key = df.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if conf.get(key) == "10000":
        conf.set(key, str(rows))


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Inside, a query's shuffle files go when the query ends.

    Otherwise they stay until the driver next collects its garbage, which may be after many
    more queries. For queries that write what is read again.
    """
    conf, key = spark.conf, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = conf.get(key, "false")
    conf.set(key, "true")
    try:
        yield
    finally:
        conf.set(key, before)


def empty_text(column: str) -> Column:
    """The text, with null taken as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def whole_row(df: DataFrame) -> Column:
    """All columns as one, so that names an operator adds cannot clash with them."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns])


def parts_for(amount: int, each: int) -> int:
    """How many parts of about ``each`` make up ``amount``; at least one."""
    return max(1, -(-int(amount) // each))


# Rows that a task of a small result has at least, where these are a few numbers.
FEW_ROWS = 250_000


def few_parts(df: DataFrame, rows: int, each: int = FEW_ROWS) -> DataFrame:
    """The frame in no more parts than a result of up to ``rows`` rows needs.

    That is one for ``each`` rows, or one for each core if these are more. There is no
    shuffle: a task reads several of the last one's partitions. Each part becomes a file,
    and to write one, Spark's local file system starts programs that set modes, each of
    which shares the executor's memory until it begins.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.coalesce(max(cores, parts_for(rows, each)))


def row_slices(
    batches: Iterator[pa.RecordBatch], rows: int = 512
) -> Iterator[pa.RecordBatch]:
    """Arrow batches cut to few rows, as texts may be long."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def label_sizes(rows: DataFrame, max_labels: int = 256) -> tuple[DataFrame, bool]:
    """(label, rows) of the largest labels, and whether there are more than that.

    Of labels with equally many rows the first in order count.
    """
    sizes = rows.groupBy("label").agg(F.count(F.lit(1)).alias("rows"))
    found = sizes.orderBy(F.desc("rows"), "label").limit(max_labels + 1).collect()
    kept = rows.sparkSession.createDataFrame(found[:max_labels], sizes.schema)
    return kept, len(found) > max_labels


def sampled(rows: DataFrame, per_label: int, sizes: DataFrame | None = None) -> DataFrame:
    """About ``per_label`` of the rows (id, label) of each label: (id, label), distinct.

    A row is in it if its id hashes below the share that is wanted of its label, so that
    no row meets others. Labels are the largest, as ``label_sizes`` has them.
    """
    if sizes is None:
        sizes, _ = label_sizes(rows)
    share = F.pmod(F.xxhash64("id"), F.lit(1 << 31)) / float(1 << 31)
    kept = rows.join(F.broadcast(sizes), "label").filter(share < per_label / F.col("rows"))
    return kept.select("id", "label").distinct()
