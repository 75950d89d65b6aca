"""Intermediate results stored where every executor can read them again."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from contextvars import ContextVar
from functools import cache

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

from siltstone.sources.paths import delete_folder

_scope: ContextVar[list[str] | None] = ContextVar("scratch_scope", default=None)


@cache
def _local_scratch() -> str:
    return tempfile.mkdtemp(prefix="siltstone-")


def scratch_dir(spark: SparkSession) -> str:
    """A fresh path below the shared folder named by ``spark.checkpoint.dir``.

    Only a session in local mode may leave that unset.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise RuntimeError(
                "set spark.checkpoint.dir to a folder shared by driver and executors"
            )
        base = _local_scratch()
    return f"{base.rstrip('/')}/siltstone/{uuid.uuid4().hex}"


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Delete at the end what is materialized inside.

    For code that has written its results by then; a frame that outlives the
    scope must not depend on a materialized one.
    """
    paths: list[str] = []
    token = _scope.set(paths)
    try:
        yield
    finally:
        _scope.reset(token)
        for path in paths:
            delete_folder(spark, path)


def _scoped_dir(spark: SparkSession) -> str:
    path = scratch_dir(spark)
    if (paths := _scope.get()) is not None:
        paths.append(path)
    return path


def materialize(df: DataFrame, partition_by: Sequence[str] = ()) -> DataFrame:
    """Write the frame to scratch once and return a scan of it.

    Cuts the lineage, keeps column pruning, and survives the loss of executors.
    """
    path = _scoped_dir(df.sparkSession)
    writer = df.write.partitionBy(*partition_by) if partition_by else df.write
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def materialize_together(
    spark: SparkSession, frames: Sequence[Callable[[], DataFrame]], at_once: int
) -> DataFrame:
    """``materialize`` of frames of one schema as one, some of them at a time.

    For frames of so few tasks that one after another would leave cores idle. A frame is
    planned when its turn comes.
    """
    path = _scoped_dir(spark)

    def write(n: int):
        df = frames[n]()
        df.write.parquet(f"{path}/{n}")
        return df.schema

    with ThreadPoolExecutor(at_once) as pool:
        run = inheritable_thread_target(spark)(write)
        schemas = list(pool.map(run, range(len(frames))))
    reader = spark.read.schema(schemas[0]).option("recursiveFileLookup", "true")
    return reader.parquet(path)
