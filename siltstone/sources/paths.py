"""Files and folders on whatever Hadoop filesystem a path names."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _filesystem(spark: SparkSession, path: str):
    """The filesystem of a path, and the path in its terms."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    conf = spark._jsparkSession.sessionState().newHadoopConf()
    return target.getFileSystem(conf), target


def path_exists(spark: SparkSession, path: str) -> bool:
    filesystem, target = _filesystem(spark, path)
    return filesystem.exists(target)


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names directly in a folder; none if the folder does not exist."""
    filesystem, target = _filesystem(spark, path)
    if not filesystem.exists(target):
        return []
    return [status.getPath().getName() for status in filesystem.listStatus(target)]


def delete_folder(spark: SparkSession, path: str) -> None:
    filesystem, target = _filesystem(spark, path)
    filesystem.delete(target, True)


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its scheme and authority, as Spark's file listings spell it."""
    filesystem, target = _filesystem(spark, path)
    return filesystem.makeQualified(target).toString()


def folder_bytes(spark: SparkSession, path: str) -> int:
    """Size of all files below a path; 0 if there is none."""
    filesystem, target = _filesystem(spark, path)
    if not filesystem.exists(target):
        return 0
    return filesystem.getContentSummary(target).getLength()


def create_empty(spark: SparkSession, path: str) -> None:
    """Make an empty file that must not exist yet."""
    filesystem, target = _filesystem(spark, path)
    filesystem.create(target, False).close()


def write_small(spark: SparkSession, path: str, text: str) -> None:
    """Make a small text file that must not exist yet."""
    filesystem, target = _filesystem(spark, path)
    stream = filesystem.create(target, False)
    try:
        stream.write(bytearray(text, "utf-8"))
    finally:
        stream.close()


def read_small(spark: SparkSession, path: str) -> str:
    """The text of a small file."""
    filesystem, target = _filesystem(spark, path)
    stream = filesystem.open(target)
    try:
        return bytes(stream.readAllBytes()).decode("utf-8")
    finally:
        stream.close()
