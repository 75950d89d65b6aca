"""Raw files: listing, footers, the ledger of what is stored, schema groups."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamReader
from pyspark.sql.types import StructType

from siltstone.config import BATCH_ID, SOURCE_FILE
from siltstone.functions import base_name, decode_path
from siltstone.operators.schema import lowercase_columns
from siltstone.sources.ledger import read_ledger, recorded_batches
from siltstone.sources.paths import qualified
from siltstone.sources.tables import read_batches, stored_batches

# What Spark's reader of whole files gives; the content is not read unless selected.
BINARY_FILE = "path string, modificationTime timestamp, length long, content binary"


def list_source_files(
    spark: SparkSession, directory: str, glob: str = "*.parquet"
) -> DataFrame:
    """Files directly in ``directory``: (path, file_name, length, modified).

    The file contents are not read.
    """
    return _files_in(spark, spark.read, directory, glob)


def stream_source_files(
    spark: SparkSession, directory: str, glob: str, files_per_batch: int
) -> DataFrame:
    """The same as a stream that offers each file once, some files at a time."""
    reader = spark.readStream.schema(BINARY_FILE).option(
        "maxFilesPerTrigger", files_per_batch
    )
    return _files_in(spark, reader, directory, glob)


def _files_in(
    spark: SparkSession,
    reader: DataFrameReader | DataStreamReader,
    directory: str,
    glob: str,
) -> DataFrame:
    # Without the recursive lookup Spark would take folders named key=value for
    # partitions, and leave out the files beside them.
    here = qualified(spark, directory).rstrip("/")
    return (
        reader.format("binaryFile")
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", "true")
        .load(directory)
        .select(
            "path",
            base_name("path").alias("file_name"),
            "length",
            F.col("modificationTime").alias("modified"),
        )
        .filter(F.col("path") == F.concat(F.lit(f"{here}/"), "file_name"))
    )


def file_names(df: DataFrame, column: str = SOURCE_FILE) -> DataFrame:
    """Distinct base names of a column of file URIs; NULL and empty are skipped.

    The URIs are made distinct first, so that each is decoded once.
    """
    uris = df.filter(F.col(column) != "").select(column).distinct()
    return uris.select(base_name(decode_path(column)).alias("file_name")).distinct()


def ingested_files(
    spark: SparkSession, bronze: str, ledger: str, fmt: str = "parquet"
) -> DataFrame:
    """Names of the files whose rows are in bronze, or that have none: (file_name).

    A batch counts once the ledger has it, which is written last: what bronze holds of
    other batches may be incomplete. Entries of batches that bronze has lost do not count.
    """
    stored = stored_batches(spark, bronze, fmt)
    recorded = recorded_batches(spark, ledger, fmt)
    if not recorded:
        return spark.createDataFrame([], "file_name string")
    entries = read_ledger(spark, ledger, fmt)
    if recorded - stored:
        lost = F.col(BATCH_ID).isin(list(recorded - stored))
        entries = entries.filter(~lost | (F.col("rows") == 0))
    return entries.select("file_name").distinct()


def unfinished_files(
    spark: SparkSession, bronze: str, ledger: str, fmt: str = "parquet"
) -> DataFrame:
    """(file_name, _batch_id) of batches that have rows but no ledger entry.

    Such a batch may lack files altogether; these are in no other batch and so are new.
    """
    unfinished = stored_batches(spark, bronze, fmt) - recorded_batches(spark, ledger, fmt)
    if not unfinished:
        return spark.createDataFrame([], f"file_name string, {BATCH_ID} string")
    rows = read_batches(spark, bronze, unfinished, fmt).filter(F.col(SOURCE_FILE) != "")
    found = rows.select(SOURCE_FILE, BATCH_ID).distinct()
    named = found.select(base_name(decode_path(SOURCE_FILE)).alias("file_name"), BATCH_ID)
    return named.groupBy("file_name").agg(F.min(BATCH_ID).alias(BATCH_ID))


def select_new_files(files: DataFrame, ingested: DataFrame) -> DataFrame:
    """Files whose name is not among the ingested ones."""
    return files.join(ingested, "file_name", "left_anti")


def _footer_reader():
    """The function that tasks run. It is defined here, and imports what it needs
    itself, so that Spark ships it whole: executors need not have this package."""

    def open_footer(path):
        from urllib.parse import quote

        from pyarrow import fs, parquet

        scheme, sep, rest = path.partition(":")
        if not sep or scheme == "file":
            return parquet.read_metadata("/" + rest.lstrip("/") if sep else path)
        scheme = {"s3a": "s3", "s3n": "s3"}.get(scheme, scheme)
        store, name = fs.FileSystem.from_uri(f"{scheme}:{quote(rest, safe='/:@')}")
        return parquet.read_metadata(name, filesystem=store)

    def described(path):
        footer = open_footer(path)
        schema = footer.schema.to_arrow_schema()
        names = [n.lower() for n in schema.names]
        clashes = sorted({n for n in names if names.count(n) > 1})
        if clashes:
            raise ValueError(f"columns differ only in case: {clashes}")
        kinds = sorted(f"{n} {t}" for n, t in zip(schema.names, schema.types))
        return ", ".join(kinds), footer.num_rows

    def read(batches):
        import pyarrow as pa

        for batch in batches:
            found = [described(p) for p in batch.column("path").to_pylist()]
            footers = pa.array([f for f, _ in found], pa.string())
            rows = pa.array([n for _, n in found], pa.int64())
            names = [*batch.schema.names, "footer", "footer_rows"]
            yield pa.RecordBatch.from_arrays([*batch.columns, footers, rows], names=names)

    return read


def read_footers(spark: SparkSession, files: DataFrame, reader: str = "executors"):
    """``files`` with what each one's footer says: ``footer``, ``footer_rows``.

    ``footer`` is the schema, as text; ``footer_rows`` the number of rows.
    "executors" opens the footers in parallel tasks; only paths reach Python.
    "spark" lets Spark infer each schema and count the rows, one file at a time per
    thread, for stores that only Spark can reach; the paths then come to the driver.
    """
    if reader == "executors":
        # A list of paths is tiny, so adaptive execution would leave it in one task.
        tasks = spark.sparkContext.defaultParallelism
        kinds = ", ".join(f"{n} {t}" for n, t in files.dtypes)
        return files.repartition(tasks).mapInArrow(
            _footer_reader(), f"{kinds}, footer string, footer_rows long"
        )
    if reader != "spark":
        raise ValueError(f"unknown footer reader {reader!r}")

    def inferred(row) -> tuple:
        df = lowercase_columns(spark.read.parquet(escape_glob(row["path"])))
        named = sorted(f"{f.name} {f.dataType.simpleString()}" for f in df.schema)
        return (*row, ", ".join(named), df.count())

    with ThreadPoolExecutor(16) as pool:
        rows = list(pool.map(inferred, files.toLocalIterator()))
    kinds = ", ".join(f"{n} {t}" for n, t in files.dtypes)
    return spark.createDataFrame(rows, f"{kinds}, footer string, footer_rows long")


def escape_glob(path: str) -> str:
    """Protect characters that Spark's readers take for glob syntax."""
    return "".join(f"\\{c}" if c in "{}[]*?\\" else c for c in path)


def footer_schemas(spark: SparkSession, files: DataFrame) -> dict[str, StructType]:
    """Schema, as Spark reads it, of each distinct footer, by the order of file names.

    Only the footers and an example of each reach the driver.
    """
    examples = files.groupBy("footer").agg(
        F.min(F.struct("file_name", "path")).alias("first")
    )
    rows = sorted(examples.collect(), key=lambda r: r["first"])
    return {
        r["footer"]: spark.read.parquet(escape_glob(r["first"]["path"])).schema
        for r in rows
    }


def read_schema_groups(
    spark: SparkSession,
    files: Iterable[tuple[str, str]],
    schemas: Mapping[str, StructType],
) -> list[DataFrame]:
    """One scan per distinct footer of some files (path, footer), tagged by file.

    The groups come in the order of ``schemas``. The plan grows with the number of
    schemas, not of files, and no footer is read again.
    """
    groups: dict[str, list[str]] = {footer: [] for footer in schemas}
    for path, footer in files:
        groups[footer].append(escape_glob(path))
    return [
        tag_source(spark.read.schema(schemas[footer]).parquet(*group))
        for footer, group in groups.items()
        if group
    ]


def tag_source(df: DataFrame) -> DataFrame:
    """Add the URI of the file each row was read from, as Spark reports it."""
    return df.select("*", F.col("_metadata.file_path").alias(SOURCE_FILE))
