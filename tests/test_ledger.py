"""The ledger in few files: nothing lost, nothing twice, whatever interrupts it."""

import os
import shutil
from dataclasses import replace

import pytest
from pyspark.sql import functions as F
from taxi_rows import at, raw_frame, spec, trip

from siltstone.config import Layout, RunConfig
from siltstone.plans.stages import ingest
from siltstone.sources import ledger as ledgers
from siltstone.sources.files import ingested_files, unfinished_files
from siltstone.sources.ledger import (
    compact_ledger,
    compacted,
    read_ledger,
    recorded_batches,
)
from siltstone.sources.tables import append_batch, stored_batches


@pytest.fixture
def cfg(tmp_path):
    return RunConfig(spec(), Layout.under(str(tmp_path / "lake"), str(tmp_path / "raw")))


def write_entries(spark, path, batches, files=3):
    """A ledger of folders, all written at once: rows of a file are its number."""
    rows = spark.range(batches * files).select(
        F.concat(F.lit("f"), "id").alias("file_name"),
        F.col("id").alias("rows"),
        F.concat(F.lit("b_"), F.expr(f"id div {files}")).alias("_batch_id"),
    )
    rows.repartition(8, "_batch_id").write.partitionBy("_batch_id").parquet(path)
    return {(f"f{i}", i, f"b_{i // files}") for i in range(batches * files)}


def entries(spark, path):
    rows = [tuple(r) for r in read_ledger(spark, path).collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def data_files(path):
    return [f for _, _, names in os.walk(path) for f in names if f.endswith(".parquet")]


def test_many_batches_become_few_files(spark, tmp_path):
    path = str(tmp_path / "ledger")
    want = write_entries(spark, path, 400)
    assert len(data_files(path)) >= 400
    assert compact_ledger(spark, path, entries_per_file=500) == 400
    assert entries(spark, path) == want
    assert stored_batches(spark, path) == set()
    assert recorded_batches(spark, path) == {b for _, _, b in want}
    assert data_files(path) == [] and 1 <= len(data_files(compacted(path))) <= 3
    assert compact_ledger(spark, path) == 0 and entries(spark, path) == want


def test_folders_beside_the_compacted_table(spark, tmp_path):
    path = str(tmp_path / "ledger")
    want = write_entries(spark, path, 5)
    compact_ledger(spark, path)
    late = spark.createDataFrame([("late", 7, "b_late")], ledgers.LEDGER_SCHEMA)
    append_batch(late, path)
    want.add(("late", 7, "b_late"))
    assert entries(spark, path) == want and "b_late" in recorded_batches(spark, path)
    assert compact_ledger(spark, path) == 1 and entries(spark, path) == want


@pytest.mark.parametrize("step", ["overwrite_table", "delete_folder"])
def test_an_interrupted_compaction_loses_nothing(spark, tmp_path, monkeypatch, step):
    path = str(tmp_path / "ledger")
    want = write_entries(spark, path, 6)
    calls = []
    real = getattr(ledgers, step)

    def fails(*args, **kwargs):
        calls.append(args)
        if step == "overwrite_table" or len(calls) == 3:
            raise OSError("lost")
        return real(*args, **kwargs)

    with monkeypatch.context() as m:
        m.setattr(ledgers, step, fails)
        with pytest.raises(OSError, match="lost"):
            compact_ledger(spark, path)
    assert stored_batches(spark, path)
    assert entries(spark, path) == want
    compact_ledger(spark, path)
    assert entries(spark, path) == want and stored_batches(spark, path) == set()


def test_no_ledger_and_other_formats(spark, tmp_path):
    path = str(tmp_path / "ledger")
    assert compact_ledger(spark, path) == 0
    assert entries(spark, path) == set() and recorded_batches(spark, path) == set()
    with pytest.raises(ValueError, match="keep their own files"):
        compact_ledger(spark, path, "delta")


def test_ingest_compacts_and_finds_files_again(spark, cfg):
    def land(name, rows, start):
        df = raw_frame(spark, [trip(**at(start + i)) for i in range(rows)])
        folder = f"{cfg.layout.raw}-{name}"
        df.coalesce(1).write.parquet(folder)
        part = next(f for f in os.listdir(folder) if f.endswith(".parquet"))
        os.makedirs(cfg.layout.raw, exist_ok=True)
        shutil.copy(f"{folder}/{part}", f"{cfg.layout.raw}/{name}.parquet")

    out, few = cfg.layout, replace(cfg, ledger_batches=1)
    for n, name in enumerate("abc"):
        land(name, n + 1, 10 * n)
        assert [r.rows_out for r in ingest(spark, few, f"b_{n}")] == [n + 1]
    # Two folders were one too many; the third batch has a folder again.
    assert stored_batches(spark, out.ledger) == {"b_2"}
    assert sum(r.rows_out for r in ingest(spark, few, "b_3")) == 0
    assert unfinished_files(spark, out.bronze, out.ledger).count() == 0
    names = {r[0] for r in ingested_files(spark, out.bronze, out.ledger).collect()}
    assert names == {"a.parquet", "b.parquet", "c.parquet"}
    # A batch that bronze has lost is read again, under an id not used before.
    shutil.rmtree(f"{out.bronze}/_batch_id=b_0")
    again = ingest(spark, few, "b_0")
    assert [r.rows_out for r in again] == [1] and again[0].table != "b_0"
