import dataclasses
import os
import shutil
import threading
from urllib.parse import unquote

import pytest
from plans import write_plans
from pyspark.sql import functions as F
from taxi_rows import at, raw_frame, spec, trip

from siltstone.config import Layout, RunConfig
from siltstone.plans import stages
from siltstone.plans.stages import ReconciliationError, clean, file_plan, free_id, ingest
from siltstone.sources.files import (
    file_names,
    list_source_files,
    read_footers,
)
from siltstone.sources.scratch import scratch_dir
from siltstone.sources.tables import (
    SchemaDriftError,
    append_batch,
    fit_to_table,
    overwrite_table,
    read_table,
)


def write_file(spark, df, path: str) -> None:
    """Write a frame as one parquet file of the given name."""
    folder = path + ".dir"
    df.coalesce(1).write.parquet(folder)
    part = next(f for f in os.listdir(folder) if f.endswith(".parquet"))
    os.makedirs(os.path.dirname(path), exist_ok=True)
    shutil.copy(f"{folder}/{part}", path)


def month(spark, rows, start, **changes):
    df = raw_frame(spark, [trip(**at(start + i)) for i in range(rows)])
    return df.withColumns(changes) if changes else df


@pytest.fixture
def cfg(tmp_path):
    return RunConfig(spec(), Layout.under(str(tmp_path / "lake"), str(tmp_path / "in/raw")))


def land(spark, cfg, name, df):
    write_file(spark, df, f"{cfg.layout.raw}/{name}")


def land_drifting(spark, cfg):
    """Ids as int or bigint, two spellings, one absent column, a blank in a name."""
    a = month(spark, 3, 0, vendorid=F.lit(1), pulocationid=F.lit(100))
    land(spark, cfg, "A.parquet", a.toDF(*[c.upper() for c in a.columns]))
    b = month(spark, 4, 10, passenger_count=F.lit(2).cast("bigint"))
    land(spark, cfg, "B.parquet", b.withColumnRenamed("airport_fee", "Airport_fee"))
    land(spark, cfg, "C.parquet", month(spark, 5, 20).drop("airport_fee"))
    land(spark, cfg, "a b+c.parquet", month(spark, 6, 30))
    land(spark, cfg, "E.parquet", month(spark, 1, 0).limit(0))


def per_file(spark, cfg):
    bronze = read_table(spark, cfg.layout.bronze)
    return {
        unquote(os.path.basename(r._source_file)): r["count"]
        for r in bronze.groupBy("_source_file").count().collect()
    }


EXPECTED = {"A.parquet": 3, "B.parquet": 4, "C.parquet": 5, "a b+c.parquet": 6}


@pytest.mark.parametrize("reader", ["executors", "spark"])
def test_drifting_files_once(spark, cfg, reader):
    land_drifting(spark, cfg)
    cfg = RunConfig(cfg.spec, cfg.layout, footer_reader=reader)
    assert [r.rows_out for r in ingest(spark, cfg, "b_1")] == [18]
    assert per_file(spark, cfg) == EXPECTED
    append = [p for p in write_plans(spark) if f"{cfg.layout.bronze}," in p]
    assert append and "Sort" not in append[-1] and "Exchange" not in append[-1]
    bronze = read_table(spark, cfg.layout.bronze)
    assert bronze.columns[-3:] == ["_ingestion_timestamp", "_source_file", "_batch_id"]
    types = dict(bronze.dtypes)
    assert types["vendorid"] == "bigint" and types["passenger_count"] == "double"
    fees = bronze.filter("airport_fee is null").select("_source_file").distinct()
    assert [r[0].endswith("/C.parquet") for r in fees.collect()] == [True]

    # The ledger has the empty file too.
    ledger = read_table(spark, cfg.layout.ledger)
    assert {r.file_name: r.rows for r in ledger.collect()} == EXPECTED | {"E.parquet": 0}
    assert ingest(spark, cfg, "b_2") == []


def test_nothing_new_writes_nothing(spark, cfg):
    land(spark, cfg, "A.parquet", month(spark, 3, 0))
    assert len(ingest(spark, cfg, "b_1")) == 1
    before = sorted(os.listdir(cfg.layout.bronze))
    assert ingest(spark, cfg, "b_2") == []
    assert sorted(os.listdir(cfg.layout.bronze)) == before


def data_of(spark, cfg):
    df = read_table(spark, cfg.layout.bronze).drop("_ingestion_timestamp")
    return df.dtypes, sorted(map(str, df.collect()))


@pytest.mark.parametrize("change", ["drift", "added", "zone"])
def test_the_number_of_writes_changes_nothing(spark, cfg, tmp_path, change):
    """One batch of one schema, also where the first file lacks what later ones have."""
    if change == "drift":
        land_drifting(spark, cfg)
    elif change == "added":
        land(spark, cfg, "A.parquet", month(spark, 3, 0))
        land(spark, cfg, "B.parquet", month(spark, 4, 10, extra_fee=F.lit(1.5)))
    else:
        land(spark, cfg, "A.parquet", month(spark, 3, 0))
        zoned = F.col("tpep_pickup_datetime").cast("timestamp")
        land(spark, cfg, "B.parquet", month(spark, 4, 10, tpep_pickup_datetime=zoned))
    found = []
    for limit in (10_000, 1):
        layout = Layout.under(str(tmp_path / f"lake{limit}"), cfg.layout.raw)
        own = RunConfig(cfg.spec, layout, max_files_per_write=limit)
        report = ingest(spark, own, "b_1")
        assert [r.table for r in report] == ["b_1"]
        found.append(data_of(spark, own))
        assert ingest(spark, own, "b_2") == []
    assert found[0] == found[1]


def test_plans_of_few_files_run_side_by_side(spark, cfg, monkeypatch):
    """Two plans must meet for either to go on; bronze gets their rows in one write."""
    for i in range(4):
        land(spark, cfg, f"{i}.parquet", month(spark, i + 1, 10 * i))
    cfg = dataclasses.replace(cfg, max_files_per_write=1)
    met, files, writes = threading.Barrier(2), [], []
    plan, append = stages.raw_batch, stages.append_batch

    def planned(groups, *args):
        met.wait(60)
        files.append([os.path.basename(f) for g in groups for f in g.inputFiles()])
        return plan(groups, *args)

    def appended(df, path, *args, **more):
        writes.append(path)
        append(df, path, *args, **more)

    monkeypatch.setattr(stages, "raw_batch", planned)
    monkeypatch.setattr(stages, "append_batch", appended)
    assert [r.rows_out for r in ingest(spark, cfg, "b_1")] == [10]
    assert sorted(files) == [[f"{i}.parquet"] for i in range(4)]
    assert writes == [cfg.layout.bronze, cfg.layout.ledger]
    assert per_file(spark, cfg) == {f"{i}.parquet": i + 1 for i in range(4)}
    append = [p for p in write_plans(spark) if f"{cfg.layout.bronze}," in p]
    assert append and "Sort" not in append[-1] and "Exchange" not in append[-1]


def test_plans_that_take_several_writes(spark, cfg, monkeypatch):
    """A plan that fails ends the run; the next one completes the batch."""
    monkeypatch.setattr(stages, "MAX_AT_ONCE", 2)
    monkeypatch.setattr(stages, "PLANS_EACH", 1)
    land_drifting(spark, cfg)
    cfg = dataclasses.replace(cfg, max_files_per_write=1)
    plan = stages.raw_batch

    def failing(groups, *args):
        if groups[0].inputFiles()[0].endswith("E.parquet"):
            raise OSError("gone")
        return plan(groups, *args)

    with monkeypatch.context() as broken:
        broken.setattr(stages, "raw_batch", failing)
        with pytest.raises(OSError, match="gone"):
            ingest(spark, cfg, "b_1")
    assert sum(per_file(spark, cfg).values()) < 18
    ingest(spark, cfg, "b_2")
    assert per_file(spark, cfg) == EXPECTED
    assert ingest(spark, cfg, "b_3") == []


def test_columns_that_the_stored_table_lacks(spark, cfg):
    land(spark, cfg, "A.parquet", month(spark, 3, 0))
    ingest(spark, cfg, "b_1")
    land(spark, cfg, "B.parquet", month(spark, 4, 10, extra_fee=F.lit(1.5)))
    with pytest.raises(SchemaDriftError):
        ingest(spark, cfg, "b_2")
    cfg = RunConfig(cfg.spec, cfg.layout, evolve=True)
    assert [r.rows_out for r in ingest(spark, cfg, "b_3")] == [4]
    bronze = read_table(spark, cfg.layout.bronze, merge=True)
    fees = {(r[0], r[1]) for r in bronze.groupBy("extra_fee").count().collect()}
    assert fees == {(None, 3), (1.5, 4)}
    clean(spark, cfg)
    assert "extra_fee" in read_table(spark, cfg.layout.silver).columns


def test_folders_beside_the_files_are_not_looked_into(spark, cfg):
    land(spark, cfg, "A.parquet", month(spark, 3, 0))
    land(spark, cfg, "m=1/p.parquet", month(spark, 5, 10))
    ingest(spark, cfg, "b_1")
    land(spark, cfg, "m=2/p.parquet", month(spark, 6, 20))
    land(spark, cfg, "B.parquet", month(spark, 4, 30))
    ingest(spark, cfg, "b_2")
    assert per_file(spark, cfg) == {"A.parquet": 3, "B.parquet": 4}
    assert "m" not in read_table(spark, cfg.layout.bronze).columns


def test_unfinished_batch_is_written_again_under_its_id(spark, cfg):
    """Half of one file's rows arrived, another file's not at all, and no ledger entry."""
    land(spark, cfg, "A.parquet", month(spark, 3, 0))
    ingest(spark, cfg, "b_1")
    land(spark, cfg, "B.parquet", month(spark, 6, 10))
    ingest(spark, cfg, "b_2")
    out = cfg.layout
    batch = read_table(spark, out.bronze).filter("_batch_id = 'b_2'").limit(2).collect()
    schema = read_table(spark, out.bronze).schema
    append_batch(spark.createDataFrame(batch, schema), out.bronze)
    shutil.rmtree(f"{out.ledger}/_batch_id=b_2")
    land(spark, cfg, "C.parquet", month(spark, 5, 20))
    report = ingest(spark, cfg, "b_3")
    assert [(r.table, r.rows_out) for r in report] == [("b_2", 6), ("b_3", 5)]
    assert per_file(spark, cfg) == {"A.parquet": 3, "B.parquet": 6, "C.parquet": 5}
    assert ingest(spark, cfg, "b_4") == []


def test_reused_batch_id_keeps_earlier_rows(spark, cfg):
    land(spark, cfg, "A.parquet", month(spark, 3, 0))
    ingest(spark, cfg, "b_1")
    land(spark, cfg, "B.parquet", month(spark, 4, 10))
    assert [r.table for r in ingest(spark, cfg, "b_1")] == ["b_1.0001"]
    assert per_file(spark, cfg) == {"A.parquet": 3, "B.parquet": 4}


def test_odd_batch_id_is_refused(spark, cfg):
    with pytest.raises(ValueError, match="folder name"):
        ingest(spark, cfg, "a/b")


def test_free_id():
    assert free_id({"x", "x.0002"}, "x") == "x.0001"
    assert free_id({"x", "x.0001"}, "x") == "x.0002"
    assert free_id({"y"}, "x") == "x"


def test_ledger_entry_of_a_lost_batch_does_not_count(spark, cfg):
    land(spark, cfg, "A.parquet", month(spark, 3, 0))
    ingest(spark, cfg, "b_0")
    land(spark, cfg, "B.parquet", month(spark, 4, 10))
    ingest(spark, cfg, "b_1")
    shutil.rmtree(f"{cfg.layout.bronze}/_batch_id=b_1")
    assert [r.rows_out for r in ingest(spark, cfg, "b_2")] == [4]
    assert per_file(spark, cfg) == {"A.parquet": 3, "B.parquet": 4}


def test_repeated_append_replaces_the_batch(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(5).withColumn("_batch_id", F.lit("20230101"))
    append_batch(df, path)
    append_batch(df, path)
    append_batch(df.withColumn("_batch_id", F.lit("0020230102")), path)
    table = read_table(spark, path)
    assert dict(table.dtypes)["_batch_id"] == "string"
    got = {r._batch_id: r["count"] for r in table.groupBy("_batch_id").count().collect()}
    assert got == {"20230101": 5, "0020230102": 5}


def test_fitting_fills_missing_and_refuses_drift(spark):
    df = spark.createDataFrame([(1, "x")], "a int, b string")
    fitted = fit_to_table(df.drop("b"), df.schema)
    assert [tuple(r) for r in fitted.collect()] == [(1, None)]
    assert fitted.schema == df.schema
    with pytest.raises(SchemaDriftError):
        fit_to_table(df.withColumn("new", F.lit(1)), df.schema)
    assert fit_to_table(df.withColumn("new", F.lit(1)), df.schema, True).columns == ["a", "b", "new"]
    for evolve in (False, True):
        with pytest.raises(SchemaDriftError):
            fit_to_table(df.withColumn("a", F.lit("1")), df.schema, evolve)


def test_failed_overwrite_keeps_the_old_table(spark, tmp_path):
    path = str(tmp_path / "t")
    overwrite_table(spark.range(5), path)
    broken = spark.range(5, 90, 1, 4).select(
        F.when(F.col("id") < 80, F.col("id")).otherwise(F.raise_error("half-way")).alias("id")
    )
    for _ in range(2):
        with pytest.raises(Exception, match="half-way"):
            overwrite_table(broken, path)
        assert read_table(spark, path).count() == 5
    for n in (6, 7, 8):
        overwrite_table(spark.range(n), path)
        assert read_table(spark, path).count() == n
    # The last version and the one before it are left, with a marker each.
    assert len(os.listdir(path)) - sum(f.endswith(".crc") for f in os.listdir(path)) == 4


def test_a_column_without_any_value(spark, cfg):
    """Written by a library that gives such a column no type."""
    import pyarrow as pa
    from pyarrow import parquet

    land(spark, cfg, "b.parquet", month(spark, 2, 0))
    table = parquet.read_table(f"{cfg.layout.raw}/b.parquet")
    at_flag = table.column_names.index("store_and_fwd_flag")
    empty = table.set_column(at_flag, "store_and_fwd_flag", pa.nulls(2))
    empty = empty.replace_schema_metadata(None)
    parquet.write_table(empty, f"{cfg.layout.raw}/a.parquet")
    ingest(spark, cfg, "b_1")
    bronze = read_table(spark, cfg.layout.bronze)
    flags = bronze.groupBy("store_and_fwd_flag").count().collect()
    assert {(r[0], r[1]) for r in flags} == {(None, 2), ("N", 2)}
    assert dict(bronze.dtypes)["store_and_fwd_flag"] == "string"


@pytest.mark.parametrize("reader", ["executors", "spark"])
def test_names_that_collide_are_refused(spark, cfg, reader):
    spark.conf.set("spark.sql.caseSensitive", "true")
    try:
        land(spark, cfg, "F.parquet", spark.createDataFrame([(1, 2)], "A int, a int"))
    finally:
        spark.conf.unset("spark.sql.caseSensitive")
    files = list_source_files(spark, cfg.layout.raw)
    with pytest.raises(Exception, match="(?i)case|already exists"):
        read_footers(spark, files.select("path", "file_name"), reader).collect()


@pytest.mark.parametrize("name", ["x{1}.parquet", "y[2].parquet", "z%20.parquet", "é.parquet"])
def test_awkward_names(spark, cfg, name):
    land(spark, cfg, name, month(spark, 2, 0))
    ingest(spark, cfg, "b_1")
    assert per_file(spark, cfg) == {name: 2}
    assert ingest(spark, cfg, "b_2") == []


def test_a_then_b_equals_both(spark, cfg, tmp_path):
    land(spark, cfg, "A.parquet", month(spark, 3, 0))
    ingest(spark, cfg, "b_1")
    land(spark, cfg, "B.parquet", month(spark, 4, 2))
    ingest(spark, cfg, "b_2")
    other = RunConfig(cfg.spec, Layout.under(str(tmp_path / "other"), cfg.layout.raw))
    ingest(spark, other, "b_1")

    def data(c):
        df = read_table(spark, c.layout.bronze).drop("_ingestion_timestamp", "_batch_id")
        return sorted(map(str, df.collect()))

    assert data(cfg) == data(other)


def test_listing_and_ledger_names(spark, cfg):
    land(spark, cfg, "A.parquet", month(spark, 1, 0))
    listed = list_source_files(spark, cfg.layout.raw)
    assert [r.file_name for r in listed.collect()] == ["A.parquet"]
    df = spark.createDataFrame([("x/a%20b+",), ("y/a%20b+",), ("",), (None,)], "_source_file string")
    assert [r[0] for r in file_names(df).collect()] == ["a b+"]


@pytest.mark.parametrize("change", ["filter", "union"])
def test_rows_are_held_against_the_footer(spark, cfg, monkeypatch, change):
    """A file that bronze has short, or double, is not in the ledger, and is read again."""
    land(spark, cfg, "A.parquet", month(spark, 3, 0))
    land(spark, cfg, "B.parquet", month(spark, 4, 10))
    read = stages.read_schema_groups

    def damaged(*args):
        (df,) = read(*args)
        some = df.filter(F.col("_source_file").contains("B.parquet"))
        other = df.filter(~F.col("_source_file").contains("B.parquet"))
        return [other.union(some.filter("fare_amount IS NULL") if change == "filter" else some.union(some))]

    with monkeypatch.context() as m:
        m.setattr(stages, "read_schema_groups", damaged)
        wrong = "0 of 4" if change == "filter" else "8 of 4"
        with pytest.raises(ReconciliationError, match=f"b_1: B.parquet: {wrong}$"):
            ingest(spark, cfg, "b_1")
    assert not os.path.exists(cfg.layout.ledger)
    # The file that bronze lacks altogether is new; the others go into their batch again.
    batches = [("b_1", 3), ("b_2", 4)] if change == "filter" else [("b_1", 7)]
    assert [(r.table, r.rows_out) for r in ingest(spark, cfg, "b_2")] == batches
    assert per_file(spark, cfg) == {"A.parquet": 3, "B.parquet": 4}
    assert ingest(spark, cfg, "b_3") == []


def stored_sizes(cfg, batch):
    folder = f"{cfg.layout.bronze}/_batch_id={batch}"
    return [os.path.getsize(f"{folder}/{f}") for f in os.listdir(folder) if f.endswith(".parquet")]


@pytest.mark.parametrize("files", [1, 300])
def test_stored_files_are_near_the_size_asked_for(spark, cfg, monkeypatch, files):
    monkeypatch.setattr(stages, "SMALL_FILE", 1 << 20)
    rows = month(spark, 1, 0).crossJoin(spark.range(300_000)).drop("id")
    rows = rows.withColumn("fare_amount", F.rand(3)).withColumn("tip_amount", F.rand(4))
    rows.repartition(files).write.parquet(cfg.layout.raw)
    n_bytes = sum(f.stat().st_size for f in os.scandir(cfg.layout.raw) if f.name.endswith(".parquet"))
    size = n_bytes // 4
    cfg = RunConfig(cfg.spec, cfg.layout, file_bytes=size)
    before = len(write_plans(spark))
    assert [r.rows_out for r in ingest(spark, cfg, "b_1")] == [300_000]
    sizes = stored_sizes(cfg, "b_1")
    assert len(sizes) <= 8 and max(sizes) <= 1.7 * size, (size, sizes)
    append = [p for p in write_plans(spark)[before:] if f"{cfg.layout.bronze}," in p]
    assert append and "Sort" not in append[-1] and "Exchange" not in append[-1]


def test_file_plan():
    mb = 1 << 20
    assert file_plan(0, 0, 128 * mb, 8) == (1, 0)
    assert file_plan(3 * mb, 1000, 128 * mb, 8)[0] == 1
    assert file_plan(20 * mb, 1000, 128 * mb, 8)[0] == 5
    assert file_plan(1000 * mb, 1000, 128 * mb, 4) == (8, 192)
    assert file_plan(1000 * mb, 1000, 128 * mb, 400)[0] == 250


def test_scratch_is_deleted_with_its_scope(spark):
    from siltstone.sources.paths import path_exists
    from siltstone.sources.scratch import materialize, scratch_scope

    with scratch_scope(spark):
        inside = materialize(spark.range(3))
        path = os.path.dirname(inside.inputFiles()[0])
        assert inside.count() == 3
    assert not path_exists(spark, path)
    outside = materialize(spark.range(3))
    assert outside.count() == 3


def test_scratch_needs_a_shared_folder_on_a_cluster(spark):
    class Conf:
        def __init__(self, values):
            self.values = values

        def get(self, key, default=None):
            return self.values.get(key, default)

    class Session:
        def __init__(self, **values):
            self.conf = Conf({k.replace("_", "."): v for k, v in values.items()})

    with pytest.raises(RuntimeError):
        scratch_dir(Session(spark_master="yarn"))
    assert os.path.isdir(scratch_dir(Session(spark_master="local[2]")).split("/siltstone/")[0])
    given = {"spark_master": "yarn", "spark_checkpoint_dir": "hdfs:///shared/"}
    assert scratch_dir(Session(**given)).startswith("hdfs:///shared/siltstone/")
