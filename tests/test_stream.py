import dataclasses

import pytest
from taxi_rows import AS_OF, spec
from test_ingest import land, month

from siltstone.config import Layout, RunConfig
from siltstone.plans import stages
from siltstone.plans.stages import clean, ingest
from siltstone.sources.tables import read_table
from siltstone.sources.paths import child_names, delete_folder
from siltstone.streaming.file_stream import ingest_drifting_stream, ingest_stream


@pytest.fixture
def cfg(tmp_path):
    return RunConfig(spec(), Layout.under(str(tmp_path / "lake"), str(tmp_path / "in/raw")))


def count(spark, cfg):
    return read_table(spark, cfg.layout.bronze).count()


def test_each_file_once(spark, cfg):
    first = month(spark, 2, 0)
    land(spark, cfg, "a b.parquet", first)
    ingest_stream(spark, cfg, first.schema, "s_1")
    assert count(spark, cfg) == 2
    ingest_stream(spark, cfg, first.schema, "s_2")
    assert count(spark, cfg) == 2
    land(spark, cfg, "c.parquet", month(spark, 5, 10))
    ingest_stream(spark, cfg, first.schema, "s_3")
    bronze = read_table(spark, cfg.layout.bronze)
    got = bronze.groupBy("_source_file", "_batch_id").count().collect()
    assert {(r[0].rsplit("/", 1)[1], r[1], r[2]) for r in got} == {
        ("a%20b.parquet", "s_1", 2),
        ("c.parquet", "s_3", 5),
    }
    assert dict(bronze.dtypes)["passenger_count"] == "double"


def test_another_table_format(spark, cfg):
    cfg = RunConfig(cfg.spec, cfg.layout, fmt="orc")
    first = month(spark, 3, 0)
    land(spark, cfg, "a.parquet", first)
    ingest_stream(spark, cfg, first.schema, "s_1")
    ingest_stream(spark, cfg, first.schema, "s_2")
    assert read_table(spark, cfg.layout.bronze, "orc").count() == 3
    assert clean(spark, cfg, AS_OF)[-1].rows_out == 3


def test_batches_and_streams_do_not_mix(spark, cfg, tmp_path):
    first = month(spark, 2, 0)
    land(spark, cfg, "a.parquet", first)
    ingest(spark, cfg, "b_1")
    with pytest.raises(ValueError, match="batches"):
        ingest_stream(spark, cfg, first.schema, "s_1")
    other = RunConfig(cfg.spec, Layout.under(str(tmp_path / "other"), cfg.layout.raw))
    ingest_stream(spark, other, first.schema, "s_1")
    land(spark, cfg, "b.parquet", month(spark, 1, 10))
    with pytest.raises(ValueError, match="stream"):
        ingest(spark, other, "b_1")


def drifting(spark, cfg):
    """Files whose columns differ in case, type and presence."""
    first = month(spark, 2, 0)
    land(spark, cfg, "a.parquet", first)
    land(spark, cfg, "b.parquet", first.toDF(*[c.upper() for c in first.columns]))
    as_text = first.withColumn("passenger_count", first["passenger_count"].cast("string"))
    land(spark, cfg, "c.parquet", as_text.drop("airport_fee"))


def by_file(spark, cfg):
    rows = read_table(spark, cfg.layout.bronze).groupBy("_source_file", "_batch_id").count()
    return {r[0].rsplit("/", 1)[1]: (r[1], r[2]) for r in rows.collect()}


def test_drifting_files_are_united(spark, cfg):
    drifting(spark, cfg)
    ingest_drifting_stream(spark, cfg, "s")
    want = {f: ("s-00000000", 2) for f in ("a.parquet", "b.parquet", "c.parquet")}
    assert by_file(spark, cfg) == want
    ingest_drifting_stream(spark, cfg, "t")
    assert by_file(spark, cfg) == want
    land(spark, cfg, "d.parquet", month(spark, 5, 10))
    ingest_drifting_stream(spark, cfg, "t")
    assert by_file(spark, cfg) == want | {"d.parquet": ("s-00000001", 5)}


def test_a_micro_batch_that_is_run_again_does_not_double(spark, cfg, monkeypatch):
    cfg = dataclasses.replace(cfg, max_files_per_write=1)
    drifting(spark, cfg)
    record, calls = stages._record, []

    def crash(*args):
        calls.append(args)
        if len(calls) == 2:
            raise OSError("stopped between the rows and the ledger")
        return record(*args)

    with monkeypatch.context() as m:
        m.setattr(stages, "_record", crash)
        with pytest.raises(Exception, match="stopped"):
            ingest_drifting_stream(spark, cfg, "s")
    stored = by_file(spark, cfg)
    assert len({b for b, _ in stored.values()}) == 2
    ingest_drifting_stream(spark, cfg, "s")
    whole = by_file(spark, cfg)
    assert sorted(whole) == ["a.parquet", "b.parquet", "c.parquet"]
    assert stored.items() <= whole.items() and {n for _, n in whole.values()} == {2}
    # The ledger was written, but the stream did not get to remember it.
    commits = f"{cfg.layout.stream_checkpoint}/commits"
    for number in child_names(spark, commits):
        delete_folder(spark, f"{commits}/{number}")
    ingest_drifting_stream(spark, cfg, "s")
    assert by_file(spark, cfg) == whole


def test_drifting_stream_and_batches_share_a_table(spark, cfg):
    drifting(spark, cfg)
    ingest(spark, cfg, "b")
    land(spark, cfg, "d.parquet", month(spark, 5, 10))
    ingest_drifting_stream(spark, cfg, "s")
    land(spark, cfg, "e.parquet", month(spark, 1, 20))
    ingest(spark, cfg, "b")
    assert count(spark, cfg) == 6 + 5 + 1
    assert {b for b, _ in by_file(spark, cfg).values()} == {"b", "s-00000000", "b.0001"}


def test_a_lost_checkpoint_replaces_no_batch(spark, cfg):
    drifting(spark, cfg)
    ingest_drifting_stream(spark, cfg, "s")
    delete_folder(spark, cfg.layout.stream_checkpoint)
    land(spark, cfg, "d.parquet", month(spark, 5, 10))
    ingest_drifting_stream(spark, cfg, "s")
    assert count(spark, cfg) == 6 + 5
    assert by_file(spark, cfg)["d.parquet"][0] == "s.0001-00000000"
    assert "_batches.s.0001" in child_names(spark, cfg.layout.stream_checkpoint)
