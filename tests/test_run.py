import os

import pytest
from pyspark.sql import functions as F
from taxi_rows import AS_OF, at, raw_frame, trip
from test_ingest import land

from siltstone.config import Layout, RunConfig
from siltstone.operators.checks import QualityGateError
from siltstone.plans.run import run_pipeline, run_report
from siltstone.plans import stages
from siltstone.plans.stages import aggregate, clean, ingest, read_rejects, validate
from siltstone.presets import taxi
from siltstone.session import MAX_PARTITIONS, shuffle_partitions
from siltstone.sources.paths import folder_bytes
from siltstone.sources.tables import current_folder, read_table

GOOD = [trip(**at(i), pulocationid=100 + i % 2) for i in range(10)]
REJECTED = [
    trip(**at(20), trip_distance=0.0),
    trip(**at(21), passenger_count=None),
    trip(**at(22), passenger_count=None, fare_amount=-1.0),
]


@pytest.fixture
def cfg(tmp_path):
    layout = Layout.under(str(tmp_path / "lake"), str(tmp_path / "in/raw"))
    return RunConfig(taxi(min_rows=5), layout)


def test_all_stages(spark, cfg):
    land(spark, cfg, "A.parquet", raw_frame(spark, GOOD + REJECTED))
    land(spark, cfg, "B.parquet", raw_frame(spark, GOOD[:4]))
    report = run_report(spark, run_pipeline(spark, cfg, "b_1", AS_OF))
    assert [tuple(r) for r in report.collect()] == [
        ("ingest", "b_1", None, 17),
        ("clean", "quarantine", 17, 2),
        ("clean", "unroutable", 17, 1),
        ("clean", "silver", 14, 10),
        ("validate", "silver", None, 22),
        ("aggregate", "daily_summary", None, 1),
        ("aggregate", "location_summary", None, 2),
        ("aggregate", "monthly_trends", None, 1),
        ("aggregate", "payment_type_summary", None, 1),
    ]
    assert read_rejects(spark, cfg).count() == 2
    assert "_source_file" in read_rejects(spark, cfg).columns
    assert read_rejects(spark, cfg, "unroutable").count() == 1
    silver = read_table(spark, cfg.layout.silver)
    assert silver.columns == [
        "vendor_id",
        "pickup_datetime",
        "dropoff_datetime",
        "passenger_count",
        "trip_distance",
        "rate_code_id",
        "store_and_fwd_flag",
        "pickup_location_id",
        "dropoff_location_id",
        "payment_type",
        "fare_amount",
        "extra",
        "mta_tax",
        "tip_amount",
        "tolls_amount",
        "improvement_surcharge",
        "total_amount",
        "congestion_surcharge",
        "airport_fee",
        "pickup_date",
        "pickup_year",
        "pickup_month",
        "_silver_processed_at",
    ]
    daily = read_table(spark, cfg.layout.gold_table("daily_summary")).first()
    assert (daily.trip_count, float(daily.total_revenue)) == (10, 120.0)
    assert (daily.tipped_trips, daily.tip_percentage) == (10, 100.0)


def test_failed_gate_stops_gold(spark, cfg):
    land(spark, cfg, "A.parquet", raw_frame(spark, GOOD[:3]))
    with pytest.raises(QualityGateError, match="min_rows"):
        run_pipeline(spark, cfg, "b_1", AS_OF)
    assert not os.path.exists(cfg.layout.gold)


def test_null_location_passes_clean_but_not_the_gate(spark, cfg):
    land(spark, cfg, "A.parquet", raw_frame(spark, [*GOOD, trip(pulocationid=None)]))
    ingest(spark, cfg, "b_1")
    assert clean(spark, cfg, AS_OF)[-1].rows_out == 11
    with pytest.raises(QualityGateError, match="pickup_location_id"):
        validate(spark, cfg)


def test_clean_input_empties_the_rejects(spark, cfg):
    land(spark, cfg, "A.parquet", raw_frame(spark, GOOD))
    ingest(spark, cfg, "b_1")
    report = clean(spark, cfg, AS_OF)
    assert [r.rows_out for r in report] == [0, 0, 10]
    assert read_rejects(spark, cfg).count() == 0


def test_partitioned_silver(spark, cfg):
    feb = [trip(**at(i, month=2)) for i in range(3)]
    land(spark, cfg, "A.parquet", raw_frame(spark, GOOD + feb))
    parts = ("pickup_year", "pickup_month")
    cfg = RunConfig(cfg.spec, cfg.layout, silver_partition_by=parts)
    report = run_pipeline(spark, cfg, "b_1", AS_OF)
    assert report[3].rows_out == 13
    assert report[-2] == ("aggregate", "monthly_trends", None, 2)
    silver = current_folder(spark, cfg.layout.silver)
    assert sorted(os.listdir(f"{silver}/pickup_year=2023"))[:2] == [
        "pickup_month=1",
        "pickup_month=2",
    ]


def test_another_table_format(spark, cfg):
    land(spark, cfg, "A.parquet", raw_frame(spark, GOOD + REJECTED))
    cfg = RunConfig(cfg.spec, cfg.layout, fmt="orc")
    report = run_pipeline(spark, cfg, "b_1", AS_OF)
    assert [r.rows_out for r in report[:4]] == [13, 2, 1, 10]
    assert run_pipeline(spark, cfg, "b_2", AS_OF)[0].stage == "clean"


def test_command_line(spark, cfg, capsys):
    from siltstone.__main__ import main

    land(spark, cfg, "A.parquet", raw_frame(spark, GOOD))
    base = os.path.dirname(os.path.dirname(cfg.layout.bronze))
    args = ["--base", base, "--raw", cfg.layout.raw, "--as-of", AS_OF, "--batch-id", "b_1"]
    assert main(["all", *args]) == 1
    assert "min_rows" in capsys.readouterr().err
    assert main(["aggregate", "--preview", "3", *args]) == 0
    shown = capsys.readouterr().out
    assert "daily_summary" in shown and "rank_by_trips" in shown


def test_shuffle_sizing(spark, tmp_path):
    assert shuffle_partitions(0) == 200
    assert shuffle_partitions(2**40) == 8192
    assert shuffle_partitions(100 * 2**40) == MAX_PARTITIONS < 100_000
    assert folder_bytes(spark, str(tmp_path / "none")) == 0
    spark.range(1000).write.parquet(str(tmp_path / "t"))
    assert folder_bytes(spark, str(tmp_path)) > 4000


def tables(spark, cfg):
    out = cfg.layout
    paths = [out.silver, out.rejects, *(out.gold_table(n) for n in GOLD)]
    found = []
    for path in paths:
        df = read_table(spark, path, cfg.fmt).drop("_silver_processed_at")
        found.append(sorted(map(str, df.collect())))
    return found


GOLD = ("daily_summary", "location_summary", "monthly_trends", "payment_type_summary")


@pytest.mark.parametrize("stage", ["clean", "aggregate"])
def test_a_failed_stage_leaves_the_tables_of_the_run_before(spark, cfg, monkeypatch, stage):
    land(spark, cfg, "A.parquet", raw_frame(spark, GOOD + REJECTED))
    run_pipeline(spark, cfg, "b_1", AS_OF)
    before = tables(spark, cfg)
    land(spark, cfg, "B.parquet", raw_frame(spark, [trip(**at(i, day=6)) for i in range(9)]))
    ingest(spark, cfg, "b_2")
    real = stages.write_with_counts

    def breaks(df, path, *args, **more):
        """The second table of a stage fails while it is written."""
        if path in (cfg.layout.silver, cfg.layout.gold_table("location_summary")):
            column = df.columns[0]
            value = F.raise_error("half-way").cast(df.schema[column].dataType)
            df = df.withColumn(column, F.when(F.rand(1) < 2, value))
        return real(df, path, *args, **more)

    if stage == "aggregate":
        clean(spark, cfg, AS_OF)
        before = tables(spark, cfg)
    monkeypatch.setattr(stages, "write_with_counts", breaks)
    with pytest.raises(Exception, match="half-way"):
        clean(spark, cfg, AS_OF) if stage == "clean" else aggregate(spark, cfg)
    assert tables(spark, cfg) == before
    monkeypatch.undo()
    clean(spark, cfg, AS_OF)
    aggregate(spark, cfg)
    assert tables(spark, cfg) != before
