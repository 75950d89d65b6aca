"""What must hold of the physical plans for them to scale."""

import pytest
from plans import physical
from pyspark.sql import functions as F
from taxi_rows import AS_OF

import __spark_entry__ as contract
from siltstone.operators.metrics import summarize_sets
from siltstone.operators.routing import split_valid
from siltstone.plans.gold import metric_sets
from siltstone.plans.stages import clean_rows, conform
from siltstone.presets import LINEITEM


@pytest.fixture(scope="module")
def bronze(spark, sf_dir):
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    lines = lines.withColumns({"_source_file": F.lit("f"), "_batch_id": F.lit("b")})
    return lines


def test_clean_is_one_scan_and_one_shuffle(bronze):
    plan = physical(clean_rows(bronze, LINEITEM, AS_OF))
    assert plan.count("FileScan") == 1
    assert plan.count("Exchange") == 1
    assert "LessThanOrEqual(l_shipdate" in plan or "IsNotNull(l_shipdate)" in plan
    below = plan[plan.index("Exchange") :]
    assert "WindowGroupLimit" in below and "Partial" in below
    # Neither metadata nor derived columns are carried through it.
    assert "_source_file" not in plan and "_batch_id" not in plan
    assert "ship_month" not in below


def test_casts_run_once(bronze):
    plan = physical(clean_rows(bronze, LINEITEM, AS_OF))
    below = plan[plan.index("Exchange") :]
    assert below.count("try_cast(l_discount") == 1
    assert below.count("try_cast(l_extendedprice") == 1


def test_one_pair_of_key_columns_is_read_for_duplicates(spark, sf_dir):
    df = contract.queries()["duplicate_keys"](spark, sf_dir)
    plan = physical(df)
    assert "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int>" in plan
    assert "partial_count" in plan


def test_summaries_read_the_clean_table_once(bronze):
    silver = conform(bronze, LINEITEM)
    plan = physical(summarize_sets(silver, metric_sets(LINEITEM.gold)))
    assert plan.count("FileScan") == 1
    assert plan.count("Exchange") == 1
    assert "l_returnflag" not in plan


def test_split_does_not_shuffle(bronze):
    for part in split_valid(conform(bronze, LINEITEM), LINEITEM.rules, AS_OF):
        assert "Exchange" not in physical(part)


LAZY = (
    "standardize_columns",
    "rename_cast_silver",
    "split_valid",
    "dedup_composite_key",
    "quality_results",
    "daily_summary",
    "monthly_trends",
    "category_summary",
    "silver_end_to_end",
    "gold_daily_from_silver",
)


@pytest.mark.parametrize("name", LAZY)
def test_no_python_over_rows_and_no_cross_join(spark, sf_dir, name):
    plan = physical(contract.queries()[name](spark, sf_dir))
    for bad in ("Python", "InArrow", "InPandas", "CartesianProduct", "BroadcastNestedLoop"):
        assert bad not in plan
