import pytest
from plans import physical

from siltstone.operators.checks import (
    HasColumns,
    MinRows,
    NoDuplicates,
    NoNulls,
    NonNegative,
    NotEmpty,
    QualityGateError,
    gate,
    run_checks,
)

GOOD = [(1, 2.0), (2, None), (3, 0.0)]


@pytest.mark.parametrize(
    ("check", "good", "bad"),
    [
        (NotEmpty(), GOOD, []),
        (MinRows(3), GOOD, GOOD[:2]),
        (NoNulls(("a",)), GOOD, [*GOOD, (None, 1.0)]),
        (NoDuplicates(("a",)), GOOD, [*GOOD, (3, 9.0)]),
        (NoDuplicates(("a", "b")), [*GOOD, (2, 1.0)], [*GOOD, (2, None)]),
        (NonNegative(("b",)), GOOD, [*GOOD, (4, -0.1)]),
    ],
)
def test_each_check_both_ways(spark, check, good, bad):
    frame = lambda rows: spark.createDataFrame(rows, "a int, b double")
    assert all(r.passed for r in gate(run_checks(frame(good), [check])))
    with pytest.raises(QualityGateError):
        gate(run_checks(frame(bad), [check]))


def test_has_columns_is_exact(spark):
    df = spark.createDataFrame(GOOD, "a int, b double")
    results = run_checks(df, [HasColumns(("a", "A"))]).collect()
    assert [(r.column, r.passed) for r in results] == [("a", True), ("A", False)]


def test_missing_columns_fail_instead_of_raising(spark):
    df = spark.createDataFrame(GOOD, "a int, b double")
    checks = [NoNulls(("x",)), NonNegative(("x",)), NoDuplicates(("a", "x"))]
    rows = run_checks(df, checks).collect()
    assert len(rows) == 3
    assert not any(r.passed for r in rows)
    assert all(r.observed is None for r in rows)


def test_observations_on_an_empty_table(spark):
    df = spark.createDataFrame([], "a int, b double")
    rows = run_checks(df, [NoNulls(("a",)), NoDuplicates(("a",))]).collect()
    assert [(r.observed, r.passed) for r in rows] == [(0, True), (0, True)]


def test_gate_names_all_failures(spark):
    df = spark.createDataFrame([(1, -1.0), (1, None)], "a int, b double")
    checks = [NotEmpty(), MinRows(5), NonNegative(("b",)), NoDuplicates(("a",))]
    with pytest.raises(AssertionError) as e:
        gate(run_checks(df, checks), "t")
    for part in ("min_rows", "non_negative(b)", "no_duplicates(a)"):
        assert part in str(e.value)
    assert "not_empty" not in str(e.value)


def test_row_level_checks_share_one_scan(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    checks = [
        NotEmpty(),
        MinRows(1),
        NoNulls(("l_orderkey", "l_tax")),
        NonNegative(("l_tax",)),
        HasColumns(("l_tax",)),
    ]
    plan = physical(run_checks(df, checks))
    assert plan.count("FileScan") == 1
    assert "l_shipdate" not in plan
    assert "hashpartitioning" not in plan
