import math
from decimal import Decimal

import pytest

from siltstone.operators.schema import (
    add_date_parts,
    cast_columns,
    lowercase_columns,
    rename_columns,
    standardize,
    union_by_name,
)


def one(df):
    return df.first()[0]


@pytest.mark.parametrize(
    ("value", "source", "target", "expected"),
    [
        (1e12, "double", "decimal(10,2)", None),
        (5_000_000_000, "bigint", "int", None),
        (1e10, "double", "int", None),
        (math.nan, "double", "int", None),
        (math.nan, "double", "decimal(10,2)", None),
        ("abc", "string", "bigint", None),
        ("abc", "string", "double", None),
        ("12", "string", "bigint", 12),
        ("1.0", "string", "bigint", 1),
        ("2.7", "string", "bigint", 2),
        ("-2.7", "string", "int", -2),
        (" 4 ", "string", "bigint", 4),
        ("7.", "string", "int", 7),
        (".5", "string", "int", 0),
        ("0.99999999999999999999", "string", "int", 0),
        ("9223372036854775807.9", "string", "bigint", 2**63 - 1),
        ("9223372036854775808", "string", "bigint", None),
        ("2147483648.1", "string", "int", None),
        ("1e3", "string", "bigint", None),
        ("1.2.3", "string", "bigint", None),
        ("", "string", "bigint", None),
        (".", "string", "bigint", None),
        ("+5", "string", "bigint", 5),
        ("\t12.9\n", "string", "bigint", 12),
        ("1 2", "string", "bigint", None),
        ("12 .5", "string", "bigint", None),
        ("-999999999999999999.9", "string", "bigint", -(10**18) + 1),
        ("1000000000000000000", "string", "bigint", 10**18),
        ("0000000000000000000007", "string", "int", 7),
        ("-128.9", "string", "tinyint", -128),
        ("-129", "string", "tinyint", None),
        ("32768", "string", "smallint", None),
        ("1e3", "string", "double", 1000.0),
        (".5", "string", "double", 0.5),
        (" -Infinity ", "string", "double", -math.inf),
        ("+inf", "string", "float", math.inf),
        ("unknown 1", "string", "double", None),
        ("infer", "string", "double", None),
        (2147483647.9, "double", "int", 2147483647),
        (2147483648.0, "double", "int", None),
        (-2147483648.9, "double", "int", -2147483648),
        (-2147483649.0, "double", "int", None),
        (2147483647, "bigint", "int", 2147483647),
        (-2147483649, "bigint", "int", None),
        (-(2.0**63), "double", "bigint", -(2**63)),
        (2.0**63, "double", "bigint", None),
        (math.inf, "double", "bigint", None),
        (-math.inf, "double", "decimal(10,2)", None),
        (99999999.99, "double", "decimal(10,2)", Decimal("99999999.99")),
        (99999999.995, "double", "decimal(10,2)", None),
        (-1e8, "double", "decimal(10,2)", None),
        (2147483647, "int", "decimal(10,2)", None),
        (7, "int", "double", 7.0),
        (None, "double", "int", None),
        (Decimal(2**63 - 1), "decimal(38,0)", "bigint", 2**63 - 1),
        (Decimal("99999999.994"), "decimal(20,3)", "decimal(10,2)", Decimal("99999999.99")),
        (1.9, "double", "int", 1),
        (-0.5, "double", "int", 0),
        (0.004, "double", "decimal(10,2)", Decimal("0.00")),
        (0.005, "double", "decimal(10,2)", Decimal("0.01")),
        (1.005, "double", "decimal(10,2)", Decimal("1.01")),
    ],
)
def test_cast_values(spark, value, source, target, expected):
    df = spark.createDataFrame([(value,)], f"c {source}")
    assert one(cast_columns(df, {"c": target})) == expected


def test_cast_missing_columns(spark):
    df = spark.range(1)
    assert cast_columns(df, {"x": "int"}, missing="skip").columns == ["id"]
    with pytest.raises(ValueError, match="x"):
        cast_columns(df, {"x": "int"})


def test_lowercase_collision(spark):
    df = spark.createDataFrame([(1, 2)], "A int, b int")
    assert lowercase_columns(df).columns == ["a", "b"]
    with pytest.raises(ValueError, match="case"):
        lowercase_columns(spark.createDataFrame([(1, 2)], "A int, a int"))


def test_standardize_keeps_unlisted_columns(spark):
    df = spark.createDataFrame([("7", "x")], "VendorID string, Flag string")
    out = standardize(df, {"vendorid": "bigint", "absent": "double"})
    assert out.dtypes == [("vendorid", "bigint"), ("flag", "string")]


def test_rename_ignores_absent(spark):
    assert rename_columns(spark.range(1), {"id": "key", "no": "x"}).columns == ["key"]


def test_date_parts(spark):
    df = spark.sql("select timestamp_ntz'2023-02-03 23:59:59' as t")
    row = add_date_parts(df, "t", "p").first()
    assert (str(row.p_date), row.p_year, row.p_month) == ("2023-02-03", 2023, 2)
    assert dict(add_date_parts(df, "t", "p").dtypes)["p_year"] == "int"


def test_union_fills_missing_and_keeps_duplicates(spark):
    a = spark.createDataFrame([(1, "x")], "a int, b string")
    b = spark.createDataFrame([(1,), (1,)], "a int")
    rows = sorted((r.a, r.b or "") for r in union_by_name([a, b]).collect())
    assert rows == [(1, ""), (1, ""), (1, "x")]
