"""Names and types: the projections between raw, bronze and silver."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ByteType,
    DataType,
    DecimalType,
    DoubleType,
    FloatType,
    IntegerType,
    IntegralType,
    LongType,
    NumericType,
    ShortType,
    StringType,
)


_BITS = {ByteType: 8, ShortType: 16, IntegerType: 32}


def lowercase_columns(df: DataFrame) -> DataFrame:
    """Lower-case every column name; two names that would collide are an error."""
    lowered = [c.lower() for c in df.columns]
    clashes = sorted({c for c in lowered if lowered.count(c) > 1})
    if clashes:
        raise ValueError(f"columns differ only in case: {clashes}")
    return df.toDF(*lowered)


def cast_columns(
    df: DataFrame, types: Mapping[str, str], missing: str = "error"
) -> DataFrame:
    """Cast columns in one projection; a value that does not fit becomes NULL.

    ``missing`` says what happens to columns the frame lacks: "error" or "skip".
    """
    absent = [c for c in types if c not in df.columns]
    if absent and missing == "error":
        raise ValueError(f"columns to cast are missing: {absent}")
    present = {c: t for c, t in types.items() if c not in absent}
    return df.withColumns(
        {c: _fitting(c, df.schema[c].dataType, t) for c, t in present.items()}
    )


def _fitting(name: str, source: DataType, target: str) -> Column:
    """Cast of a column, NULL where the value does not fit.

    ``try_cast`` throws and catches an exception for every number out of range,
    many times the cost of the cast. Comparing first leaves it only the edges.
    """
    column = F.col(name)
    kind = DataType.fromDDL(target)
    cast = column.try_cast(target)
    if isinstance(source, StringType) and isinstance(kind, IntegralType):
        return _whole_number(column, target)
    if isinstance(source, StringType) and isinstance(kind, (DoubleType, FloatType)):
        # Text without a digit or one of these names is no number.
        return F.when(column.rlike(r"[0-9]|^\s*[+-]?(?i:inf|nan)"), cast)
    if not isinstance(source, NumericType) or source == kind:
        return cast
    if isinstance(kind, DecimalType) and kind.precision - kind.scale <= 18:
        limit = 10 ** (kind.precision - kind.scale)
        return F.when((column > -limit) & (column < limit), cast)
    if isinstance(kind, LongType) and isinstance(source, (DoubleType, FloatType)):
        return F.when((column >= -(2.0**63)) & (column < 2.0**63), cast)
    if type(kind) in _BITS:
        # Fractions are cut, so anything short of the next whole number fits.
        limit = 2 ** (_BITS[type(kind)] - 1)
        return F.when((column > -limit - 1) & (column < limit), cast)
    return cast


def _whole_number(column: Column, target: str) -> Column:
    """Text as a whole number, its fraction cut off; exponents are not numbers here.

    Plain digits, which nearly all such text is, are told by one pattern and cast without
    failing. Only the rest (no digit before the point, 19 digits and more, or no number)
    goes through the patterns for every spelling.
    """
    usual = column.rlike(r"^\s*[+-]?[0-9]{1,18}(\.[0-9]*)?\s*$")
    number = F.substring_index(column, ".", 1).try_cast("bigint")
    kind = type(DataType.fromDDL(target))
    if kind in _BITS:
        limit = 2 ** (_BITS[kind] - 1)
        number = F.when(number.between(-limit, limit - 1), number.try_cast(target))
    plain = column.rlike(r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)\s*$")
    whole = F.regexp_extract(column, r"^\s*([+-]?[0-9]*)", 1)
    digits = F.when(whole.rlike("[0-9]$"), whole).otherwise("0")
    return F.when(usual, number).when(plain, digits.try_cast(target))


def standardize(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Bring one raw frame to the common spelling and types."""
    return cast_columns(lowercase_columns(df), types, missing="skip")


def rename_columns(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Rename the columns that are present."""
    return df.withColumnsRenamed(dict(names))


def add_date_parts(df: DataFrame, ts: str, prefix: str) -> DataFrame:
    """Add ``<prefix>_date``, ``<prefix>_year`` and ``<prefix>_month``."""
    return df.withColumns(
        {
            f"{prefix}_date": F.to_date(ts),
            f"{prefix}_year": F.year(ts),
            f"{prefix}_month": F.month(ts),
        }
    )


def union_by_name(frames: Sequence[DataFrame]) -> DataFrame:
    """Stack frames by column name, filling absent columns with NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def stamp(df: DataFrame, column: str, value=None) -> DataFrame:
    """Add a metadata column: a constant, or the time of the run."""
    return df.withColumn(
        column, F.current_timestamp() if value is None else F.lit(value)
    )
