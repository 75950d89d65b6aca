"""Data-quality checks as data, evaluated together, and the gate.

``run_checks`` returns one row per checked column. All row-level checks share a
single aggregate without a shuffle; each duplicate check adds one grouped pass
over its key columns alone.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class QualityGateError(AssertionError):
    """At least one check failed; the message names all that did."""


@dataclass(frozen=True)
class Check:
    """One expectation about a table."""


@dataclass(frozen=True)
class NotEmpty(Check):
    pass


@dataclass(frozen=True)
class MinRows(Check):
    rows: int


@dataclass(frozen=True)
class NoNulls(Check):
    columns: tuple[str, ...]


@dataclass(frozen=True)
class NonNegative(Check):
    """NULL is not negative."""

    columns: tuple[str, ...]


@dataclass(frozen=True)
class NoDuplicates(Check):
    """NULL keys count as equal."""

    keys: tuple[str, ...]


@dataclass(frozen=True)
class HasColumns(Check):
    """Exact spelling."""

    columns: tuple[str, ...]


RESULT_COLUMNS = ("check", "column", "observed", "expected", "passed")


def _result(check: str, column: str, observed: Column, expected: str, passed: Column):
    return F.struct(
        F.lit(check).alias("check"),
        F.lit(column).alias("column"),
        observed.cast("bigint").alias("observed"),
        F.lit(expected).alias("expected"),
        passed.alias("passed"),
    )


def _columns_of(check: Check) -> tuple[str, ...]:
    return getattr(check, "columns", None) or getattr(check, "keys", ())


def _count_at_least(check: str, minimum: int) -> Column:
    count = F.count(F.lit(1))
    return _result(check, "", count, f">= {minimum}", count >= minimum)


def _count_none(check: str, column: str, condition: Column) -> Column:
    count = F.count_if(condition)
    return _result(check, column, count, "= 0", count == 0)


def _row_level(df: DataFrame, check: Check) -> list[Column]:
    """Result structs over one global aggregate."""
    missing = [c for c in _columns_of(check) if c not in df.columns]
    if isinstance(check, NotEmpty):
        return [_count_at_least("not_empty", 1)]
    if isinstance(check, MinRows):
        return [_count_at_least("min_rows", check.rows)]
    if isinstance(check, HasColumns):
        return [
            _result(
                "has_column", c, F.lit(int(c not in missing)), "= 1", F.lit(c not in missing)
            )
            for c in check.columns
        ]
    if isinstance(check, (NoNulls, NonNegative)):
        name = "no_nulls" if isinstance(check, NoNulls) else "non_negative"
        return [
            _result(name, c, F.lit(None), "= 0", F.lit(False))
            if c in missing
            else _count_none(
                name,
                c,
                F.col(c).isNull() if isinstance(check, NoNulls) else F.col(c) < 0,
            )
            for c in check.columns
        ]
    if isinstance(check, NoDuplicates) and missing:
        return [
            _result("no_duplicates", ",".join(check.keys), F.lit(None), "= 0", F.lit(False))
        ]
    raise TypeError(f"not a row-level check: {check!r}")


def _duplicates(df: DataFrame, check: NoDuplicates) -> DataFrame:
    # Counting per key lets every map task collapse a hot key before the shuffle.
    per_key = df.groupBy(*check.keys).agg(F.count(F.lit(1)).alias("n"))
    extra = F.coalesce(F.sum(F.col("n") - 1), F.lit(0))
    result = _result("no_duplicates", ",".join(check.keys), extra, "= 0", extra == 0)
    return per_key.agg(result.alias("r")).select("r.*")


def run_checks(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """Evaluate all checks: (check, column, observed, expected, passed).

    A check on an absent column fails with a NULL observation.
    """
    grouped = [
        c
        for c in checks
        if isinstance(c, NoDuplicates) and all(k in df.columns for k in c.keys)
    ]
    structs = [s for c in checks if c not in grouped for s in _row_level(df, c)]
    frames = [_duplicates(df, c) for c in grouped]
    if structs:
        frames.insert(
            0,
            # The count keeps this a one-row aggregate when all else is constant.
            df.agg(F.count(F.lit(1)).alias("rows"), F.array(*structs).alias("results"))
            .select(F.explode("results").alias("r"))
            .select("r.*"),
        )
    results = frames[0]
    for frame in frames[1:]:
        results = results.unionAll(frame)
    return results


def gate(results: DataFrame, table: str = "table") -> list:
    """Raise if any check failed; otherwise return the results.

    The rows fetched are one per checked column, never data.
    """
    rows = results.collect()
    failed = [r for r in rows if not r["passed"]]
    if failed:
        raise QualityGateError(
            f"{table}: "
            + "; ".join(
                f"{r['check']}({r['column']}) observed {r['observed']}, "
                f"expected {r['expected']}"
                for r in failed
            )
        )
    return rows
