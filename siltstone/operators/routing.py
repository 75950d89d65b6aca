"""Validity rules and the split of a frame by them.

A rule yields TRUE for a bad row, FALSE for a good one and NULL when it cannot
tell. A row is quarantined when any rule is TRUE, valid when all are FALSE, and
unroutable otherwise; the three outputs together are the input.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

VALID, QUARANTINE, UNROUTABLE = "valid", "quarantine", "unroutable"


@dataclass(frozen=True)
class Rule:
    kind: str
    column: str


def not_null(column: str) -> Rule:
    return Rule("not_null", column)


def positive(column: str) -> Rule:
    return Rule("positive", column)


def non_negative(column: str) -> Rule:
    return Rule("non_negative", column)


def not_future(column: str) -> Rule:
    return Rule("not_future", column)


class Split(NamedTuple):
    valid: DataFrame
    quarantine: DataFrame
    unroutable: DataFrame


def local_now(spark: SparkSession) -> str:
    """The session's wall clock as text, read once so that all jobs agree on it."""
    return spark.range(1).select(F.localtimestamp().cast("string")).first()[0]


def _violation(df: DataFrame, rule: Rule, as_of: str | None) -> Column:
    column = F.col(rule.column)
    if rule.kind == "not_null":
        return column.isNull()
    if rule.kind == "positive":
        return column <= 0
    if rule.kind == "non_negative":
        return column < 0
    if rule.kind == "not_future":
        if as_of is None:
            raise ValueError("a not_future rule needs as_of")
        # Same type as the column, so no session-zone conversion is involved.
        return column > F.lit(as_of).cast(df.schema[rule.column].dataType)
    raise ValueError(f"unknown rule kind {rule.kind!r}")


def build_mask(df: DataFrame, rules: Sequence[Rule], as_of: str | None = None) -> Column:
    """Three-valued disjunction of the rules' violations."""
    return reduce(or_, [_violation(df, rule, as_of) for rule in rules])


def route(mask: Column) -> Column:
    """Name of the output a row belongs to."""
    return (
        F.when(mask, F.lit(QUARANTINE))
        .when(mask.isNull(), F.lit(UNROUTABLE))
        .otherwise(F.lit(VALID))
    )


def split_valid(
    df: DataFrame, rules: Sequence[Rule], as_of: str | None = None
) -> Split:
    mask = build_mask(df, rules, as_of)
    return Split(df.filter(~mask), df.filter(mask), df.filter(mask.isNull()))
