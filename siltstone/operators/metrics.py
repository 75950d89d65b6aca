"""Grouped metrics, one key set at a time or several in one scan."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltstone.functions import growth_pct

SET = "_set"


@dataclass(frozen=True)
class Metric:
    """A named aggregate: rows, sum, avg or positive (count of values > 0)."""

    name: str
    kind: str
    column: str | None = None
    scale: int = 2

    def expr(self) -> Column:
        if self.kind == "rows":
            out = F.count(F.lit(1))
        elif self.kind == "sum":
            out = F.round(F.sum(self.column), self.scale)
        elif self.kind == "avg":
            out = F.round(F.avg(self.column), self.scale)
        elif self.kind == "positive":
            out = F.count_if(F.col(self.column) > 0)
        else:
            raise ValueError(f"unknown metric kind {self.kind!r}")
        return out.alias(self.name)


@dataclass(frozen=True)
class MetricSet:
    keys: tuple[str, ...]
    metrics: tuple[Metric, ...]


def summarize(df: DataFrame, wanted: MetricSet) -> DataFrame:
    """Group by the keys (NULL is a group) and compute the metrics."""
    return df.groupBy(*wanted.keys).agg(*[m.expr() for m in wanted.metrics])


def summarize_sets(df: DataFrame, sets: Mapping[str, MetricSet]) -> DataFrame:
    """All key sets in one scan, tagged by the set's name in ``_set``.

    GROUPING SETS reads the input once; map-side aggregation leaves as many rows
    to shuffle as the separate queries would.
    """
    keys = list(dict.fromkeys(k for s in sets.values() for k in s.keys))
    metrics: dict[str, Metric] = {}
    for m in (m for s in sets.values() for m in s.metrics):
        if metrics.setdefault(m.name, m) != m:
            raise ValueError(f"metric {m.name!r} is defined in two ways")
    tags = {_grouping_id(keys, s.keys): name for name, s in sets.items()}
    if len(tags) < len(sets):
        raise ValueError("two sets have the same keys")
    grouped = df.groupingSets([list(s.keys) for s in sets.values()], *keys).agg(
        F.grouping_id().alias("_grouping"), *[m.expr() for m in metrics.values()]
    )
    tag = F.lit(None).cast("string")
    for gid, name in tags.items():
        tag = F.when(F.col("_grouping") == gid, F.lit(name)).otherwise(tag)
    return grouped.withColumn(SET, tag).drop("_grouping")


def pick_set(combined: DataFrame, name: str, wanted: MetricSet) -> DataFrame:
    """The part of a ``summarize_sets`` result that belongs to one set."""
    return combined.filter(F.col(SET) == name).select(
        *wanted.keys, *[m.name for m in wanted.metrics]
    )


def _grouping_id(keys: Sequence[str], present: Sequence[str]) -> int:
    """Spark's grouping id: one bit per key, set when the key is aggregated away."""
    return int("".join("0" if k in present else "1" for k in keys), 2)


def add_period_growth(
    df: DataFrame, period: Sequence[str], value: str, prev_name: str, growth_name: str
) -> DataFrame:
    """Previous existing period's value and the growth against it.

    For frames with one row per calendar period, whose number is bounded by the
    range of dates: the window runs in a single task.
    """
    w = Window.orderBy(*period)
    return df.withColumn(prev_name, F.lag(value).over(w)).withColumn(
        growth_name, growth_pct(value, prev_name)
    )


def top_k(df: DataFrame, rank_column: str, k: int) -> DataFrame:
    """Rows ranked ``k`` or better, ties included."""
    return df.filter(F.col(rank_column) <= k)


def preview(df: DataFrame, n: int = 20) -> DataFrame:
    """The first ``n`` rows."""
    return df.limit(n)
