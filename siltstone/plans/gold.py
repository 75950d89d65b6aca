"""The four summary tables, alone or together in one scan of the clean table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.config import GoldColumns
from siltstone.functions import label_codes, pct
from siltstone.operators.metrics import (
    SET,
    Metric,
    MetricSet,
    add_period_growth,
    pick_set,
    summarize,
    summarize_sets,
)
from siltstone.operators.ranking import add_ranks
from siltstone.sources.scratch import materialize

DAILY, LOCATION, MONTHLY, CATEGORY = (
    "daily_summary",
    "location_summary",
    "monthly_trends",
    "payment_type_summary",
)


def metric_sets(c: GoldColumns) -> dict[str, MetricSet]:
    trips = Metric("trip_count", "rows")
    revenue = Metric("total_revenue", "sum", c.amount)
    avg_revenue = Metric("avg_revenue", "avg", c.amount)
    avg_distance = Metric("avg_distance", "avg", c.distance)
    avg_tip = Metric("avg_tip", "avg", c.tip)
    tipped = Metric("tipped_trips", "positive", c.tip)
    total = Metric("total_trips", "rows")
    passengers = Metric("avg_passengers", "avg", c.passengers, scale=1)
    return {
        DAILY: MetricSet(
            (c.date,), (trips, revenue, avg_revenue, avg_distance, avg_tip, tipped, total)
        ),
        LOCATION: MetricSet((c.location,), (trips, revenue, avg_revenue, avg_distance)),
        MONTHLY: MetricSet((c.year, c.month), (trips, revenue, avg_revenue, passengers)),
        CATEGORY: MetricSet((c.category,), (trips, revenue, avg_tip)),
    }


def _finish_daily(df: DataFrame, c: GoldColumns, *_) -> DataFrame:
    return df.withColumn("tip_percentage", pct("tipped_trips", "total_trips")).orderBy(
        c.date
    )


def _finish_location(df: DataFrame, c: GoldColumns, stored: bool) -> DataFrame:
    ranks = {"rank_by_trips": "trip_count", "rank_by_revenue": "total_revenue"}
    return add_ranks(df, ranks, c.rank_mode, stored)


def _finish_monthly(df: DataFrame, c: GoldColumns, *_) -> DataFrame:
    # The window has the periods sorted already, so that the sort costs nothing; without
    # it the order would be lost where the growth is not asked for.
    return add_period_growth(
        df, (c.year, c.month), "total_revenue", "prev_month_revenue", "revenue_growth_pct"
    ).orderBy(c.year, c.month)


def _finish_category(df: DataFrame, c: GoldColumns, *_) -> DataFrame:
    return df.withColumn(
        "payment_label", label_codes(c.category, c.labels, c.default_label)
    ).orderBy(F.desc("trip_count"), c.category)


_FINISH: dict[str, Callable[[DataFrame, GoldColumns, bool], DataFrame]] = {
    DAILY: _finish_daily,
    LOCATION: _finish_location,
    MONTHLY: _finish_monthly,
    CATEGORY: _finish_category,
}


def _single(df: DataFrame, name: str, c: GoldColumns) -> DataFrame:
    return _FINISH[name](summarize(df, metric_sets(c)[name]), c, False)


def daily_summary(df: DataFrame, c: GoldColumns) -> DataFrame:
    """Volume, revenue, distance and tips per day."""
    return _single(df, DAILY, c)


def location_summary(df: DataFrame, c: GoldColumns) -> DataFrame:
    """Volume and revenue per location, with dense ranks by both."""
    return _single(df, LOCATION, c)


def monthly_trends(df: DataFrame, c: GoldColumns) -> DataFrame:
    """Volume and revenue per month, with growth against the previous month."""
    return _single(df, MONTHLY, c)


def category_summary(df: DataFrame, c: GoldColumns) -> DataFrame:
    """Volume, revenue and mean tip per category code, with its label."""
    return _single(df, CATEGORY, c)


def gold_tables(df: DataFrame, c: GoldColumns) -> dict[str, DataFrame]:
    """All four tables from one scan of ``df``.

    The grouped rows of all sets are stored once, by set, and each table is
    finished from its own part. Tables whose roles are the same columns (a location that
    is the category, say) share a set.
    """
    sets = metric_sets(c)
    shared: dict[tuple[str, ...], MetricSet] = {}
    for wanted in sets.values():
        same = shared.get(wanted.keys, MetricSet(wanted.keys, ()))
        more = tuple(m for m in wanted.metrics if m not in same.metrics)
        shared[wanted.keys] = MetricSet(wanted.keys, same.metrics + more)
    names = {keys: str(i) for i, keys in enumerate(shared)}
    named = {names[keys]: s for keys, s in shared.items()}
    combined = materialize(summarize_sets(df, named), partition_by=(SET,))
    return {
        name: _FINISH[name](pick_set(combined, names[wanted.keys], wanted), c, True)
        for name, wanted in sets.items()
    }
