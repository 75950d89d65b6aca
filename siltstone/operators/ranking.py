"""Global dense ranks that do not need the table in one task."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, NumericType, TimestampType

from siltstone.sources.scratch import materialize

# Rows of a value are spread over several tasks beyond this share of all rows, if they
# are more than a task's fill anyway; there can be no more than the share's reciprocal
# of such values.
HOT_SHARE = 0.001
TASK_ROWS = 200_000

# Distinct values are ranked in up to so many ranges, cut at quantiles of the rows.
RANGES = 1024
WITH_QUANTILES = (NumericType, DateType, TimestampType)


def window_rank(df: DataFrame, column: str, name: str) -> DataFrame:
    """``dense_rank`` over the whole frame, largest value first, NULL last."""
    w = Window.orderBy(F.col(column).desc())
    return df.withColumn(name, F.dense_rank().over(w))


class RankPlan(NamedTuple):
    """What is known of a column before its rows are ranked.

    ``cuts`` are values in ascending order. The range of a value is the number of cuts
    that are greater (NULL: one more than the cuts), and ``offsets`` holds how many
    distinct values lie in the ranges before. ``spread`` lists (value, tasks) of the
    values whose rows go to several tasks.
    """

    column: str
    cuts: list
    offsets: list[int]
    spread: list[tuple]

    def range_of(self, value: Column) -> Column:
        return F.when(value.isNull(), len(self.cuts) + 1).otherwise(
            _greater(value, self.cuts, 0, len(self.cuts))
        )

    def tasks(self, value: Column) -> Column:
        out = F.lit(1)
        for hot, n in self.spread:
            out = F.when(value.eqNullSafe(F.lit(hot)), n).otherwise(out)
        return out


def _greater(value: Column, cuts: list, lo: int, hi: int) -> Column:
    """How many cuts are greater than the value, by binary search among cuts[lo:hi]."""
    if lo == hi:
        return F.lit(len(cuts) - lo)
    mid = (lo + hi) // 2
    return F.when(value < F.lit(cuts[mid]), _greater(value, cuts, lo, mid)).otherwise(
        _greater(value, cuts, mid + 1, hi)
    )


def _cuts(df: DataFrame, columns: list[str], rows: int) -> list[list]:
    """Quantiles of each column that cut the rows into ranges of a task's fill.

    NaN is greater than all numbers and cannot be told by comparing with it.
    """
    ranges = min(RANGES, rows // TASK_ROWS)
    kinds = [df.select(f"`{c}`").schema[0].dataType for c in columns]
    wanted = [i for i, kind in enumerate(kinds) if isinstance(kind, WITH_QUANTILES)]
    cuts: list[list] = [[] for _ in columns]
    if ranges > 1 and wanted:
        shares = [n / ranges for n in range(1, ranges)]
        found = df.agg(
            *[F.percentile_approx(f"`{columns[i]}`", shares, 10 * ranges) for i in wanted]
        ).first()
        for i, quantiles in zip(wanted, found):
            cuts[i] = sorted({v for v in quantiles or [] if v == v})
    return cuts


def _distinct(df: DataFrame, columns: list[str]) -> DataFrame:
    """(set, v0, v1, ..., copies): the distinct values of each column, in one pass."""
    named = df.select(*[F.col(f"`{c}`").alias(f"v{i}") for i, c in enumerate(columns)])
    sets = [[f"v{i}"] for i in range(len(columns))]
    grouped = named.groupingSets(sets, *named.columns).agg(
        F.grouping_id().alias("_grouping"), F.count(F.lit(1)).alias("copies")
    )
    # A grouping id has a bit per column, set where the column is aggregated away.
    ids = {(1 << len(columns)) - 1 - (1 << (len(columns) - 1 - i)): i for i in range(len(columns))}
    tag = F.lit(None).cast("int")
    for gid, i in ids.items():
        tag = F.when(F.col("_grouping") == gid, F.lit(i)).otherwise(tag)
    return grouped.withColumn("set", tag).drop("_grouping")


def plan_ranks(df: DataFrame, columns: list[str], rows: int) -> list[RankPlan]:
    """The plans of the columns, from one pass over the stored rows of ``df``.

    Another one finds the quantiles where there are more rows than a task takes. To the
    driver come a count per range and column, and the hot values.
    """
    plans = [RankPlan(c, cuts, [], []) for c, cuts in zip(columns, _cuts(df, columns, rows))]
    hot = max(TASK_ROWS, int(rows * HOT_SHARE))
    is_hot = F.col("copies") > hot
    place, values = F.lit(0), []
    for i, plan in enumerate(plans):
        place = F.when(F.col("set") == i, plan.range_of(F.col(f"v{i}"))).otherwise(place)
        value = F.struct(F.col(f"v{i}").alias("value"), "copies")
        of_set = F.when(is_hot & (F.col("set") == i), value)
        values.append(F.collect_list(of_set).alias(f"hot{i}"))
    found = (
        _distinct(df, columns)
        .groupBy("set", place.alias("range"))
        .agg(F.count(F.lit(1)).alias("values"), *values)
        .collect()
    )
    for i, plan in enumerate(plans):
        own = {r["range"]: r for r in found if r["set"] == i}
        before = 0
        for n in range(len(plan.cuts) + 2):
            plan.offsets.append(before)
            if n in own:
                before += own[n]["values"]
                plan.spread.extend(
                    (h["value"], -(-h["copies"] // hot)) for h in own[n][f"hot{i}"]
                )
    return plans


def distributed_ranks(df: DataFrame, ranks: dict[str, str], rows: int) -> DataFrame:
    """The same ranks as ``window_rank``'s, without a single-partition step over the rows.

    ``df`` must be a scan of so many stored rows. The distinct values of each column are cut into
    ranges; a value's rank is its place in its range plus the number of values in the
    ranges before. Rows are joined to the values; those of a hot value go to several
    tasks, to each of which its rank is sent.
    """
    columns = list(dict.fromkeys(ranks.values()))
    plans = {p.column: p for p in plan_ranks(df, columns, rows)}
    out = df
    for name, column in ranks.items():
        plan, value = plans[column], F.col("_value")
        distinct = df.select(F.col(f"`{column}`").alias("_value")).distinct()
        in_range = Window.partitionBy("_range").orderBy(value.desc())
        place = F.row_number().over(in_range) + F.get(F.lit(plan.offsets), F.col("_range"))
        ranked = distinct.withColumn("_range", plan.range_of(value)).select(
            "_value", place.cast("int").alias(name)
        )
        key = F.col(f"`{column}`")
        same = key.eqNullSafe(value)
        if plan.spread:
            # Whichever of a value's tasks a row goes to, the rank is the same.
            task = F.monotonically_increasing_id() % plan.tasks(key)
            out = out.withColumn("_to", task.cast("int"))
            tasks = F.sequence(F.lit(0), plan.tasks(value) - 1)
            ranked = ranked.withColumn("_task", F.explode(tasks))
            same &= F.col("_to") == F.col("_task")
        out = out.join(ranked, same).drop("_value", "_task", "_to")
    return out


def add_ranks(
    df: DataFrame,
    ranks: dict[str, str],
    mode: str = "distributed",
    stored: bool = False,
) -> DataFrame:
    """Add a dense rank column (name -> ranked column) for each entry.

    ``mode`` is "distributed", or "window", which puts all rows into one task and is for
    frames of bounded size. Both give the same ranks. ``stored`` says that ``df`` is a
    scan of stored rows and need not be stored; otherwise it is, once for all ranks.
    Numbers, dates and times are ranked in ranges; the distinct values of another type
    (text, say) are sorted in one task.
    """
    if mode not in ("window", "distributed"):
        raise ValueError(f"unknown rank mode {mode!r}")
    if mode == "window":
        for name, column in ranks.items():
            df = window_rank(df, column, name)
        return df
    if stored:
        rows = df.count()
    else:
        seen = Observation()
        df = materialize(df.observe(seen, F.count(F.lit(1)).alias("rows")))
        rows = seen.get["rows"]
    return distributed_ranks(df, ranks, rows)
