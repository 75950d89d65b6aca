"""One query per operator, each over whole tables.

There is no trip table among the test tables; order lines stand in for trips
(ship date = pickup time, supplier = location, line number = payment code).
"""

from __future__ import annotations

import dataclasses
import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DecimalType, TimestampNTZType, TimestampType

from siltstone.config import INGEST_METADATA, PROCESSED_AT, GoldColumns, Layout, RunConfig
from siltstone.functions import base_name, decode_path, label_codes
from siltstone.operators.checks import (
    HasColumns,
    MinRows,
    NoDuplicates,
    NoNulls,
    NonNegative,
    NotEmpty,
    run_checks,
)
from siltstone.operators.dedup import dedup, duplicate_keys
from siltstone.operators.metrics import Metric, MetricSet, preview, summarize, top_k
from siltstone.operators.ranking import add_ranks
from siltstone.operators.routing import build_mask, route, split_valid
from siltstone.operators.schema import (
    add_date_parts,
    cast_columns,
    lowercase_columns,
    rename_columns,
    standardize,
    union_by_name,
)
from siltstone.plans.gold import (
    category_summary,
    daily_summary,
    location_summary,
    monthly_trends,
)
from siltstone.plans.run import run_pipeline, run_report
from siltstone.plans.stages import (
    SMALL_FILE,
    aggregate,
    clean,
    clean_rows,
    conform,
    ingest,
    read_rejects,
)
from siltstone.presets import PAYMENT_LABELS, lineitem
from siltstone.sources.files import (
    file_names,
    list_source_files,
    read_footers,
    select_new_files,
)
from siltstone.sources.ledger import read_ledger
from siltstone.sources.paths import delete_folder
from siltstone.sources.scratch import scratch_dir
from siltstone.sources.snapshots import read_snapshot
from siltstone.sources.tables import read_table
from siltstone.streaming.file_stream import ingest_drifting_stream, ingest_stream

# Latest event time the not_future rule accepts; part of the data lies after it.
AS_OF = "2000-06-30 00:00:00"

SPEC = lineitem()
GOLD = SPEC.gold


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def present(df: DataFrame) -> DataFrame:
    """Types that read the same in other engines: decimals as double, times as text."""
    text = (DateType, TimestampType, TimestampNTZType)
    return df.select(
        *[
            F.col(f.name).cast("double").alias(f.name)
            if isinstance(f.dataType, DecimalType)
            else F.col(f.name).cast("string").alias(f.name)
            if isinstance(f.dataType, text)
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as raw trips; the quantity of line 7 is unknown."""
    unknown = F.nullif("l_linenumber", F.lit(7)).cast("double")
    return load(spark, sf_dir, "lineitem").withColumn("l_quantity", unknown)


def with_tip(df: DataFrame) -> DataFrame:
    """The tax rate turned into an amount, which plays the tip."""
    return df.withColumn("tax", (F.col("price") * F.col("tax")).cast("decimal(10,2)"))


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_tip(conform(order_lines(spark, sf_dir), SPEC))


# --- schema ---------------------------------------------------------------


def q_standardize_columns(spark, sf_dir):
    """Shouting names and text ids, brought to the common form."""
    raw = load(spark, sf_dir, "lineitem")
    raw = raw.toDF(*[c.upper() for c in raw.columns])
    raw = cast_columns(raw, {"L_ORDERKEY": "string", "L_LINENUMBER": "string"})
    # Ids written as decimals, with blanks, or not numbers at all.
    odd = (
        F.when(F.col("L_PARTKEY") % 4 == 0, F.concat("L_ORDERKEY", F.lit(".0")))
        .when(F.col("L_PARTKEY") % 4 == 1, F.concat(F.lit(" "), "L_ORDERKEY", F.lit(".7 ")))
        .when(F.col("L_PARTKEY") % 4 == 2, F.concat(F.lit("id "), "L_ORDERKEY"))
        .otherwise(F.col("L_ORDERKEY"))
    )
    return present(standardize(raw.withColumn("L_ORDERKEY", odd), SPEC.raw_casts))


def q_lowercase_columns(spark, sf_dir):
    raw = load(spark, sf_dir, "customer")
    return lowercase_columns(raw.toDF(*[c.title() for c in raw.columns]))


def q_cast_out_of_range(spark, sf_dir):
    """Values beyond the target type become NULL, fractions are cut or rounded."""
    raw = load(spark, sf_dir, "orders").select(
        "o_orderkey",
        (F.col("o_orderkey") * 1_000_000).alias("big_id"),
        (F.col("o_totalprice") * 1_000).alias("big_amount"),
        (F.col("o_totalprice") / 4).alias("quarter"),
    )
    return present(
        cast_columns(
            raw, {"big_id": "int", "big_amount": "decimal(10,2)", "quarter": "int"}
        )
    )


def q_rename_cast_silver(spark, sf_dir):
    renamed = rename_columns(load(spark, sf_dir, "lineitem"), SPEC.renames)
    return present(cast_columns(renamed, SPEC.casts))


def q_date_parts(spark, sf_dir):
    return present(add_date_parts(load(spark, sf_dir, "orders"), "o_orderdate", "order"))


def q_union_by_name_drift(spark, sf_dir):
    """Customers and suppliers in one frame; suppliers have no market segment."""
    customers = load(spark, sf_dir, "customer")
    suppliers = load(spark, sf_dir, "supplier")
    return union_by_name(
        [
            rename_columns(df, {c: c[2:] for c in df.columns}).withColumnRenamed(
                key, "partykey"
            )
            for df, key in ((customers, "custkey"), (suppliers, "suppkey"))
        ]
    )


# --- files ----------------------------------------------------------------


def q_new_files_anti_join(spark, sf_dir):
    """Page files not among the ones that documents came from."""
    pages = load(spark, sf_dir, "pages").select(
        "page_id", base_name("url").alias("file_name")
    )
    seen = load(spark, sf_dir, "documents").select(
        F.concat(F.lit("/raw/"), F.col("lang"), F.lit("/"), "doc_id").alias("path")
    )
    return select_new_files(pages, file_names(seen, "path")).select("page_id", "file_name")


def q_ledger_file_names(spark, sf_dir):
    """Distinct base names of stored source paths, which are URI-encoded."""
    encoded = load(spark, sf_dir, "events").select(
        F.concat(
            F.lit("file:/raw/"),
            F.when(F.col("event_type") != "error", F.col("event_type")),
            F.lit("%20+"),
            "user_id",
            F.lit(".parquet"),
        ).alias("uri")
    )
    return file_names(encoded, "uri")


# --- routing and duplicates -----------------------------------------------


def _split(spark, sf_dir, part):
    return present(getattr(split_valid(trips(spark, sf_dir), SPEC.rules, AS_OF), part))


def q_split_valid(spark, sf_dir):
    return _split(spark, sf_dir, "valid")


def q_split_quarantine(spark, sf_dir):
    return _split(spark, sf_dir, "quarantine")


def q_split_unroutable(spark, sf_dir):
    return _split(spark, sf_dir, "unroutable")


def q_route_counts(spark, sf_dir):
    df = trips(spark, sf_dir)
    routed = df.select(route(build_mask(df, SPEC.rules, AS_OF)).alias("route"))
    return routed.groupBy("route").agg(F.count(F.lit(1)).alias("rows"))


def q_dedup_composite_key(spark, sf_dir):
    return present(dedup(trips(spark, sf_dir), SPEC.dedup_keys))


def q_duplicate_keys(spark, sf_dir):
    return duplicate_keys(trips(spark, sf_dir), SPEC.dedup_keys)


# --- quality --------------------------------------------------------------


def q_quality_results(spark, sf_dir):
    """The preset's suite on order lines before they are cleaned."""
    return run_checks(trips(spark, sf_dir), SPEC.checks)


def q_quality_customers(spark, sf_dir):
    """Every kind of check on customers, some of whose balances are negative."""
    return run_checks(
        load(spark, sf_dir, "customer"),
        (
            NotEmpty(),
            MinRows(1_000_000_000),
            NoNulls(("c_custkey", "c_name")),
            NonNegative(("c_acctbal",)),
            NoDuplicates(("c_custkey",)),
            NoDuplicates(("c_nationkey", "c_mktsegment")),
            HasColumns(("c_acctbal", "C_ACCTBAL")),
        ),
    )


# --- summaries ------------------------------------------------------------


def q_daily_summary(spark, sf_dir):
    return present(daily_summary(trips(spark, sf_dir), GOLD))


def q_location_summary(spark, sf_dir):
    return present(location_summary(trips(spark, sf_dir), GOLD))


def q_monthly_trends(spark, sf_dir):
    return present(monthly_trends(trips(spark, sf_dir), GOLD))


def q_category_summary(spark, sf_dir):
    return present(category_summary(trips(spark, sf_dir), GOLD))


def q_top_k_locations(spark, sf_dir):
    ranked = location_summary(trips(spark, sf_dir), GOLD)
    return present(top_k(ranked, "rank_by_revenue", 10))


def q_preview_days(spark, sf_dir):
    """First ten days of the daily table, which comes sorted."""
    return present(preview(daily_summary(trips(spark, sf_dir), GOLD), 10))


def q_label_codes(spark, sf_dir):
    """Label of every order line's code; unknown and NULL codes are Other."""
    return load(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        F.nullif("l_linenumber", F.lit(2)).alias("code"),
        label_codes("code", PAYMENT_LABELS, "Other").alias("label"),
    )


def q_global_rank_scaled(spark, sf_dir):
    """Ranks of all parts by lines and revenue, without a single-task window."""
    parts = summarize(
        trips(spark, sf_dir),
        MetricSet(
            ("part_id",),
            (Metric("trip_count", "rows"), Metric("total_revenue", "sum", "price")),
        ),
    )
    ranks = {"rank_by_trips": "trip_count", "rank_by_revenue": "total_revenue"}
    return present(add_ranks(parts, ranks, "distributed"))


def q_order_month_trends(spark, sf_dir):
    """The monthly table of another dataset: orders, by order date."""
    orders = add_date_parts(load(spark, sf_dir, "orders"), "o_orderdate", "order")
    orders = cast_columns(orders, {"o_totalprice": "decimal(10,2)"})
    columns = GoldColumns(
        year="order_year",
        month="order_month",
        amount="o_totalprice",
        passengers="o_custkey",
    )
    return present(monthly_trends(orders, columns))


def q_event_day_summary(spark, sf_dir):
    """The daily table of another dataset: events, by their time."""
    events = add_date_parts(load(spark, sf_dir, "events"), "ts", "event")
    events = cast_columns(events, {"value": "decimal(10,2)"})
    columns = GoldColumns(
        date="event_date", amount="value", distance="value", tip="value"
    )
    return present(daily_summary(events, columns))


# --- stages ---------------------------------------------------------------


def q_silver_end_to_end(spark, sf_dir):
    """Rename, cast, route and deduplicate in one plan."""
    silver = clean_rows(order_lines(spark, sf_dir), SPEC, AS_OF)
    return present(silver.drop(PROCESSED_AT))


def _gold_from_silver(spark, sf_dir, summary):
    silver = with_tip(clean_rows(order_lines(spark, sf_dir), SPEC, AS_OF))
    return present(summary(silver, GOLD))


def q_gold_daily_from_silver(spark, sf_dir):
    return _gold_from_silver(spark, sf_dir, daily_summary)


def q_gold_location_from_silver(spark, sf_dir):
    return _gold_from_silver(spark, sf_dir, location_summary)


def q_gold_monthly_from_silver(spark, sf_dir):
    return _gold_from_silver(spark, sf_dir, monthly_trends)


def q_gold_category_from_silver(spark, sf_dir):
    return _gold_from_silver(spark, sf_dir, category_summary)


def _positions(df: DataFrame, *columns: str) -> DataFrame:
    """Rows with their place in the frame's own order."""
    placed = df.select(*columns, F.monotonically_increasing_id().alias("at"))
    place = F.row_number().over(Window.orderBy("at")).alias("place")
    return placed.select(*columns, place)


def q_order_of_months(spark, sf_dir):
    """Place of each month in the monthly table as it comes: a row per month."""
    table = monthly_trends(trips(spark, sf_dir), GOLD)
    return _positions(table, "ship_year", "ship_month")


def q_order_of_categories(spark, sf_dir):
    """Place of each category in its table as it comes: a row per category."""
    table = category_summary(trips(spark, sf_dir), GOLD)
    return _positions(table, "line_number", "trip_count")


def drifting_files(spark: SparkSession, sf_dir: str) -> RunConfig:
    """Order lines as raw files whose schemas differ, in a layout of their own.

    Lines 1-2 have int ids and shouting names, 3-5 are as they come, and 6-7 have
    no tax column.
    """
    layout = Layout.under(scratch_dir(spark))
    lines = order_lines(spark, sf_dir)
    early = lines.filter("l_linenumber <= 2")
    early = cast_columns(early, {"l_orderkey": "int", "l_quantity": "bigint"})
    late = F.coalesce(F.col("l_linenumber") > 5, F.lit(True))
    variants = (
        early.toDF(*[c.upper() for c in early.columns]),
        lines.filter(~late & (F.col("l_linenumber") > 2)),
        lines.filter(late).drop("l_tax"),
    )
    for variant in variants:
        variant.write.mode("append").parquet(layout.raw)
    return RunConfig(SPEC, layout)


def _bronze(spark, cfg):
    bronze = read_table(spark, cfg.layout.bronze)
    return present(bronze.drop("_ingestion_timestamp", "_source_file"))


def q_ingest_batch(spark, sf_dir):
    """Drifting files ingested twice; the second run finds nothing new."""
    cfg = drifting_files(spark, sf_dir)
    ingest(spark, cfg, "batch_1")
    ingest(spark, cfg, "batch_2")
    return _bronze(spark, cfg)


def q_ingest_many_batches(spark, sf_dir):
    """Drifting files, a plan for each, in one batch of one set of columns."""
    cfg = dataclasses.replace(drifting_files(spark, sf_dir), max_files_per_write=1)
    ingest(spark, cfg, "batch_1")
    return _bronze(spark, cfg)


def q_ingest_metadata(spark, sf_dir):
    """What ingest stamped, by kind of file: files seen, and whether all was as it was.

    The batch id comes from the clock.
    """
    cfg = drifting_files(spark, sf_dir)
    start = spark.sql("SELECT current_timestamp()").first()[0]
    (report,) = ingest(spark, cfg)
    end = spark.sql("SELECT current_timestamp()").first()[0]
    kind = F.when(F.col("l_linenumber") <= 2, "early").when(
        F.col("l_linenumber") <= 5, "middle"
    )
    listed = list_source_files(spark, cfg.layout.raw).select("file_name")
    bronze = read_table(spark, cfg.layout.bronze).withColumn(
        "file_name", base_name(decode_path("_source_file"))
    )
    from_listed = bronze.join(listed.withColumn("listed", F.lit(1)), "file_name", "left")
    time = F.col("_ingestion_timestamp").between(F.lit(start), F.lit(end))
    clock = F.to_timestamp(F.col("_batch_id"), "yyyyMMdd_HHmmss")
    second = F.expr("INTERVAL 1 SECOND")
    in_time = clock.between(F.lit(start) - second, F.lit(end) + second)
    return from_listed.groupBy(F.coalesce(kind, F.lit("late")).alias("kind")).agg(
        F.count(F.lit(1)).alias("rows"),
        F.bool_and(F.col("listed").isNotNull()).alias("source_listed"),
        F.bool_and(time).alias("time_in_run"),
        F.count_distinct("_ingestion_timestamp").alias("times"),
        F.bool_and((F.col("_batch_id") == report.table) & in_time).alias("id_from_clock"),
    )


def q_silver_metadata(spark, sf_dir):
    """What cleaning dropped and stamped; without a date, none of the data is future."""
    cfg = drifting_files(spark, sf_dir)
    ingest(spark, cfg, "batch_1")
    start = spark.sql("SELECT current_timestamp()").first()[0]
    clean(spark, cfg)
    end = spark.sql("SELECT current_timestamp()").first()[0]
    silver = read_table(spark, cfg.layout.silver)
    left = [c for c in INGEST_METADATA if c in silver.columns]
    return silver.agg(
        F.count(F.lit(1)).alias("rows"),
        F.lit(len(left)).alias("metadata_left"),
        F.count_distinct(PROCESSED_AT).alias("times"),
        F.bool_and(F.col(PROCESSED_AT).between(F.lit(start), F.lit(end))).alias("time_in_run"),
    )


def q_ingest_ledger(spark, sf_dir):
    """Rows recorded per batch when files arrive between two runs.

    Folders beside the files are not looked into, whatever their names.
    """
    cfg = drifting_files(spark, sf_dir)
    order_lines(spark, sf_dir).write.parquet(f"{cfg.layout.raw}/m=1")
    ingest(spark, cfg, "batch_1")
    order_lines(spark, sf_dir).write.parquet(f"{cfg.layout.raw}/m=2")
    order_lines(spark, sf_dir).write.mode("append").parquet(cfg.layout.raw)
    ingest(spark, cfg, "batch_2")
    ledger = read_table(spark, cfg.layout.ledger)
    return ledger.groupBy("_batch_id").agg(F.sum("rows").alias("rows"))


def q_ledger_compacted(spark, sf_dir):
    """Rows per batch, and whether a file is in two, where all but the last is compacted."""
    cfg = drifting_files(spark, sf_dir)
    cfg = dataclasses.replace(cfg, ledger_batches=0)
    ingest(spark, cfg, "batch_1")
    order_lines(spark, sf_dir).write.mode("append").parquet(cfg.layout.raw)
    ingest(spark, cfg, "batch_2")
    order_lines(spark, sf_dir).write.mode("append").parquet(cfg.layout.raw)
    ingest(spark, dataclasses.replace(cfg, ledger_batches=1), "batch_3")
    ingest(spark, cfg, "batch_4")  # nothing is new
    ledger = read_ledger(spark, cfg.layout.ledger)
    return ledger.groupBy("_batch_id").agg(
        F.sum("rows").alias("rows"),
        (F.count("file_name") == F.count_distinct("file_name")).alias("once"),
    )


def q_ingest_reconciled(spark, sf_dir):
    """Rows of raw files by footer, by ledger and in bronze, by kind of file."""
    cfg = drifting_files(spark, sf_dir)
    ingest(spark, cfg, "batch_1")
    files = list_source_files(spark, cfg.layout.raw).select("path", "file_name")
    footers = read_footers(spark, files).select("file_name", "footer_rows")
    name = base_name(decode_path("_source_file")).alias("file_name")
    stored = read_table(spark, cfg.layout.bronze).groupBy(name).agg(
        F.min("l_linenumber").alias("first"), F.count(F.lit(1)).alias("stored_rows")
    )
    kind = F.when(F.col("first") <= 2, "early").when(F.col("first") <= 5, "middle")
    ledger = read_table(spark, cfg.layout.ledger).join(footers, "file_name")
    # A file without rows is of no kind.
    return ledger.join(stored, "file_name").groupBy(
        F.coalesce(kind, F.lit("late")).alias("kind")
    ).agg(*[F.sum(c).alias(c) for c in ("footer_rows", "rows", "stored_rows")])


def q_ingest_file_sizes(spark, sf_dir):
    """Order lines from 200 small files and from one large: what bronze keeps of them.

    A stored file is to have a quarter of the bytes of a batch, at 2 MB or more.
    """
    found = []
    for raw, files in (("small", 200), ("large", 1)):
        cfg = RunConfig(SPEC, Layout.under(scratch_dir(spark)))
        order_lines(spark, sf_dir).repartition(files).write.parquet(cfg.layout.raw)
        n_bytes = list_source_files(spark, cfg.layout.raw).agg(F.sum("length")).first()[0]
        size = max(n_bytes // 4, SMALL_FILE // 2)
        cfg = dataclasses.replace(cfg, file_bytes=size)
        (report,) = ingest(spark, cfg, "batch_1")
        folder = f"{cfg.layout.bronze}/_batch_id=batch_1"
        stored = list_source_files(spark, folder).agg(
            (F.count(F.lit(1)) <= 2 * -(-n_bytes // size)).alias("few_files"),
            (F.max("length") <= 2 * size).alias("none_large"),
        )
        found.append(
            stored.select(F.lit(raw).alias("raw"), F.lit(report.rows_out).cast("long").alias("rows"), "*")
        )
    return found[0].unionByName(found[1])


def q_ingest_stream(spark, sf_dir):
    """The same through the file stream, for files of one schema."""
    cfg = RunConfig(SPEC, Layout.under(scratch_dir(spark)))
    lines = order_lines(spark, sf_dir)
    lines.write.parquet(cfg.layout.raw)
    ingest_stream(spark, cfg, lines.schema, "batch_1")
    ingest_stream(spark, cfg, lines.schema, "batch_2")
    return _bronze(spark, cfg)


def q_ingest_stream_drift(spark, sf_dir):
    """Drifting files through a stream whose only micro-batch is then run once more.

    Its commit is taken back, as if the run had ended just before it.
    """
    cfg = drifting_files(spark, sf_dir)
    ingest_drifting_stream(spark, cfg, "batch_1")
    delete_folder(spark, f"{cfg.layout.stream_checkpoint}/commits/0")
    ingest_drifting_stream(spark, cfg, "batch_2")
    return _bronze(spark, cfg)


def q_gold_snapshot(spark, sf_dir):
    """Rows and trips of the summary tables, read as of the last of two runs."""
    cfg = drifting_files(spark, sf_dir)
    ingest(spark, cfg, "batch_1")
    for as_of in ("1995-01-01 00:00:00", AS_OF):
        clean(spark, cfg, as_of)
        aggregate(spark, cfg)
    tables = read_snapshot(spark, cfg.layout.group("aggregate"))
    counts = [
        table.agg(F.count(F.lit(1)).alias("rows"), F.sum("trip_count").alias("trips")).select(
            F.lit(name).alias("table"), "rows", "trips"
        )
        for name, table in tables.items()
    ]
    return functools.reduce(DataFrame.unionByName, counts)


def q_rejected_rows(spark, sf_dir):
    """The stored quarantine of a clean run, with its ingest metadata."""
    cfg = drifting_files(spark, sf_dir)
    ingest(spark, cfg, "batch_1")
    clean(spark, cfg, AS_OF)
    rejects = read_rejects(spark, cfg)
    return present(rejects.drop("_ingestion_timestamp", "_source_file"))


def q_run_report(spark, sf_dir):
    """All stages on drifting files; the report has one row per written table."""
    cfg = drifting_files(spark, sf_dir)
    return run_report(spark, run_pipeline(spark, cfg, "batch_1", AS_OF))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        name.removeprefix("q_"): fn
        for name, fn in globals().items()
        if name.startswith("q_")
    }
