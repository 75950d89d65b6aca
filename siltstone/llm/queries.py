"""The operators' queries over the test tables, by the name they are registered under."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.llm import (
    collision_search,
    count_packing,
    decontaminate,
    katz,
    langid,
    packing,
    periodic,
    secrets,
    simhash,
    spelling,
    toxicity,
    url_filter,
    warc,
)
from siltstone.llm.tables import load


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.severity_model(docs, load(spark, sf_dir, "labels"))
    return toxicity.predict(docs, model)


def op2_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(load(spark, sf_dir, "documents"), 4, 4)
    return found.select("doc_id", "fingerprint", "component_id")


def op3_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    found = secrets.find_secrets(docs, keep_text=False)
    base = F.filter("secrets", lambda s: s["kind"] != secrets.RANDOM)

    def count(kind: str):
        of_kind = F.filter("secrets", lambda s: s["kind"] == kind)
        return F.size(of_kind).cast("long").alias(f"n_{kind}")

    return found.select(
        F.col("row.c0").alias("doc_id"),
        *[count(kind) for kind, *_ in secrets.BASE],
        F.sha2(secrets.joined(base), 256).alias("base_sha256"),
        secrets.joined(F.col("secrets")).alias("spans"),
    )


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(load(spark, sf_dir, "documents"), 2048).select(
        "doc_id",
        "piece",
        "start",
        "length",
        "ids_crc32",
        "sequence_id",
        "offset",
        "part",
        "part_bins",
        "part_bound",
    )


def op5_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    return katz.train_and_score(docs, "crc32(cast(doc_id AS string)) % 7 = 2", order=3)


def op6_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = load(spark, sf_dir, "pages").select("page_id", "url", "html")
    found = warc.derive(warc.page_responses(pages))
    return found.withColumnRenamed("key", "page_id").drop("response_id")


def op7_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    items = load(spark, sf_dir, "benchmark").select("item_id", "text")
    found = decontaminate.find_leaks(docs, items, window=10)
    return found.select(
        F.col("row.c0").alias("doc_id"),
        "n_words",
        decontaminate.hit_words("spans").alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
    )


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = langid.fit(load(spark, sf_dir, "documents"), rows_per_label=2000)
    html = F.col("html")
    found = langid.identify(
        load(spark, sf_dir, "pages").select("page_id", "url", "html"),
        model,
        text=langid.visible_text(html),
        declared=langid.declared_language(html),
        host=langid.url_host(F.col("url")),
    )
    return found.select(
        F.col("row.c0").alias("page_id"),
        "language",
        "posterior",
        "text_language",
        "declared",
        "host",
        "n_grams",
    )


def op9_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = load(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    queries = vectors.select("vec_id").filter("vec_id % 50 = 0")
    return collision_search.nearest(vectors, queries, k=5)


def op10_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = load(spark, sf_dir, "pages").select("page_id", "url")
    captures = url_filter.page_captures(pages)
    found = url_filter.filter_captures(captures, url_filter.page_list(captures))
    return found.withColumnRenamed("key", "page_id").drop("url")


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    return spelling.spelling_variants(spelling.count_words(docs, 5, 3, misspell_every=97))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    looped = docs.select("doc_id", periodic.looped_text("doc_id", "text").alias("text"))
    # The longest run is looked up once, not once for each of its fields.
    found = periodic.periodic_runs(looped).select("*", periodic.longest_run().alias("best"))
    return found.select(
        F.col("row.c0").alias("doc_id"),
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.floor(F.col("best.length") * 1000 / F.col("best.period")).alias("exponent_milli"),
        periodic.runs_digest().alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op13_count_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_packing.pack_by_counts(load(spark, sf_dir, "documents"), 1024)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = [
        op1_toxicity,
        op2_simhash_near_dedup,
        op3_secret_scans,
        op4_best_fit_packing,
        op5_lm_scoring,
        op6_warc_derivatives,
        op7_benchmark_decontamination,
        op8_language_id,
        op9_nearest_neighbours,
        op10_url_filters,
        op11_spelling_variants,
        op12_periodic_runs,
        op13_count_packing,
    ]
    return {f.__name__: f for f in found}


def oracle_sql() -> dict[str, str]:
    return {
        "op3_secret_scans": secrets.ORACLE,
        "op7_benchmark_decontamination": decontaminate.ORACLE,
        "op10_url_filters": url_filter.ORACLE,
    }
