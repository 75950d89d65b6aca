"""A corpus pipeline of the operators in ``siltstone.llm``, over the documents table.

Each stage takes (spark, docs, sf_dir) and returns a frame; it is written as Parquet
and read again as the next stage's documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.llm import decontaminate, langid, packing, secrets, simhash
from siltstone.llm.tables import load, materialize

MIN_POSTERIOR = 0.5


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents whose language cannot be told.

    The declared language is the lang column and the host the source. Rejected are
    texts without letters, those for which no language is likelier than not, and those
    that are unlike the labelled texts of every language, whatever is declared. Without
    any labelled text nothing tells languages, and all texts with letters stay.
    """
    model = langid.fit(docs)
    if not model.labels:
        return docs.filter(F.col("text").rlike(r"\p{L}"))
    found = langid.identify(
        docs, model, F.col("text"), declared=F.col("lang"), host=F.col("source")
    )
    told = F.col("posterior") >= MIN_POSTERIOR
    if model.more_labels:
        # The language of such a text is told by its label alone.
        told |= ~F.col("declared").isin(*model.labels) & (F.col("n_grams") > 0)
    kept = found.filter(told & F.col("known"))
    return kept.select(
        *[F.col(f"row.c{i}").alias(c) for i, c in enumerate(docs.columns)]
    )


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep of each group of near-duplicates the document with the smallest id."""
    return simhash.keep_one(docs, shingle=4, max_bits=4)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut benchmark passages out of the texts; drop what is mostly benchmark."""
    items = load(spark, sf_dir, "benchmark").select("item_id", "text")
    return decontaminate.remove_leaks(docs, items, window=10, max_share=0.5)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mask the secrets in the texts; every document stays."""
    return secrets.redact(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The places of the documents' pieces in sequences of 2048 tokens."""
    return packing.pack(docs, 2048).drop("uid", "filled")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language id", language_id),
    ("simhash near-dedup", near_dedup),
    ("benchmark decontamination", decontamination),
    ("secret scans", secret_scan),
    ("best-fit packing", packed),
]

# Fingerprints, an automaton and token ids have no counterpart in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir))
    return docs


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"pipeline": run}


def oracle_sql() -> dict[str, str]:
    return {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
