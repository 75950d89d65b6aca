"""Language identification by fusing evidence from the text and from around it.

The text's likelihood comes from byte trigrams. The language that the markup declares, the
address's suffix and the host add to it: how far a declaration can be trusted and what
a suffix and a host speak is counted over the table by grouped aggregation, with the
text's own opinion as weights. Host priors are smoothed towards their domain's, and
these towards the whole table's. The posterior is among the known labels only; whether a
text is in any of them is told by how likely its trigrams are, held against what the
labelled texts have and what letters drawn at random would have.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.llm.tables import few_parts, label_sizes, materialize, sampled, short_batches

BUCKETS = 1 << 15
_KEEP = bytes(
    b if b >= 128 or 97 <= b <= 122 else b + 32 if 65 <= b <= 90 else 32
    for b in range(256)
)
_BLANKS = re.compile(rb" {2,}")

# Country suffixes with one main language; others are learned from the table alone.
SUFFIX_LANGUAGES = {"de": "de", "at": "de", "fr": "fr", "es": "es", "mx": "es", "uk": "en"}


def letters(text: str) -> np.ndarray:
    """The bytes of the text's letters, lowered, with a blank around each word.

    White space, digits and punctuation count as one blank.
    """
    raw = _BLANKS.sub(b" ", text.lower().encode("utf-8", "replace").translate(_KEEP))
    raw = raw.strip(b" ")
    return np.frombuffer(b" " + raw + b" " if raw else b"", np.uint8)


def trigrams(text: str) -> np.ndarray:
    """The bucket of each byte trigram of the text's letters."""
    return _buckets(letters(text))


def _buckets(found: np.ndarray) -> np.ndarray:
    if not len(found):
        return np.zeros(0, np.int64)
    codes = found.astype(np.uint32)
    mixed = codes[:-2] * np.uint32(65536) + codes[1:-1] * np.uint32(256) + codes[2:]
    return ((mixed * np.uint32(2654435761)) >> np.uint32(17)).astype(np.int64)


@dataclass(frozen=True)
class TextModel:
    """Log probabilities of the buckets, a row per label.

    ``usual`` has the mean log likelihood per trigram of each label's own texts, and
    ``gaps`` how much lower it is for bytes drawn at random as often as all labels' texts
    have them. A gap is infinite if the label has too few texts to tell. ``more_labels``
    says that there were more labels than the model has.
    """

    labels: tuple[str, ...]
    weights: np.ndarray
    usual: np.ndarray
    gaps: np.ndarray
    more_labels: bool = False

    def strangeness(self, mean: np.ndarray, n: int) -> float | None:
        """0 for a text as usual in the label it fits best, 1 for one of random letters.

        Texts of less than 128 trigrams vary more, and count as less strange. Null if no
        label can tell.
        """
        told = np.isfinite(self.gaps)
        if not n or not told.any():
            return None
        off = (self.usual[told] - mean[told]) / self.gaps[told]
        return float(off.min() * min(1.0, n / 128) ** 0.5)

    def mean_log_likelihood(self, text: str) -> tuple[np.ndarray, int]:
        total, n = np.zeros(len(self.labels)), 0
        found = trigrams(text)
        for at in range(0, len(found), 1 << 16):
            part = found[at : at + (1 << 16)]
            total += self.weights[:, part].sum(axis=1, dtype=np.float64)
            n += len(part)
        return total / max(n, 1), n


def fit(
    labelled: DataFrame,
    rows_per_label: int = 2000,
    smoothing: float = 0.1,
    id_column: str = "doc_id",
    text_column: str = "text",
    label_column: str = "lang",
    max_labels: int = 256,
) -> TextModel:
    """Trigram counts by label over a bounded sample of labelled rows.

    The sample is about ``rows_per_label`` rows of each of the ``max_labels`` labels with
    most rows, chosen by a hash of their ids; the model remembers if there were more. Rows without id, label or text do not count. The driver gets a row per label and bucket
    at most. A text's own trigrams are left out where it shows what is usual.
    """
    short_batches(labelled)
    rows = labelled.select(
        F.col(id_column).cast("string").alias("id"),
        F.col(text_column).cast("string").alias("text"),
        F.lower(label_column).alias("label"),
    ).dropna()
    ids = rows.select("id", "label")
    sizes, more = label_sizes(ids, max_labels)
    chosen = sampled(ids, rows_per_label, sizes)
    # About rows_per_label ids for each of max_labels labels at most.
    sample = rows.join(F.broadcast(chosen), ["id", "label"], "left_semi")
    sample = materialize(sample.select("text", "label"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            for text, label in zip(*(c.to_pylist() for c in batch.columns)):
                own = totals.setdefault(label, np.zeros(BUCKETS + 256, np.int64))
                found = letters(text)
                own[:BUCKETS] += np.bincount(_buckets(found), minlength=BUCKETS)
                own[BUCKETS:] += np.bincount(found, minlength=256)
        for label, own in totals.items():
            at = np.flatnonzero(own)
            columns = [pa.array([label] * len(at)), pa.array(at), pa.array(own[at])]
            yield pa.RecordBatch.from_arrays(columns, names=["label", "bucket", "n"])

    counts = (
        sample.select("text", "label")
        .mapInArrow(count, "label string, bucket long, n long")
        .groupBy("label", "bucket")
        .agg(F.sum("n").alias("n"))
        .toArrow()
    )
    labels = sorted(set(counts.column("label").to_pylist()))
    table = np.zeros((len(labels), BUCKETS + 256))
    place = {label: i for i, label in enumerate(labels)}
    rows_at = [place[x] for x in counts.column("label").to_pylist()]
    table[rows_at, counts.column("bucket").to_numpy()] += counts.column("n").to_numpy()
    table, by_byte = table[:, :BUCKETS], table[:, BUCKETS:].sum(axis=0)
    smooth = table + smoothing
    weights = np.log(smooth / smooth.sum(axis=1, keepdims=True)).astype(np.float32)
    usual, gaps = np.zeros(len(labels)), np.full(len(labels), np.inf)
    if by_byte.sum():
        shared = sample.sparkSession.sparkContext.broadcast((place, table))
        drawn = np.random.default_rng(0).choice(256, 1 << 17, p=by_byte / by_byte.sum())
        random = weights[:, _buckets(drawn)].mean(axis=1, dtype=np.float64)
        for label, middle, texts in _own_likelihoods(sample, shared, smoothing):
            i = place[label]
            usual[i] = middle
            if texts >= MIN_TEXTS and middle - random[i] >= MIN_GAP:
                gaps[i] = middle - random[i]
    return TextModel(tuple(labels), weights, usual, gaps, more)


# Of texts in a label, and of nats a trigram between them and random letters, if the label
# is to tell strange texts.
MIN_TEXTS = 20
MIN_GAP = 1.0


def _own_likelihoods(sample: DataFrame, shared, smoothing: float) -> list:
    """By label: the median of its texts' mean log likelihoods, and how many texts."""

    def mean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, table = shared.value
        totals = table.sum(axis=1) + smoothing * BUCKETS
        for batch in batches:
            labels, means = [], []
            for text, label in zip(*(c.to_pylist() for c in batch.columns)):
                at, n = np.unique(trigrams(text), return_counts=True)
                if not len(at):
                    continue
                others = table[place[label], at] - n + smoothing
                left = totals[place[label]] - n.sum()
                labels.append(label)
                means.append(float((n * np.log(others / left)).sum() / n.sum()))
            columns = [pa.array(labels, pa.string()), pa.array(means, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=["label", "mean"])

    found = sample.select("text", "label").mapInArrow(mean, "label string, mean double")
    return found.groupBy("label").agg(F.median("mean"), F.count(F.lit(1))).collect()


# --- evidence ----------------------------------------------------------------


def url_host(url: Column) -> Column:
    """The lowered host of an address, or null."""
    pattern = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)"
    host = F.lower(F.regexp_extract(url, pattern, 1))
    return F.when(host != "", host)


def declared_language(html: Column) -> Column:
    """Primary subtag of the lang attribute of the html element, or null."""
    pattern = r"""(?i)<html\b[^<>]*?\blang\s*=\s*["']?([A-Za-z]+)"""
    found = F.lower(F.regexp_extract(html, pattern, 1))
    return F.when(found != "", found)


def visible_text(html: Column) -> Column:
    """What is left of a page without scripts, styles, comments and tags."""
    # Each opener is looked for once: one that is not closed hides the rest, as in a
    # browser, and a tag ends at the next one's start.
    hidden = r"(?is)<(script|style)\b.*?(?:</\1\s*>|\z)|<!--.*?(?:-->|\z)|<[^<>]*>"
    return F.regexp_replace(html, hidden, " ")


def text_scores(spark: SparkSession, model: TextModel, enough: int):
    """Function of a text column: (log_text, one number per label, n_grams, strangeness).

    Trigrams overlap, so the mean log likelihood counts as that of ``enough`` at most.
    Only the text goes to Python; the other columns of a row stay where they are.
    """
    shared = spark.sparkContext.broadcast(
        (model.labels, model.weights, model.usual, model.gaps)
    )

    @F.arrow_udf("struct<log_text: array<double>, n_grams: bigint, strangeness: double>")
    def score(texts: pa.Array) -> pa.Array:
        own = TextModel(*shared.value)
        logs, sizes, strange = [], [], []
        for text in texts:
            mean, n = own.mean_log_likelihood(text.as_py() or "")
            logs.append(mean * min(n, enough))
            sizes.append(n)
            strange.append(own.strangeness(mean, n))
        columns = [
            pa.array(logs, pa.list_(pa.float64())),
            pa.array(sizes, pa.int64()),
            pa.array(strange, pa.float64()),
        ]
        names = ["log_text", "n_grams", "strangeness"]
        return pa.StructArray.from_arrays(columns, names=names)

    return score


def softmax(logs: Column) -> Column:
    def body(x: Column) -> Column:
        powers = F.transform(x, lambda v: F.exp(v - F.array_max(x)))
        return F.transform(
            F.array(powers),
            lambda p: F.transform(
                p, lambda v: v / F.aggregate(p, F.lit(0.0), lambda a, w: a + w)
            ),
        )[0]

    return F.transform(F.array(logs), body)[0]


def _sums(labels: int) -> list[Column]:
    shares = F.array(*[F.sum(F.get("share", F.lit(i))) for i in range(labels)])
    return [shares.alias("sums"), F.count(F.lit(1)).cast("double").alias("rows")]


def _smoothed(sums: Column, rows: Column, prior: Column, strength: float) -> Column:
    return F.zip_with(sums, prior, lambda s, p: (s + strength * p) / (rows + strength))


def _numbers(values) -> Column:
    return F.array(*[F.lit(float(v)) for v in values])


def identify(
    df: DataFrame,
    model: TextModel,
    text: Column,
    declared: Column | None = None,
    host: Column | None = None,
    keep: bool = True,
    enough: int = 60,
    strength: float = 10.0,
    suffix_languages: Mapping[str, str] = SUFFIX_LANGUAGES,
    max_strangeness: float = 0.4,
) -> DataFrame:
    """Each row of ``df`` with its language.

    Columns: row (a struct c0, c1, ... of the columns of ``df``; null unless ``keep``),
    language, posterior, text_language, declared, host, n_grams, known. Language and posterior
    are null where the text has no letter, or the model no label. Ties go to the first label in
    alphabetical order. Known is null there as well, and otherwise false where the text is
    over ``max_strangeness`` in every label, as gibberish and other languages are; the
    evidence around the text has no say, except that a text stays known if its declared
    label has too few texts to tell, or may be one that the model's bound left out. Null declarations and hosts are no evidence. A host's counts
    leave out the row itself, so that no text supports itself. Rows with equal ids are
    separate rows.
    """
    short_batches(df)
    n = len(model.labels)
    nothing = F.lit(None).cast("string")
    rows = df.select(
        F.struct(
            *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(df.columns if keep else [])],
            F.lit(0).alias("end"),
        ).alias("row"),
        F.lower(nothing if declared is None else declared).alias("declared"),
        (nothing if host is None else host).alias("host"),
        text.alias("text"),
    )
    if not n:
        return rows.select(
            "row",
            nothing.alias("language"),
            F.lit(None).cast("double").alias("posterior"),
            nothing.alias("text_language"),
            "declared",
            "host",
            F.lit(0).cast("long").alias("n_grams"),
            F.lit(None).cast("boolean").alias("known"),
        )
    rows = rows.select(
        "row",
        "declared",
        "host",
        text_scores(df.sparkSession, model, enough)("text").alias("s"),
    ).select("row", "declared", "host", "s.log_text", "s.n_grams", "s.strangeness")
    scored = materialize(rows.withColumn("share", softmax(F.col("log_text"))))
    told = scored.filter("n_grams > 0")

    # What a declaration says, by language: a table of labels by labels and "other".
    labels = F.array(*[F.lit(x) for x in model.labels])
    said = F.when(F.array_contains(labels, F.col("declared")), F.col("declared"))
    said = F.when(F.col("declared").isNotNull(), F.coalesce(said, F.lit("")))
    by_said = {r[0]: r[1] for r in told.groupBy(said).agg(_sums(n)[0]).collect()}
    everything = np.array(list(by_said.values())).sum(axis=0) if by_said else np.zeros(n)
    whole = (everything + 1) / (everything + 1).sum()
    heard = np.zeros(n)
    for word, sums in by_said.items():
        heard = heard + np.array(sums) if word is not None else heard
    chances = []
    for word in [*model.labels, ""]:
        expected = np.full(n, 0.1 / n)
        if word:
            expected[model.labels.index(word)] = 0.9
        counted = np.array(by_said.get(word, np.zeros(n)))
        chance = (counted + strength * expected) / (heard + strength)
        chances.append((word, np.log(chance).tolist()))
    # A row per label, of which there are few.
    chances = df.sparkSession.createDataFrame(chances, "said string, log_said array<double>")

    # Priors of hosts, towards their domains, towards the whole; and suffixes.
    parts = F.split("host", r"\.")
    hosts = told.filter("host is not null").groupBy("host").agg(*_sums(n))
    hosts = hosts.withColumn(
        "domain", F.array_join(F.slice(parts, -F.least(F.size(parts), F.lit(2)), 2), ".")
    ).withColumn("suffix", F.when(F.size(parts) > 1, F.element_at(parts, -1)))
    hosts = materialize(few_parts(hosts, scored.count()))
    add_up = [
        F.array(*[F.sum(F.get("sums", F.lit(i))) for i in range(n)]).alias("s"),
        F.sum("rows").alias("r"),
    ]
    domains = hosts.groupBy("domain").agg(*add_up).select(
        "domain",
        _smoothed(F.col("s"), F.col("r"), _numbers(whole), strength).alias("prior"),
    )
    total = max(float(everything.sum()), 1.0)
    hint = _numbers(np.zeros(n))
    for suffix, language in suffix_languages.items():
        if language in model.labels:
            one = np.zeros(n)
            one[model.labels.index(language)] = strength
            hint = F.when(F.col("suffix") == suffix, _numbers(one)).otherwise(hint)
    share = (F.col("r") + 1.0) / total
    suffixes = hosts.filter("suffix is not null").groupBy("suffix").agg(*add_up)
    suffixes = suffixes.withColumn("s", F.zip_with("s", hint, lambda a, b: a + b)).select(
        "suffix",
        F.zip_with(
            "s",
            _numbers(everything),
            lambda s, e: F.log((s + strength * share) / (e + strength)),
        ).alias("log_suffix"),
    )
    hosts = hosts.join(domains, "domain").join(suffixes, "suffix", "left").select(
        "host", "sums", "rows", "prior", "log_suffix"
    )

    # One join for each row; adaptive execution splits a host with many rows.
    fused = scored.withColumn("said", said).join(hosts, "host", "left")
    fused = fused.join(F.broadcast(chances), "said", "left")
    others = F.zip_with("sums", "share", lambda a, b: F.greatest(a - b, F.lit(0.0)))
    others = F.when(F.col("n_grams") > 0, others).otherwise(F.col("sums"))
    n_others = F.when(F.col("n_grams") > 0, F.col("rows") - 1).otherwise(F.col("rows"))
    prior = F.coalesce(
        _smoothed(others, n_others, F.col("prior"), strength), _numbers(whole)
    )
    zeros = _numbers(np.zeros(n))
    evidence = F.zip_with(
        F.zip_with("log_text", F.coalesce("log_said", zeros), lambda a, b: a + b),
        F.zip_with(
            F.coalesce("log_suffix", zeros), prior, lambda a, b: a + F.log(b)
        ),
        lambda a, b: a + b,
    )
    fused = fused.withColumn("posteriors", softmax(evidence))

    def best(values: Column) -> Column:
        return F.element_at(labels, F.array_position(values, F.array_max(values)).cast("int"))

    seen = F.col("n_grams") > 0
    known = F.coalesce(F.col("strangeness") <= max_strangeness, F.lit(True))
    untold = [x for x, gap in zip(model.labels, model.gaps) if not np.isfinite(gap)]
    known = known | F.coalesce(F.col("declared").isin(untold), F.lit(False))
    if model.more_labels:
        known = known | F.coalesce(~F.col("declared").isin(*model.labels), F.lit(False))
    return fused.select(
        F.when(F.lit(keep), F.col("row")).alias("row"),
        F.when(seen, best(F.col("posteriors"))).alias("language"),
        F.when(seen, F.array_max("posteriors")).alias("posterior"),
        F.when(seen, best(F.col("log_text"))).alias("text_language"),
        "declared",
        "host",
        "n_grams",
        F.when(seen, known).alias("known"),
    )
