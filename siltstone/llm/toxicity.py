"""Toxicity severity by cumulative-link ordinal regression on sparse word features.

P(grade >= k) = sigmoid(w . x - t_k): one weight per word, shared by all thresholds, which
ascend. The expected severity is the sum of these probabilities.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm.decontaminate import words_of
from siltstone.llm.tables import (
    empty_text,
    materialize,
    row_slices,
    sampled,
    short_batches,
)


@dataclass(frozen=True)
class OrdinalModel:
    """Weights of the words in ``vocabulary`` and ascending thresholds of the grades."""

    vocabulary: dict[bytes, int]
    weights: np.ndarray
    thresholds: np.ndarray

    def at_least(self, score: float) -> np.ndarray:
        """Probability of each grade from 1 on, or a higher one."""
        return _sigmoid(score - self.thresholds)

    def score(self, text: str) -> float:
        find, found = self.vocabulary.get, {}
        for feature, n in features(text).items():
            if (at := find(feature)) is not None:
                found[at] = n
        return float(sum(self.weights[at] * np.log1p(found[at]) for at in sorted(found)))


def features(text: str | None) -> dict[bytes, int]:
    """How often each word occurs, and each start of 4 to 6 bytes of longer words.

    Starts stand for the inflections and compounds of a word; they end in an asterisk.
    """
    words = Counter(words_of(text))
    starts: dict[bytes, int] = {}
    for word, n in words.items():
        for size in range(4, min(7, len(word))):
            start = word[:size] + b"*"
            starts[start] = starts.get(start, 0) + n
    return words | starts


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def sample(
    docs: DataFrame, labels: DataFrame, rows_per_label: int, label: str
) -> DataFrame:
    """(text, label) of a sample of labelled documents, chosen by a hash of their ids.

    It has about ``rows_per_label`` of each label value. Rows without id, label or text do
    not count; of labels that repeat an id the highest counts, of such texts the first.
    """
    known = labels.select(F.col("doc_id").alias("id"), F.col(label).alias("label")).dropna()
    known = known.groupBy("id").agg(F.max("label").alias("label"))
    chosen = sampled(known, rows_per_label)
    texts = docs.select(F.col("doc_id").alias("id"), F.col("text").cast("string").alias("text"))
    texts = texts.dropna().join(F.broadcast(chosen), "id")
    return texts.groupBy("id", "label").agg(F.min("text").alias("text")).select("text", "label")


def feature_counts(texts: DataFrame) -> DataFrame:
    """(row, word, n, label): the features of each text, rows numbered arbitrarily."""
    numbered = texts.select(
        F.monotonically_increasing_id().alias("row"), empty_text("text"), "label"
    )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in row_slices(batches, 64):
            out: tuple[list, list, list, list] = ([], [], [], [])
            for row, text, label in zip(*(c.to_pylist() for c in batch.columns)):
                counts = features(text)
                out[0].extend([row] * len(counts))
                out[1].extend(counts)
                out[2].extend(counts.values())
                out[3].extend([label] * len(counts))
            kinds = (pa.int64(), pa.binary(), pa.int64(), pa.int64())
            arrays = [pa.array(c, k) for c, k in zip(out, kinds)]
            yield pa.RecordBatch.from_arrays(arrays, names=["row", "word", "n", "label"])

    numbered = numbered.withColumn("label", F.col("label").cast("long"))
    return numbered.mapInArrow(count, "row long, word binary, n long, label long")


def graded(counts: DataFrame, levels: int = 3, min_docs: int = 5) -> DataFrame:
    """``counts`` with severity grades 0 to ``levels`` in place of a 0/1 label.

    Cues are the words whose share among rows labelled 1 is ten times that among the
    others. A row labelled 1 has the number of its cues as grade, ``levels`` at most and
    1 at least; the others have grade 0.
    """
    rows = counts.groupBy("label").agg(F.count_distinct("row").alias("all"))
    sizes = {r["label"]: r["all"] for r in rows.collect()}  # two labels
    bad, good = max(sizes.get(1, 0), 1), max(sizes.get(0, 0), 1)
    docs = counts.groupBy("word").agg(
        F.count_if(F.col("label") == 1).alias("bad"),
        F.count_if(F.col("label") != 1).alias("good"),
    )
    cue = (F.col("bad") >= min_docs) & (
        F.col("bad") / bad >= 10 * (F.col("good") + 0.5) / good
    )
    cues = docs.filter(cue).select("word", F.lit(1).alias("cue"))
    seen = counts.filter("label = 1").join(cues, "word")
    grades = seen.groupBy("row").agg(F.sum("n").alias("cues"))
    grade = F.when(
        F.col("label") == 1,
        F.greatest(F.lit(1), F.least(F.coalesce("cues", F.lit(0)), F.lit(levels))),
    ).otherwise(F.lit(0))
    return counts.join(grades, "row", "left").select(
        "row", "word", "n", grade.cast("int").alias("grade")
    )


def fit(
    counts: DataFrame,
    words: int = 4000,
    min_rows: int = 5,
    penalty: float = 3e-4,
    steps: int = 400,
    rate: float = 0.05,
) -> OrdinalModel:
    """Fit to (row, word, n, grade) of a bounded sample.

    The vocabulary is the ``words`` features whose shares of the rows with grade 0 and of
    the others differ most, ties in alphabetical order, each in ``min_rows`` rows at
    least. ``penalty`` times the sum of absolute weights is taken off the mean log
    likelihood, which leaves features that only chance ties to a grade at zero. The
    sample's counts of the vocabulary come to the driver; their number is bounded by
    that of the sample's rows times ``words``.
    """
    grades = counts.select("row", "grade").distinct().toArrow()
    y = grades.column("grade").to_numpy().astype(np.int64)
    n_bad, n_good = max((y > 0).sum(), 1), max((y == 0).sum(), 1)
    by_word = counts.groupBy("word").agg(
        F.count_if(F.col("grade") > 0).alias("bad"),
        F.count_if(F.col("grade") == 0).alias("good"),
    )
    by_word = by_word.filter(F.col("bad") + F.col("good") >= min_rows)
    apart = F.abs(F.col("bad") / int(n_bad) - F.col("good") / int(n_good))
    chosen = by_word.select("word", apart.alias("apart"))
    chosen = chosen.orderBy(F.desc("apart"), "word").limit(words)
    terms = sorted(bytes(r["word"]) for r in chosen.select("word").collect())
    place = {w: i for i, w in enumerate(terms)}
    index = counts.sparkSession.createDataFrame(
        [(bytearray(w), i) for w, i in place.items()], "word binary, at int"
    )
    cells = counts.join(F.broadcast(index), "word").select("row", "at", "n").toArrow()
    ids = grades.column("row").to_numpy()
    order = np.argsort(ids)
    ids, y = ids[order], y[order]
    r = np.searchsorted(ids, cells.column("row").to_numpy())
    c = cells.column("at").to_numpy().astype(np.int64)
    v = np.log1p(cells.column("n").to_numpy().astype(float))
    top = int(y.max()) if len(y) else 0
    weights, thresholds = _descend(r, c, v, y, len(terms), max(top, 1), penalty, steps, rate)
    return OrdinalModel(place, weights, thresholds)


def _descend(r, c, v, y, n_words, top, penalty, steps, rate):
    """Adam on the mean log likelihood, with weights shrunk towards zero after each step.

    Thresholds are a start and positive gaps.
    """
    n = max(len(y), 1)
    share = [(np.sum(y >= k) + 0.5) / (n + 1) for k in range(1, top + 1)]
    start = -np.log(np.array(share) / (1 - np.array(share)))
    gaps = np.log(np.maximum(np.diff(start), 0.05))
    params = np.concatenate([np.zeros(n_words), start[:1], gaps])
    first, second = np.zeros_like(params), np.zeros_like(params)

    def thresholds(p):
        return np.cumsum(np.concatenate([p[n_words : n_words + 1], np.exp(p[n_words + 1 :])]))

    rows = np.arange(len(y))
    for step in range(1, steps + 1):
        w, t = params[:n_words], thresholds(params)
        score = np.bincount(r, v * w[c], minlength=len(y))
        # P(y >= k) for k = 0 .. top + 1; a grade's probability is a difference.
        above = np.hstack(
            [
                np.ones((len(y), 1)),
                _sigmoid(score[:, None] - t[None, :]),
                np.zeros((len(y), 1)),
            ]
        )
        p = np.maximum(above[rows, y] - above[rows, y + 1], 1e-12)
        slope = above * (1 - above)
        d_score = (slope[rows, y] - slope[rows, y + 1]) / p
        d_t = np.zeros(top + 2)
        np.add.at(d_t, y, -slope[rows, y] / p)
        np.add.at(d_t, y + 1, slope[rows, y + 1] / p)
        d_t = d_t[1:-1]
        d_w = np.bincount(c, v * d_score[r], minlength=n_words)
        tails = np.cumsum(d_t[::-1])[::-1]
        gradient = np.concatenate(
            [d_w / n, tails[:1] / n, tails[1:] / n * np.exp(params[n_words + 1 :])]
        )
        first = 0.9 * first + 0.1 * gradient
        second = 0.999 * second + 0.001 * gradient**2
        pace = rate / (np.sqrt(second / (1 - 0.999**step)) + 1e-6)
        params = params + pace * first / (1 - 0.9**step)
        w, shrink = params[:n_words], pace[:n_words] * penalty
        params[:n_words] = np.sign(w) * np.maximum(np.abs(w) - shrink, 0)
    return params[:n_words], thresholds(params)


def predict(
    docs: DataFrame,
    model: OrdinalModel,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """(doc_id, expected_severity, grade, toxic) of each whole text.

    ``grade`` is the likeliest, the lower one of two that are; ``toxic`` says that some
    grade from 1 on is likelier than none. A null text is empty and has what the
    thresholds alone give. Rows with equal ids are separate; null ids stay null.
    """
    short_batches(docs)
    plain = (model.vocabulary, model.weights, model.thresholds)
    shared = docs.sparkSession.sparkContext.broadcast(plain)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = OrdinalModel(*shared.value)
        for batch in row_slices(batches):
            above = [own.at_least(own.score(t)) for t in batch.column(1).to_pylist()]
            table = np.array(above).reshape(batch.num_rows, -1)
            full = np.hstack([np.ones((len(table), 1)), table, np.zeros((len(table), 1))])
            columns = [
                batch.column(0),
                pa.array(table.sum(axis=1)),
                pa.array((full[:, :-1] - full[:, 1:]).argmax(axis=1).astype(np.int32)),
                pa.array(table[:, 0] > 0.5),
            ]
            names = ["doc_id", "expected_severity", "grade", "toxic"]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    texts = docs.select(F.col(id_column).cast("long"), empty_text(text_column))
    return texts.mapInArrow(
        score, "doc_id long, expected_severity double, grade int, toxic boolean"
    )


def severity_model(
    docs: DataFrame, labels: DataFrame, rows_per_label: int = 2000, levels: int = 3
) -> OrdinalModel:
    """The model for documents of which some are labelled toxic (0 or 1)."""
    short_batches(docs)
    counts = materialize(feature_counts(sample(docs, labels, rows_per_label, "toxic")))
    return fit(materialize(graded(counts, levels)))
