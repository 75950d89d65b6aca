import numpy as np
import pytest

from siltstone.llm import toxicity
from siltstone.llm.tables import load

SF = "/root/testdata/sf0.1"


def test_held_out_accuracy(spark):
    docs, labels = load(spark, SF, "documents"), load(spark, SF, "labels")
    model = toxicity.severity_model(docs, labels.filter("doc_id % 4 <> 0"))
    held = labels.filter("doc_id % 4 = 0").select("doc_id", "toxic")
    found = toxicity.predict(docs.join(held, "doc_id", "left_semi"), model)
    rows = found.join(held.withColumnRenamed("toxic", "label"), "doc_id").collect()
    toxic = [r for r in rows if r.label == 1]
    clean = [r for r in rows if r.label == 0]
    assert sum(r.toxic for r in toxic) >= 0.95 * len(toxic) > 0
    assert sum(r.toxic for r in clean) <= 0.02 * len(clean)
    assert all(0 <= r.expected_severity <= 3 for r in rows)


def test_gradient_reaches_the_maximum():
    """No small change of any parameter raises the penalised likelihood much."""
    draw = np.random.default_rng(0)
    n, words = 400, 3
    x = draw.poisson(1.0, (n, words)).astype(float)
    score = x @ np.array([1.5, -1.0, 0.0])
    cuts = np.array([0.0, 1.5, 3.0])
    y = (score[:, None] + draw.logistic(size=(n, 1)) > cuts[None, :]).sum(axis=1)
    r, c = np.nonzero(x)
    w, t = toxicity._descend(r, c, x[r, c], y, words, 3, 1e-3, 3000, 0.05)

    def value(w, t):
        above = 1 / (1 + np.exp(-((x @ w)[:, None] - t[None, :])))
        above = np.hstack([np.ones((n, 1)), above, np.zeros((n, 1))])
        p = above[np.arange(n), y] - above[np.arange(n), y + 1]
        return np.log(p).mean() - 1e-3 * np.abs(w).sum()

    assert (np.diff(t) > 0).all()
    best = value(w, t)
    for i in range(words):
        for step in (-0.02, 0.02):
            assert value(w + step * np.eye(words)[i], t) < best
    for i in range(3):
        for step in (-0.02, 0.02):
            assert value(w, t + step * np.eye(3)[i]) < best
    assert abs(w - [1.5, -1.0, 0.0]).max() < 0.4 and w[2] == 0 or abs(w[2]) < 0.2


def test_grades_and_expected_severity(spark):
    model = toxicity.OrdinalModel(
        {b"bad": 0, b"awful": 1}, np.array([2.0, 4.0]), np.array([1.0, 3.0, 5.0])
    )
    texts = ["fine", "Bad", "bad, AWFUL!", "awful " * 50, "", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {r.doc_id: r for r in toxicity.predict(docs, model).collect()}
    for i, text in enumerate(texts):
        words = (text or "").lower().replace(",", " ").replace("!", " ").split()
        score = sum(
            weight * np.log1p(words.count(w)) for w, weight in (("bad", 2.0), ("awful", 4.0))
        )
        above = 1 / (1 + np.exp(-(score - model.thresholds)))
        assert rows[i].expected_severity == pytest.approx(above.sum())
        chances = -np.diff(np.concatenate([[1.0], above, [0.0]]))
        assert rows[i].grade == chances.argmax()
        assert rows[i].toxic == (above[0] > 0.5)
    assert rows[4].expected_severity == rows[5].expected_severity


def test_odd_rows_and_empty_tables(spark, odd_docs, no_docs):
    labels = spark.createDataFrame(
        [(4, 1), (5, 0), (5, 1), (8, 0), (None, 1), (7, None), (99, 1)], "doc_id long, toxic int"
    )
    model = toxicity.severity_model(odd_docs, labels)
    assert toxicity.predict(odd_docs, model).count() == odd_docs.count()
    assert toxicity.predict(no_docs, model).collect() == []
    nothing = toxicity.severity_model(no_docs, labels)
    assert toxicity.predict(odd_docs, nothing).count() == odd_docs.count()
    assert toxicity.predict(odd_docs, toxicity.severity_model(odd_docs, labels.limit(0))).count()
