import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from siltstone.llm import langid
from siltstone.llm.queries import op8_language_id
from siltstone.llm.tables import load

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def model(spark):
    return langid.fit(load(spark, SF, "documents").filter("doc_id % 3 <> 0"), 150)


def test_held_out_accuracy_of_the_text_alone(spark, model):
    held = load(spark, SF, "documents").filter("doc_id % 3 = 0 and n_chars >= 40")
    found = langid.identify(held, model, F.col("text"))
    right = found.filter(F.col("row.c2") == F.col("language")).count()
    assert right >= 0.97 * held.count()


def test_pages(spark):
    rows = op8_language_id(spark, SF).collect()
    assert len(rows) == load(spark, SF, "pages").count()
    assert all(r.language in ("de", "en", "es", "fr") for r in rows)
    assert all(0.25 <= r.posterior <= 1 for r in rows)
    agree = sum(r.language == r.text_language for r in rows)
    assert agree >= 0.9 * len(rows)


def test_trigrams():
    assert len(langid.trigrams("")) == len(langid.trigrams(" 12 .,")) == 0
    assert len(langid.trigrams("a")) == 1
    assert len(langid.trigrams("Ab  c")) == len(" ab c ") - 2
    assert (langid.trigrams("THE  cat!") == langid.trigrams("the cat")).all()


def test_weights_are_distributions(model):
    assert model.labels == ("de", "en", "es", "fr")
    assert np.allclose(np.exp(model.weights.astype(float)).sum(axis=1), 1, atol=1e-4)


def test_evidence_decides_where_the_text_does_not(spark, model):
    """Short text, then: a host of German pages, a declaration, a country suffix."""
    german = [r.text for r in load(spark, SF, "documents").filter("lang = 'de'").limit(40).collect()]
    rows = [(t, "de", "www.example.net") for t in german]
    rows += [("in", None, "www.example.net"), ("in", None, None), ("in", "de", None)]
    rows += [("", "de", "www.example.net"), (None, None, None)]
    df = spark.createDataFrame(rows, "text string, lang string, host string")
    found = langid.identify(df, model, F.col("text"), F.col("lang"), F.col("host")).collect()
    by = {(r.row.c0, r.row.c1, r.row.c2): r for r in found}
    assert by[("in", None, "www.example.net")].language == "de"
    assert by[("in", "de", None)].language == "de"
    assert by[("", "de", "www.example.net")].language is None
    assert by[(None, None, None)].posterior is None


def slow_fusion(rows, model, enough=60, k=10.0):
    """The same evidence with plain loops."""
    n = len(model.labels)
    logs, shares, sizes = [], [], []
    for text, _, _ in rows:
        mean, size = model.mean_log_likelihood(text or "")
        x = mean * min(size, enough)
        p = np.exp(x - x.max())
        logs.append(x), shares.append(p / p.sum()), sizes.append(size)
    told = [i for i, s in enumerate(sizes) if s]
    whole = sum((shares[i] for i in told), np.zeros(n))
    base = (whole + 1) / (whole + 1).sum()

    def added(key):
        sums = {}
        for i in told:
            if (name := key(rows[i])) is not None:
                s, c = sums.get(name, (np.zeros(n), 0))
                sums[name] = (s + shares[i], c + 1)
        return sums

    said = added(lambda r: r[1] and (r[1] if r[1] in model.labels else ""))
    heard = sum((s for s, _ in said.values()), np.zeros(n))
    hosts = added(lambda r: r[2])
    domains = added(lambda r: r[2] and ".".join(r[2].split(".")[-2:]))
    ends = added(lambda r: r[2].split(".")[-1] if r[2] and "." in r[2] else None)
    out = []
    for i, (_, lang, host) in enumerate(rows):
        x = logs[i].copy()
        if lang is not None:
            word = lang if lang in model.labels else ""
            expected = np.full(n, 0.1 / n)
            if word:
                expected[model.labels.index(word)] = 0.9
            x += np.log((said.get(word, (np.zeros(n),))[0] + k * expected) / (heard + k))
        if host in hosts:
            s, c = domains[".".join(host.split(".")[-2:])]
            prior = (s + k * base) / (c + k)
            s, c = hosts[host]
            if sizes[i]:
                s, c = np.maximum(s - shares[i], 0), c - 1
            x += np.log((s + k * prior) / (c + k))
            if "." in host:
                suffix = host.split(".")[-1]
                s, c = ends[suffix]
                hint = np.zeros(n)
                if langid.SUFFIX_LANGUAGES.get(suffix) in model.labels:
                    hint[model.labels.index(langid.SUFFIX_LANGUAGES[suffix])] = k
                share = (c + 1) / max(whole.sum(), 1)
                x += np.log((s + hint + k * share) / (whole + k))
        else:
            x += np.log(base)
        p = np.exp(x - x.max())
        out.append(p / p.sum() if sizes[i] else None)
    return out


def test_fusion_against_plain_loops(spark, model):
    docs = load(spark, SF, "documents").limit(60).collect()
    hosts = ["a.x.de", "b.x.de", "a.y.com", "z.com", "localhost", None]
    rows = [(d.text[:9], [d.lang, None, "xx"][i % 3], hosts[i % 6]) for i, d in enumerate(docs)]
    rows += [("", "de", "a.x.de"), (None, None, "new.host.org")] + rows[:7]
    df = spark.createDataFrame(rows, "text string, lang string, host string")
    found = langid.identify(df, model, F.col("text"), F.col("lang"), F.col("host")).collect()
    want = {}
    for r, p in zip(rows, slow_fusion(rows, model)):
        want.setdefault(r, p)
    for r in found:
        p = want[(r.row.c0, r.row.c1, r.row.c2)]
        if p is None:
            assert r.language is None and r.posterior is None
        else:
            assert r.posterior == pytest.approx(p.max(), rel=1e-6)
            assert r.language == model.labels[int(p.argmax())]


def test_odd_rows_and_empty_tables(spark, model, odd_docs, no_docs):
    found = langid.identify(odd_docs, model, F.col("text"), F.col("lang"), F.col("source"))
    assert found.count() == odd_docs.count()
    assert langid.identify(no_docs, model, F.col("text")).collect() == []
    assert langid.fit(no_docs).labels == ()
    untold = langid.identify(odd_docs, langid.fit(no_docs), F.col("text")).collect()
    assert len(untold) == odd_docs.count() and all(r.language is None for r in untold)


def test_addresses_and_markup(spark):
    row = spark.createDataFrame(
        [
            ("HTTP://User@Www.Example.COM:80/a?b#c", '<!DOCTYPE html><HTML class=x lang="de-AT">'),
            ("not an address", "<p lang='fr'>x</p><script>if (a<b) x()</script>y<!-- z -->"),
            (None, None),
        ],
        "u string, h string",
    ).select(
        langid.url_host(F.col("u")).alias("host"),
        langid.declared_language(F.col("h")).alias("lang"),
        langid.visible_text(F.col("h")).alias("text"),
    )
    a, b, c = row.collect()
    assert (a.host, a.lang) == ("www.example.com", "de")
    assert (b.host, b.lang) == (None, None) and b.text.split() == ["x", "y"]
    assert tuple(c) == (None, None, None)


def test_strange_texts_are_not_known(spark, model):
    """Gibberish, dumps and an unknown language, however declared; clean texts stay."""
    draw = np.random.default_rng(3)

    def words(alphabet, n):
        return " ".join("".join(draw.choice(list(alphabet), 6)) for _ in range(n))

    alphabets = ["abcdefghijklmnopqrstuvwxyz", "абвгдежзиклмнопрстуфхцчшя", "0123456789abcdef"]
    junk = [words(a, 80) for a in alphabets for _ in range(20)]
    rows = [(t, "en", "src0") for t in junk]
    df = spark.createDataFrame(rows, "text string, lang string, source string")
    found = langid.identify(df, model, F.col("text"), F.col("lang"), F.col("source")).collect()
    assert len(found) == len(junk) and not any(r.known for r in found)
    assert all(r.posterior >= 0.5 for r in found)

    docs = load(spark, SF, "documents")
    held = docs.filter("doc_id % 3 = 0 and n_chars >= 40")
    found = langid.identify(held, model, F.col("text"), F.col("lang"))
    assert found.filter("known").count() >= 0.99 * held.count()
    three = langid.fit(docs.filter("lang <> 'es'"), 150)
    spanish = docs.filter("lang = 'es' and n_chars >= 200").withColumn("lang", F.lit("fr"))
    found = langid.identify(spanish, three, F.col("text"), F.col("lang"))
    assert found.filter("known").count() <= 0.05 * spanish.count()


def test_texts_of_a_rare_label_are_known(spark):
    docs = load(spark, SF, "documents").select("doc_id", "text", "lang")
    one = spark.createDataFrame([(-1, "Все люди рождаются свободными и равными", "ru")], docs.schema)
    docs = docs.unionAll(one)
    found = langid.identify(docs, langid.fit(docs), F.col("text"), F.col("lang"))
    assert found.filter("row.c0 = -1").first().known


def test_more_labels_than_the_bound(spark):
    """The largest labels are fitted; texts of the others are not taken for strange."""
    words = "alpha beta gamma delta epsilon zeta eta theta iota kappa".split()
    rows = [
        (40 * k + i, f"{words[k % 10]} {words[i % 10]} tale{k} " * 8, f"l{k:03}")
        for k in range(300)
        for i in range(2 if k < 290 else 40)
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.fit(docs)
    assert len(model.labels) == 256 and model.more_labels
    assert {f"l{k}" for k in range(290, 300)} < set(model.labels)
    assert "l289" not in model.labels
    found = langid.identify(docs, model, F.col("text"), declared=F.col("lang")).collect()
    assert len(found) == len(rows)
    assert all(r.known for r in found if r.declared not in model.labels)
    assert all(r.posterior is not None for r in found)
    small = langid.fit(docs, max_labels=2)
    assert small.labels == ("l290", "l291")


@pytest.mark.parametrize("opener", ["<script ", "<!--", "<a ", "<", "<style>", "<html "])
def test_a_megabyte_of_openers(spark, opener):
    page = opener * (1_000_000 // len(opener))
    df = spark.createDataFrame([(f"<p>seen</p>{page}",)], "html string")
    start = time.monotonic()
    html = F.col("html")
    seen = df.select(langid.visible_text(html), langid.declared_language(html)).first()
    assert time.monotonic() - start < 60
    assert seen[0].startswith(" seen ")


def test_a_letter_run_of_a_megabyte(spark):
    docs = spark.createDataFrame(
        [(i, "word of a text " * 20, "en") for i in range(30)] + [(99, "a" * 1_000_000, "en")],
        "doc_id long, text string, lang string",
    )
    start = time.monotonic()
    found = langid.identify(docs, langid.fit(docs), F.col("text")).collect()
    assert time.monotonic() - start < 60 and len(found) == 31
