import pytest

import corpus_pipeline
from siltstone.llm import simhash
from siltstone.llm.tables import load, materialize

from tests.llm.test_decontaminate import slow_words
from tests.llm.test_packing import check_packing
from tests.llm.test_secrets import slow_scan
from tests.llm.test_simhash import slow_components, slow_fingerprint

SF = "/root/testdata/sf0.001"


def test_each_stage_on_its_own_input(spark):
    docs = load(spark, SF, "documents")
    names = docs.columns
    frames = [docs]
    for _, stage in corpus_pipeline.STAGES:
        frames.append(materialize(stage(spark, frames[-1], SF)))
    tables = [{r.doc_id: r for r in f.collect()} for f in frames[:-1]]
    assert all(f.columns == names for f in frames[:-1])

    # Language: what stays is unchanged; only texts that cannot be told go.
    assert all(tables[0][i] == r for i, r in tables[1].items())
    assert len(tables[1]) >= 0.98 * len(tables[0])

    # Near-duplicates: the smallest id of each group stays, unchanged.
    rows = [(i, slow_fingerprint(r.text)) for i, r in tables[1].items()]
    assert set(tables[2]) == {first for _, _, first in slow_components(rows)}
    assert all(tables[1][i] == r for i, r in tables[2].items())

    # Benchmark: clean documents unchanged, others without any window.
    windows = set()
    for r in load(spark, SF, "benchmark").collect():
        own = slow_words(r.text)
        size = min(10, len(own))
        windows |= {tuple(own[i : i + size]) for i in range(len(own) - size + 1)} if own else set()
    sizes = {len(w) for w in windows}

    def hits(text):
        words = slow_words(text)
        return {
            k
            for n in sizes
            for j in range(len(words) - n + 1)
            if tuple(words[j : j + n]) in windows
            for k in range(j, j + n)
        }

    for i, r in tables[2].items():
        hit = hits(r.text)
        if not hit:
            assert tables[3][i] == r
        elif len(hit) > 0.5 * len(slow_words(r.text)):
            assert i not in tables[3]
        else:
            assert len(slow_words(tables[3][i].text)) == len(slow_words(r.text)) - len(hit)

    # Secrets: all documents stay, clean ones unchanged, none has a base span left.
    ids = sorted(tables[3])
    assert sorted(tables[4]) == ids
    for i, spans in zip(ids, slow_scan([tables[3][i].text for i in ids])):
        if spans:
            assert "[SECRET]" in tables[4][i].text
            assert tables[4][i].n_chars == len(tables[4][i].text)
        else:
            assert tables[4][i] == tables[3][i]

    texts = [(i, r.text) for i, r in tables[4].items()]
    check_packing(frames[-1].collect(), texts, 2048)


@pytest.mark.parametrize("stage", [f for _, f in corpus_pipeline.STAGES])
def test_odd_rows_and_empty_table(spark, odd_docs, no_docs, stage):
    stage(spark, odd_docs, SF).collect()
    assert stage(spark, no_docs, SF).collect() == []


def test_one_of_each_group_stays(odd_docs):
    # No two of these texts are near each other without being equal.
    groups = {}
    for r in odd_docs.collect():
        groups.setdefault(slow_fingerprint(r.text), []).append(r.doc_id)
    smallest = [min((i for i in g if i is not None), default=None) for g in groups.values()]
    kept = simhash.keep_one(odd_docs).collect()
    assert sorted((r.doc_id for r in kept), key=str) == sorted(smallest, key=str)


def test_documents_without_labels_stay(spark):
    rows = [(i, f"a text of some words, number {i}", None, "src", 20) for i in range(50)]
    rows += [(90, " 12 34 ", None, "src", 7), (91, None, None, None, None)]
    docs = spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_chars long"
    )
    kept = corpus_pipeline.language_id(spark, docs, "")
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == list(range(50))


def test_documents_of_labels_beyond_the_bound_stay(spark):
    rows = [
        (i, f"words of language number {i} " * 9, f"l{i // 3:03}", "src", 99) for i in range(900)
    ]
    docs = spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_chars long"
    )
    kept = corpus_pipeline.language_id(spark, docs, "")
    beyond = {r.doc_id for r in kept.collect() if r.lang >= "l256"}
    assert beyond == set(range(3 * 256, 900))
