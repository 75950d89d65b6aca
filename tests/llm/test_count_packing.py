import zlib
from collections import Counter
from functools import cache
from itertools import combinations_with_replacement

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from siltstone.llm import count_packing, queries

SF = "/root/testdata/sf0.01"


@cache
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def ids_of(text):
    return [*tokenizer().encode(text or "", add_special_tokens=False).ids, 0]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def check_sequences(rows, capacity):
    """Gapless from 0, within the capacity, full or a power of two; the full ones' number."""
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for placed in sequences.values():
        at = 0
        for offset, length in sorted(placed):
            assert offset == at and length > 0
            at += length
        assert at == capacity or (at < capacity and at.bit_count() == 1)
    assert sorted(sequences) == list(range(len(sequences)))


def check_ids(rows, docs):
    """Documents with their own ids: the pieces cover each, with its checksums."""
    for doc_id, text in docs:
        ids, at = ids_of(text), 0
        for r in sorted((r for r in rows[doc_id]), key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids)
            assert r.ids_crc32 == crc(ids[at : at + r.length])
            at += r.length
        assert at == len(ids)


def test_query_on_the_whole_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    rows = queries.op13_count_packing(spark, SF).collect()
    check_sequences(rows, 1024)
    by_doc = {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
    check_ids(by_doc, docs)
    assert len(by_doc) == len(docs)
    short = [r for r in rows if r.doc_tokens < 1024]
    assert sum(r.planned for r in short) > len(short) / 4


@pytest.mark.parametrize("capacity", [2, 48, 64, 1024])
def test_odd_rows(odd_docs, capacity):
    docs = [(r.doc_id, r.text) for r in odd_docs.collect()]
    rows = count_packing.pack_by_counts(odd_docs, capacity).collect()
    check_sequences(rows, capacity)
    # Ids repeat here, so tokens are compared by how often each place of a text occurs.
    sizes = [(d, len(ids_of(t))) for d, t in docs]
    want = Counter((d, i, n) for d, n in sizes for i in range(n))
    got = Counter(
        (r.doc_id, i, r.doc_tokens) for r in rows for i in range(r.start, r.start + r.length)
    )
    assert got == want
    unique = [(i, t) for i, t in docs if i is not None and [d for d, _ in docs].count(i) == 1]
    by_doc = {i: [r for r in rows if r.doc_id == i] for i, _ in unique}
    check_ids(by_doc, unique)


def test_empty_table(no_docs):
    assert count_packing.pack_by_counts(no_docs).collect() == []


def test_numbers_go_on_from_task_to_task(spark, monkeypatch):
    texts = [(i, "word " * (i % 7)) for i in range(3000)]
    df = spark.createDataFrame(texts, "doc_id long, text string").repartition(13)
    for limit in (500_000, 0):  # by broadcast and by shuffle
        monkeypatch.setattr(count_packing, "BROADCAST_ROWS", limit)
        rows = count_packing.pack_by_counts(df, 16).collect()
        check_sequences(rows, 16)
        assert sum(r.length for r in rows) == sum(len(ids_of(t)) for _, t in texts)
        assert {r.doc_id for r in rows} == set(range(3000))
        whole = sum(r.length == r.doc_tokens for r in rows)
        assert whole > 2800


def test_a_million_blanks(spark):
    texts = [(1, " " * 1_000_000 + "a"), (2, "\n" * 1_000_000), (3, "a" * 1_000_000)]
    df = spark.createDataFrame(texts, "doc_id long, text string")
    rows = count_packing.pack_by_counts(df, 1024).collect()
    check_sequences(rows, 1024)
    check_ids({i: [r for r in rows if r.doc_id == i] for i, _ in texts}, texts)


@given(st.lists(st.integers(1, 16), min_size=1, max_size=6, unique=True))
@settings(max_examples=60, deadline=None)
def test_combinations_are_all_that_fill_the_window(lengths):
    want = {
        tuple(sorted(c, reverse=True)) + (0,) * (3 - n)
        for n in (1, 2, 3)
        for c in combinations_with_replacement(lengths, n)
        if sum(c) == 16
    }
    got = count_packing.combinations(np.array(sorted(lengths)), 16)
    assert {tuple(c) for c in got.tolist()} == want and len(got) == len(want)


def test_least_squares_meets_the_optimality_conditions():
    rng = np.random.default_rng(1)
    wanted = np.concatenate([[0], rng.integers(0, 50, 32)]).astype(float)
    combos = count_packing.combinations(np.arange(1, 33), 32)
    x = count_packing.least_squares(combos, wanted, rounds=20_000)
    matrix = np.zeros((33, len(combos)))
    for i, combo in enumerate(combos):
        np.add.at(matrix[:, i], combo, 1)
    matrix[0] = 0
    gradient = matrix.T @ (matrix @ x - wanted)
    assert (x >= 0).all() and gradient.min() > -0.05
    assert np.abs(gradient[x > 0.01]).max() < 0.05


@given(st.dictionaries(st.integers(1, 24), st.integers(1, 10**9), max_size=24))
@settings(max_examples=80, deadline=None)
def test_a_plan_places_every_piece_once(histogram):
    plan = count_packing.solve(histogram, 24)
    for length, count in histogram.items():
        own = plan.length == length
        firsts = plan.first[own]
        assert plan.spare[length] <= count
        assert (np.diff(firsts) > 0).all()
        assert (len(firsts) > 0) == (plan.spare[length] > 0)
    rest = sum((n - int(plan.spare[x])) * x for x, n in histogram.items())
    assert plan.tail[-1] == rest


def test_arguments_are_checked(odd_docs):
    with pytest.raises(ValueError):
        count_packing.pack_by_counts(odd_docs, 1)
