import hashlib
import random
import time
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from siltstone.llm import periodic, queries

SF = "/root/testdata/sf0.01"


def slow_runs(words, min_length=6, min_repeats=4):
    """Every maximal stretch of every period, kept if no smaller period fits it."""
    n, found = len(words), []
    for q in range(1, n):
        at = 0
        while at + q < n:
            if words[at] != words[at + q]:
                at += 1
                continue
            end = at
            while end + q < n and words[end] == words[end + q]:
                end += 1
            length = end + q - at
            part = words[at : at + length]
            smaller = any(part[d:] == part[:-d] for d in range(1, q))
            if length >= max(min_length, min_repeats * q) and not smaller:
                found.append((at, length, q))
            at = end
    return sorted(found, key=lambda r: (r[0], r[2]))


def slow_row(doc_id, text):
    for blank in "\t\n\x0b\x0c\r":
        text = (text or "").replace(blank, " ")
    words = [w for w in (text or "").split(" ") if w]
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    g = h // 10
    if doc_id is not None and h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = fast_enough(words)
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None,) * 3)
    dropped = {i for s, m, q in runs for i in range(s + q, s + m)}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (
        doc_id,
        len(runs),
        *best,
        best[1] and 1000 * best[1] // best[2],
        sha("".join(f"{s},{m},{q}\n" for s, m, q in runs)),
        sha(" ".join(w for i, w in enumerate(words) if i not in dropped)),
    )


def fast_enough(words):
    """``slow_runs``, comparing whole diagonals at once."""
    number = {}
    ids = np.array([number.setdefault(w, len(number)) for w in words], np.int64)
    found = []
    for q in range(1, len(ids) // 4 + 1):
        same = np.concatenate([[0], ids[:-q] == ids[q:], [0]]).astype(np.int8)
        steps = np.diff(same)
        for a, b in zip(np.flatnonzero(steps == 1), np.flatnonzero(steps == -1)):
            length = int(b - a + q)
            if length >= max(6, 4 * q):
                part = ids[a : a + length]
                if not any((part[d:] == part[:-d]).all() for d in range(1, q)):
                    found.append((int(a), length, q))
    return sorted(found, key=lambda r: (r[0], r[2]))


words = st.lists(st.integers(0, 2), max_size=60)
repeated = st.builds(
    lambda head, loop, times, tail: head + loop * times + tail,
    st.lists(st.integers(0, 3), max_size=8),
    st.lists(st.integers(0, 2), min_size=1, max_size=15),
    st.integers(1, 7),
    st.lists(st.integers(0, 3), max_size=8),
)


@given(st.one_of(words, repeated, st.builds(lambda a, b: a + b, repeated, repeated)))
@settings(max_examples=600, deadline=None)
def test_every_run_is_found_once(ids):
    assert periodic.runs_of(np.array(ids, np.int64), 6, 4) == slow_runs(ids)
    assert fast_enough(ids) == slow_runs(ids)


@given(repeated, st.integers(2, 20), st.integers(3, 6))
@settings(max_examples=200, deadline=None)
def test_other_lengths_and_repeats(ids, length, repeats):
    found = periodic.runs_of(np.array(ids, np.int64), length, repeats)
    assert found == slow_runs(ids, length, repeats)


def test_query_on_the_whole_table(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    got = queries.op12_periodic_runs(spark, SF).collect()
    assert sorted(map(tuple, got)) == sorted(slow_row(*r) for r in rows)
    assert sum(r.n_runs for r in got) > 50


def test_odd_rows(odd_docs):
    looped = odd_docs.withColumn("looped", periodic.looped_text("doc_id", "text"))
    found = periodic.periodic_runs(looped, text="looped").collect()
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    assert [(r.row.c0, len(r.runs)) for r in found] == [slow_row(*r)[:2] for r in rows]
    by_text = {r.row.c1: r for r in found}
    assert by_text[None].collapsed == "" and by_text[None].n_words == 0
    assert by_text["word " * 3000].collapsed == "word"
    assert found[0].row.c5 == 1  # columns of the operator's own names stay


def test_empty_table(no_docs):
    assert periodic.periodic_runs(no_docs).collect() == []


def test_ties_take_the_first_run(spark):
    df = spark.createDataFrame(
        [("a a a a a a b c c c c c c",), ("x y",)], "text string"
    )
    found = periodic.periodic_runs(df).select(periodic.longest_run().alias("r"), "collapsed")
    first, none = found.collect()
    assert tuple(first.r) == (0, 6, 1) and first.collapsed == "a b c"
    assert none.r is None


@pytest.mark.parametrize("kind", ["one word", "long loop", "few words"])
def test_a_million_words_take_seconds(kind):
    rng = random.Random(1)
    loop = [str(rng.random()).encode() for _ in range(5000)]
    text = {
        "one word": [b"a"] * 1_000_000,
        "long loop": loop * 200,
        "few words": rng.choices([b"a", b"b"], k=1_000_000),
    }[kind]
    start = time.monotonic()
    (found,) = periodic.search([text], 6, 4)
    assert time.monotonic() - start < 60
    if kind != "few words":
        assert found == [(0, 1_000_000, 1 if kind == "one word" else 5000)]


def test_arguments_are_checked(odd_docs):
    with pytest.raises(ValueError):
        periodic.periodic_runs(odd_docs, min_repeats=2)
    with pytest.raises(ValueError):
        periodic.periodic_runs(odd_docs.select(F.lit("").alias("text")), min_length=1)
