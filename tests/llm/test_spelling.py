import random
import re
import string
import time
import zlib
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from siltstone.llm import queries, spelling

SF = "/root/testdata/sf0.01"


def slow_counts(rows, every=97, min_length=5, min_count=3):
    found = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c in string.ascii_uppercase else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if every and h % every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= min_length:
                found[run] += 1
    return {w: n for w, n in found.items() if n >= min_count}


def one_apart(a, b):
    """Whether one inserted, deleted or replaced character tells them apart."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def near_by_pairs(words):
    """Every pair compared."""
    return {w: {v for v in words if one_apart(v, w)} for w in words}


def near_by_gaps(words):
    """The same for many words: a letter blotted out, or left out."""
    blotted, near = {}, {w: set() for w in words}
    for w in words:
        for i in range(len(w)):
            blotted.setdefault(w[:i] + "*" + w[i + 1 :], set()).add(w)
            shorter = w[:i] + w[i + 1 :]
            if shorter in near:
                near[w].add(shorter)
                near[shorter].add(w)
    for group in blotted.values():
        for w in group:
            near[w] |= group - {w}
    return near


def slow_variants(counts, near_words=near_by_pairs):
    near, form = near_words(counts), {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best and counts[best] >= 2 * counts[w] else None
    rows = []
    for w, n in counts.items():
        root = w
        while form[root]:
            root = form[root]
        rows.append((w, form[w], root, n, len(near[w]), counts.get(form[w])))
    return sorted(rows)


def variants(spark, counts, **options):
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    return sorted(tuple(r) for r in spelling.spelling_variants(df, **options).collect())


def test_query_on_the_whole_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    got = sorted(tuple(r) for r in queries.op11_spelling_variants(spark, SF).collect())
    assert got == slow_variants(slow_counts(docs), near_by_gaps)
    assert sum(form is not None for _, form, *_ in got) > 20


def test_odd_rows(odd_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    for every in (97, 2, None):
        got = spelling.count_words(odd_docs, 2, 1, every).collect()
        assert {r.word: r.n for r in got} == slow_counts(rows, every, 2, 1)


def test_empty_table(spark, no_docs):
    counts = spelling.count_words(no_docs)
    assert counts.collect() == []
    assert spelling.spelling_variants(counts).collect() == []


@pytest.mark.parametrize("seed", range(3))
def test_dense_dictionaries_over_many_ranges(spark, seed):
    rng = random.Random(seed)
    letters = ["ab", "abé", "aÀÿz"][seed]
    words = {"".join(rng.choices(letters, k=rng.randint(1, 7))) for _ in range(400)}
    counts = {w: rng.choice([1, 1, 2, 3, 4, 8, 16, 40]) for w in words}
    for each in (7, 50, 10_000):
        assert variants(spark, counts, words_per_part=each) == slow_variants(counts)
    assert near_by_pairs(counts) == near_by_gaps(counts)


def test_ties_and_chains(spark):
    counts = {"abcde": 1, "abcdf": 2, "abcdg": 2, "abcxf": 4, "abyxf": 8, "zzzzz": 9}
    found = {w: (form, root) for w, form, root, *_ in variants(spark, counts)}
    assert found["abcde"] == ("abcdf", "abyxf")
    assert found["abcdg"] == (None, "abcdg") and found["zzzzz"] == (None, "zzzzz")


def test_very_long_words(spark):
    base = "ab" * 300_000
    counts = {base: 10, base + "a": 4, base[:-1] + "c": 3, base[1:]: 2, "a" * 600_000: 3}
    start = time.monotonic()
    got = variants(spark, counts, words_per_part=2)
    assert time.monotonic() - start < 120
    want = {w: sum(one_apart_long(w, v) for v in counts if v != w) for w in counts}
    assert {w: near for w, _, _, _, near, _ in got} == want
    assert {w: form for w, form, *_ in got}[base[1:]] == base


def one_apart_long(a, b):
    """``one_apart`` for words too long to try every place: compare around the first change."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1:
        return False
    at = spelling.shared_length(a, b)
    return a[at + (len(a) == len(b)) :] == b[at + 1 :]


sorted_words = st.lists(st.text("abc", min_size=1, max_size=5), unique=True, min_size=1).map(sorted)


@given(sorted_words, st.integers(1, 5))
@settings(max_examples=300, deadline=None)
def test_nodes_are_one_to_a_prefix(words, each):
    """Nodes met in any range have one number per prefix, and each number one prefix."""
    chunks = [words[i : i + each] for i in range(0, len(words), each)]
    known = spelling.ranges([(p, c[0], c[-1]) for p, c in enumerate(chunks)])
    number = {}
    for p, chunk in enumerate(chunks):
        for word, nodes in zip(chunk, spelling.walk(chunk, known[p])):
            assert len(nodes) == len(word) + 1
            for d, node in enumerate(nodes):
                assert number.setdefault(word[:d], node) == node
    assert len(set(number.values())) == len(number)


def test_slices_give_the_same_runs():
    rng = random.Random(5)
    text = "".join(rng.choices("aB é×ÿ1- ", k=3000))
    for size in (1, 7, 100, 5000):
        assert spelling.letter_runs(text, size) == spelling.letter_runs(text)


def test_arguments_are_checked(spark):
    with pytest.raises(ValueError):
        variants(spark, {"abcde": 1}, dominance=1)
