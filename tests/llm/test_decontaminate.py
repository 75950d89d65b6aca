import hashlib
import random

import pytest

from siltstone.llm import decontaminate
from siltstone.llm.queries import op7_benchmark_decontamination, oracle_sql, queries
from siltstone.llm.tables import load
from tests.oracle_compare import compare as compare_sql
from tests.oracle_compare import connect

SF = "/root/testdata/sf0.001"


def slow_words(text):
    out, word = [], ""
    for c in (text or "") + " ":
        c = c.lower() if "A" <= c <= "Z" else c
        if ord(c) > 127 or c.isascii() and c.isalnum():
            word += c
        elif word:
            out.append(word)
            word = ""
    return out


def slow_leaks(text, items, window):
    words = slow_words(text)
    hit, found = set(), set()
    for item, item_text in items:
        own = slow_words(item_text)
        size = min(window, len(own))
        for i in range(len(own) - size + 1 if own else 0):
            for j in range(len(words) - size + 1):
                if words[j : j + size] == own[i : i + size]:
                    hit |= set(range(j, j + size))
                    found.add(item)
    found = sorted(str(i) for i in found if i is not None)
    return len(words), sorted(hit), found


def compare(docs, items, window, **options):
    found = decontaminate.find_leaks(docs, items, window, **options).collect()
    texts = [tuple(r) for r in items.select("item_id", "text").collect()]
    for r in found:
        n, hit, ids = slow_leaks(r.text, texts, window)
        got = [i for s in r.spans for i in range(s.a, s.b)]
        assert (r.n_words, got, r["items"]) == (n, hit, ids)
    assert len(found) == docs.count()


@pytest.mark.parametrize("block", [50_000, 24])
def test_random_small_alphabet(spark, block):
    draw = random.Random(7)
    text = lambda n: " ".join(draw.choice("ab") for _ in range(n))
    items = [(i, text(draw.choice([0, 1, 2, 3, 4, 9, 40]))) for i in range(8)]
    items = [(i, t) for i, t in items if len(t) != 1]
    items += [items[0], (None, "b a b a a"), (50, None)]
    docs = [(i, text(draw.randint(0, 60))) for i in range(40)]
    compare(
        spark.createDataFrame(docs, "doc_id long, text string"),
        spark.createDataFrame(items, "item_id long, text string"),
        4,
        block_words=block,
    )


def test_odd_rows(spark, odd_docs):
    items = spark.createDataFrame(
        [(1, "four five"), (2, "ß 日本"), (3, "word word word"), (4, ""), (5, "Two")],
        "item_id long, text string",
    )
    compare(odd_docs, items, 3)


def test_empty_tables(spark, odd_docs, no_docs):
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.find_leaks(no_docs, none).collect() == []
    found = decontaminate.find_leaks(odd_docs, none).collect()
    assert len(found) == odd_docs.count() and not any(r.spans for r in found)


def test_query_against_brute_force(spark):
    items = [tuple(r) for r in load(spark, SF, "benchmark").select("item_id", "text").collect()]
    windows = {}
    for item, text in items:
        own = slow_words(text)
        size = min(10, len(own))
        for i in range(len(own) - size + 1 if own else 0):
            windows.setdefault(tuple(own[i : i + size]), set()).add(item)
    sizes = {len(w) for w in windows}
    texts = {r.doc_id: r.text for r in load(spark, SF, "documents").collect()}
    rows = op7_benchmark_decontamination(spark, SF).collect()
    assert len(rows) == len(texts) and any(r.contaminated for r in rows)
    for r in rows:
        words, hit, found = slow_words(texts[r.doc_id]), set(), set()
        for size in sizes:
            for j in range(len(words) - size + 1):
                if ids := windows.get(tuple(words[j : j + size])):
                    hit |= set(range(j, j + size))
                    found |= ids
        ids = ",".join(sorted(map(str, found)))
        want = (len(words), len(hit), len(found), hashlib.sha256(ids.encode()).hexdigest())
        assert (r.n_words, r.n_hit, r.n_items, r.items_sha256) == want


def test_query_against_sql(spark):
    sf_dir, name = "/root/testdata/sf0.01", "op7_benchmark_decontamination"
    assert compare_sql(queries()[name](spark, sf_dir), connect(sf_dir), oracle_sql()[name]) == []


def test_removal(spark):
    item = "One two three four five six seven eight nine ten eleven"
    docs = spark.createDataFrame(
        [
            (1, f"Kept before, {item}! And kept after that, with more words to keep.", 7, "x"),
            (2, f"{item}, almost alone", 8, "y"),
            (3, "A clean document, with one two three four only.", 9, "z"),
            (4, None, None, None),
        ],
        "doc_id long, text string, n_chars long, items string",
    )
    items = spark.createDataFrame([(1, item)], "item_id long, text string")
    rows = {r.doc_id: r for r in decontaminate.remove_leaks(docs, items, 10).collect()}
    assert sorted(rows) == [1, 3, 4]
    assert rows[1].text == "Kept before, ! And kept after that, with more words to keep."
    assert rows[1].n_chars == len(rows[1].text) and rows[1]["items"] == "x"
    assert tuple(rows[3]) == (3, "A clean document, with one two three four only.", 9, "z")
    assert rows[4].text is None
