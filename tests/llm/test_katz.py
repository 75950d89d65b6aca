import math
import random
import time
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from siltstone.llm import katz
from siltstone.llm.tables import load

SF = "/root/testdata/sf0.001"
HELD = "crc32(cast(doc_id AS string)) % 7 = 2"


def tokens_of(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for blank in "\t\n\x0b\x0c\r":
        lowered = lowered.replace(blank, " ")
    return [*(w for w in lowered.split(" ") if w), "</s>"]


class Slow:
    """Katz backoff with dictionaries, straight from the definition."""

    def __init__(self, texts, order):
        self.order = order
        self.counts = {k: Counter() for k in range(1, order + 1)}
        for text in texts:
            words = ["<s>"] * (order - 1) + tokens_of(text)
            for i in range(order - 1, len(words)):
                for k in self.counts:
                    self.counts[k][tuple(words[i - k + 1 : i + 1])] += 1
        self.factor = {}
        for k, counts in self.counts.items():
            n = Counter(counts.values())
            last = 6 * n[6] / n[1] if n[1] else 1
            for r in range(1, 6):
                d = None
                if n[r] and n[r + 1] and last < 1:
                    d = ((r + 1) * n[r + 1] / (r * n[r]) - last) / (1 - last)
                self.factor[k, r] = d if d is not None and 0 < d < 1 else (r - 0.5) / r
        self.followers = {}
        for k in range(2, order + 1):
            for gram, c in self.counts[k].items():
                self.followers.setdefault(gram[:-1], []).append((gram[-1], c))
        self.n = sum(self.counts[1].values())
        self.singles = sum(self.kept(1, c) for c in self.counts[1].values())
        self.cache = {}

    def kept(self, k, c):
        return c * self.factor.get((k, c), 1.0)

    def share(self, seen, kept):
        return seen + 1 if kept > seen - 1e-9 * (seen + 1) else seen

    def p(self, word, past):
        if not past:
            kept = self.singles
            by = self.share(self.n, kept)
            c = self.counts[1][(word,)]
            return self.kept(1, c) / by if c else (1 - kept / by if self.n else 1.0)
        k = len(past) + 1
        if past not in self.followers:
            return self.p(word, past[1:])
        if past not in self.cache:
            seen = sum(c for _, c in self.followers[past])
            kept = sum(self.kept(k, c) for _, c in self.followers[past])
            by = self.share(seen, kept)
            lower = sum(self.p(w, past[1:]) for w, _ in self.followers[past])
            self.cache[past] = by, (1 - kept / by) / (1 - lower)
        by, weight = self.cache[past]
        c = self.counts[k][(*past, word)]
        return self.kept(k, c) / by if c else weight * self.p(word, past[1:])

    def score(self, text):
        words = ["<s>"] * (self.order - 1) + tokens_of(text)
        return sum(
            math.log10(self.p(words[i], tuple(words[i - self.order + 1 : i])))
            for i in range(self.order - 1, len(words))
        )


def is_held(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 2


def compare(docs, order, **sizes):
    texts = [(r.doc_id, r.text) for r in docs.collect()]
    slow = Slow([t for i, t in texts if not is_held(i)], order)
    want = Counter()
    types = len(slow.counts[1])
    for i, text in texts:
        words = tokens_of(text)
        counts = [slow.counts[1][(w,)] for w in words]
        base = sum(math.log10((c + 1) / (slow.n + types + 1)) for c in counts)
        known = sum(c > 0 for c in counts)
        row = (i, is_held(i), len(words), known, slow.n)
        want[(*row, round(base, 6), round(slow.score(text), 6))] += 1
    got = Counter()
    for r in katz.train_and_score(docs, HELD, order, **sizes).collect():
        got[(*tuple(r)[:5], round(r.base_score, 6), round(r.score, 6))] += 1
    assert got == want
    return slow


@pytest.mark.parametrize("order", [2, 3])
def test_whole_table(spark, order):
    docs = load(spark, SF, "documents")
    compare(docs, order, chunk_tokens=30_000, bucket_entries=30_000)


@pytest.mark.parametrize("order", [1, 2, 3])
def test_distributions_sum_to_one(spark, order):
    draw = random.Random(order)
    words = ["a", "b", "c", "d", "e", "f", "g"]
    rows = [
        (i, " ".join(draw.choices(words, [9, 5, 3, 2, 1, 1, 1], k=draw.randint(0, 12))))
        for i in range(120)
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    slow = compare(docs, order, chunk_tokens=200, bucket_entries=150)
    vocabulary = [w for (w,) in slow.counts[1]] + ["never seen"]
    pasts = [()] + [(w,) for w in vocabulary] + [("a", w) for w in vocabulary]
    for past in pasts:
        if len(past) < order:
            assert sum(slow.p(w, past) for w in vocabulary) == pytest.approx(1, abs=1e-9)


def test_odd_rows(odd_docs):
    compare(odd_docs, 2)
    compare(odd_docs, 2, chunk_tokens=3, bucket_entries=900)


def test_empty_table_and_nothing_to_learn(spark, no_docs):
    assert katz.train_and_score(no_docs).collect() == []
    held = [i for i in range(60) if is_held(i)]
    docs = spark.createDataFrame([(i, "a b a") for i in held], "doc_id long, text string")
    rows = katz.train_and_score(docs).collect()
    assert len(rows) == len(held) and all(r.n_known == r.train_tokens == 0 for r in rows)
    compare(docs, 2)


def test_better_than_the_base_on_held_out_texts(spark):
    rows = katz.train_and_score(load(spark, "/root/testdata/sf0.01", "documents")).collect()
    held = [r for r in rows if r.held_out]
    assert held and sum(r.score for r in held) > sum(r.base_score for r in held)


def test_cells():
    draw = np.random.default_rng(1)
    keys = np.sort(draw.integers(0, 1 << 63, 500, np.uint64) * np.uint64(2))
    assert (katz.unpacked_keys(katz.packed_keys(keys), 500) == keys).all()
    for values in (draw.normal(size=9), np.zeros(0), np.arange(7, dtype=np.uint32)):
        assert (katz.unpacked(katz.packed(values), len(values), values.dtype) == values).all()
    edges = katz.cuts(keys, 8)
    for b in range(8):
        assert ((keys[edges[b] : edges[b + 1]] >> np.uint64(61)) == b).all()


@pytest.mark.parametrize("upper_bits", [64, 8, 1])
def test_grouped(upper_bits):
    """Also of keys that agree in their upper bits and so are not told apart at first."""
    draw = np.random.default_rng(5)
    few = draw.integers(0, 1 << 64, 700, np.uint64)
    if upper_bits < 64:
        few = few >> np.uint64(64 - upper_bits) << np.uint64(64 - upper_bits) | few % np.uint64(512)
    for n in (0, 1, 2, 2000):
        keys = few[draw.integers(0, len(few), n)]
        distinct, place, first = katz.grouped(keys)
        expected = np.unique(keys, return_index=True, return_inverse=True)
        for mine, other in zip((distinct, first, place), expected):
            assert (mine == other).all()


def test_grouping_takes_less_time_than_sorting_places():
    keys = np.random.default_rng(6).integers(0, 1 << 64, 500_000, np.uint64)

    def seconds(work):
        taken = []
        for _ in range(5):
            start = time.process_time()
            work()
            taken.append(time.process_time() - start)
        return min(taken)

    assert seconds(lambda: katz.grouped(keys)) < 0.8 * seconds(lambda: np.unique(keys, return_inverse=True))


@pytest.mark.parametrize("kind", [pa.string(), pa.large_string()])
def test_split_words(kind):
    draw = random.Random(7)
    letters = " \t\n\x0b\x0c\r\x1c\x1f\x85\xa0\u2003aAbB\xc0\xe9z\x00\u0130"
    texts = ["".join(draw.choices(letters, k=draw.randrange(12))) for _ in range(3000)]
    texts += ["", " ", "\t \n"]
    for at in (0, 5, len(texts)):
        words, sizes = katz.split_words(pa.array(texts, kind).slice(at))
        expected = [t.encode().lower().split() for t in texts[at:]]
        assert sizes.tolist() == [len(e) for e in expected]
        assert words.cast(pa.large_binary()).to_pylist() == [w for e in expected for w in e]


def test_chunks_are_not_moved(spark):
    """Neither the bucketed table of chunks nor the answers added to theirs are shuffled."""
    from pyspark.sql import functions as F

    rows = spark.range(20).select(F.col("id").alias("chunk"))
    for name in ("katz_plan", "katz_plan_too", "katz_plan_too"):
        rows.write.bucketBy(4, "chunk").mode("append").saveAsTable(name)
    try:
        table, other = spark.table("katz_plan"), spark.table("katz_plan_too")
        other = other.filter("chunk IS NOT NULL")
        joined = table.groupBy("chunk").cogroup(other.groupBy("chunk"))
        plan = joined.applyInArrow(lambda a, b: b, "chunk long")
        text = plan._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in text, text
        assert plan.count() == 40
    finally:
        spark.sql("DROP TABLE katz_plan")
        spark.sql("DROP TABLE katz_plan_too")


def test_rare_ngrams_that_are_not_asked_for(spark):
    """Chunks know most long n-grams; the scores are those of all counts."""
    draw = np.random.default_rng(5)
    words = [f"w{n}" for n in draw.zipf(1.3, 6000) % 5000]
    rows = [(i, " ".join(words[i * 100 : i * 100 + 100])) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for order in (3, 4):
        compare(docs, order, chunk_tokens=900, bucket_entries=2000)


def test_sums_do_not_depend_on_chunks(spark):
    docs = load(spark, SF, "documents")
    found = []
    for size in (5_000, 1_000_000):
        rows = katz.train_and_score(docs, HELD, 3, chunk_tokens=size).collect()
        found.append({r.doc_id: round(r.score, 6) for r in rows})
    assert found[0] == found[1]


def shuffle_files(spark) -> set[str]:
    env = spark._jvm.org.apache.spark.SparkEnv.get()
    files = env.blockManager().diskBlockManager().getAllFiles()
    names = [files.apply(i).getName() for i in range(files.size())]
    return {n for n in names if n.startswith("shuffle_")}


def test_questions_leave_the_disk_with_their_order(spark, monkeypatch):
    rows = [(i, f"a{i % 7} b{i % 3} c{i % 5} d{i}") for i in range(60)]
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, setting, left = shuffle_files(spark), spark.conf.get(key), []

    def summed(replies):
        end = time.time() + 5  # the files are removed in the background
        while shuffle_files(spark) - before and time.time() < end:
            time.sleep(0.2)
        left.append(shuffle_files(spark) - before)
        return counted(replies)

    counted = katz.summed
    monkeypatch.setattr(katz, "summed", summed)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert katz.train_and_score(docs, order=3, chunk_tokens=50, bucket_entries=40).count() == 60
    assert left == [set()] * 3
    assert spark.conf.get(key) == setting
