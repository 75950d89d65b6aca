import random

import numpy as np
import pytest
import xxhash

from siltstone.llm import components, simhash
from siltstone.llm.components import connected_components
from siltstone.llm.tables import few_parts, materialize

SF = "/root/testdata/sf0.01"


def slow_fingerprint(text, shingle=4):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for blank in "\t\n\x0b\x0c\r":
        lowered = lowered.replace(blank, " ")
    words = [w for w in lowered.split(" ") if w]
    if not words:
        return 0
    last = max(1, len(words) - shingle + 1)
    grams = [" ".join(words[i : i + shingle]) for i in range(last)]
    hashes = [xxhash.xxh64_intdigest(g.encode(), seed=42) for g in grams]
    return sum(
        1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)
    )


def slow_components(rows, max_bits=4):
    """Smallest id of what links reach, by comparing every pair of fingerprints."""
    fps = sorted({fp for _, fp in rows})
    parent = {f: f for f in fps}

    def root(f):
        while parent[f] != f:
            f = parent[f]
        return f

    for i, a in enumerate(fps):
        for b in fps[i + 1 :]:
            if (a ^ b).bit_count() <= max_bits:
                parent[root(a)] = root(b)
    first = {}
    for doc_id, fp in rows:
        if doc_id is not None:
            first[root(fp)] = min(doc_id, first.get(root(fp), doc_id))
    return [(d, format(fp, "016x"), first.get(root(fp))) for d, fp in rows]


def check(docs, **options):
    rows = [(r.doc_id, slow_fingerprint(r.text)) for r in docs.collect()]
    found = simhash.near_duplicates(docs, **options)
    got = [tuple(r) for r in found.select("doc_id", "fingerprint", "component_id").collect()]
    assert sorted(got, key=str) == sorted(slow_components(rows), key=str)


def test_whole_table(spark):
    check(spark.read.parquet(f"{SF}/documents.parquet"))


def test_odd_rows(odd_docs):
    check(odd_docs)


def test_empty_table(no_docs):
    assert simhash.near_duplicates(no_docs).collect() == []


@pytest.mark.parametrize("long_list", [1024, 8, 2])
def test_links_of_dense_clusters(spark, long_list):
    draw = random.Random(3)
    fps = {0}
    for centre in [draw.getrandbits(64) for _ in range(6)]:
        for _ in range(60):
            bits = draw.sample(range(64), draw.randint(0, 5))
            fps.add(centre ^ sum(1 << b for b in bits))
    fps |= {draw.getrandbits(64) for _ in range(500)}
    signed = [(int(np.uint64(f).astype(np.int64)),) for f in fps]
    table = spark.createDataFrame(signed, "fp long")
    found = simhash.links(table, 4, long_list)
    pairs = found.collect()
    for a, b in pairs:
        assert ((a ^ b) & (1 << 64) - 1).bit_count() <= 4
    label = {r.node: r.label for r in connected_components(found).collect()}
    rows = [(i, f & (1 << 64) - 1) for i, (f,) in enumerate(signed)]
    want = {}
    for i, _, first in slow_components(rows):
        want.setdefault(first, set()).add(signed[i][0])
    got = {}
    for (f,) in signed:
        got.setdefault(label.get(f, f), set()).add(f)
    assert sorted(map(sorted, want.values())) == sorted(map(sorted, got.values()))


def test_list_carried_over_batches():
    import pyarrow as pa

    keys = np.array([1, 2, 2, 2, 2, 2, 2, 3, 4, 4])
    fps = np.array([9, 0, 1, 3, 7, 255, 254, 5, 8, 8 + 16])

    def batches(size):
        for at in range(0, len(keys), size):
            columns = [pa.array(keys[at : at + size]), pa.array(fps[at : at + size])]
            yield pa.RecordBatch.from_arrays(columns, names=["key", "fp"])

    results = []
    for size in (1, 2, 3, 4, 10):
        out = [r for b in simhash.scan_lists(1, 4)(batches(size)) for r in b.to_pylist()]
        long = {r["a"] for r in out if r["b"] is None}
        links = sorted(tuple(sorted((r["a"], r["b"]))) for r in out if r["b"] is not None)
        results.append((long, links))
    assert all(r == ({0, 1, 3, 7, 255, 254}, [(8, 24)]) for r in results)


def test_components_of_paths(spark):
    draw = random.Random(1)
    nodes = list(range(1, 301))
    draw.shuffle(nodes)
    paths = [nodes[:200], nodes[200:290], nodes[290:]]
    links = [(a, b) for p in paths for a, b in zip(p, p[1:])]
    got = connected_components(spark.createDataFrame(links, "a long, b long"))
    assert {r.node: r.label for r in got.collect()} == {n: min(p) for p in paths for n in p}


def test_no_links(spark):
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.fixture
def many_partitions(spark):
    """Shuffles of 64 partitions, however little is in them."""
    held = {"spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in held}
    for k, v in held.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def test_small_results_are_few_files(spark, many_partitions, monkeypatch):
    """Each file costs an executor three programs, which share its memory for a moment."""
    random.seed(5)
    rows = []
    for i in range(400):
        words = [random.choice("abcdefgh") * random.randint(1, 9) for _ in range(120)]
        copy = [*words[:60], "other", *words[61:]]
        rows += [(3 * i, " ".join(words)), (3 * i + 1, " ".join(words)), (3 * i + 2, " ".join(copy))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    files = []

    def counted(df):
        stored = materialize(df)
        files.append(len(stored.inputFiles()))
        return stored

    for module in (simhash, components):
        monkeypatch.setattr(module, "materialize", counted)
    expected = slow_components([(i, slow_fingerprint(t)) for i, t in rows])
    kept = counted(simhash.keep_one(docs)).select("doc_id").collect()
    assert sorted(r[0] for r in kept) == sorted({first for _, _, first in expected})
    assert len(files) >= 7
    assert max(files) <= spark.sparkContext.defaultParallelism, files


def test_few_parts_grow_with_the_rows(spark):
    cores = spark.sparkContext.defaultParallelism
    df = spark.range(0, 1000, 1, 10 * cores)
    assert few_parts(df, 1000).rdd.getNumPartitions() == cores
    assert few_parts(df, 1000, 1000 // (3 * cores)).rdd.getNumPartitions() > 3 * cores - 1
    assert few_parts(df, 1000, 1).rdd.getNumPartitions() == 10 * cores
    assert few_parts(spark.range(0, 9, 1, 2), 9).rdd.getNumPartitions() == 2
