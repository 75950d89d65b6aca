import numpy as np
import pytest

from siltstone.llm.collision_search import Settings, nearest
from siltstone.llm.queries import op9_nearest_neighbours
from siltstone.llm.tables import load

SF = "/root/testdata/sf0.1"


def exact(rows, queries, k):
    """Brute force over (id, vector) rows: by query id, (rank, id) of each of its vectors."""
    usable = set()
    for i, v in rows:
        fine = i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)
        if fine and any(v):
            usable.add((i, tuple(v)))
    arrays = [(i, v, np.array(v, float)) for i, v in usable]
    out = {}
    for q, w, v in arrays:
        if q in queries:
            others = [(i, u) for i, t, u in arrays if len(t) == len(w) and (i, t) != (q, w)]
            scores = sorted((-(u @ v) / np.sqrt((u @ u) * (v @ v)), i) for i, u in others)
            if scores:
                best = [(rank, i) for rank, (_, i) in enumerate(scores[:k], 1)]
                out[q] = sorted(out.get(q, []) + best)
    return out


def by_query(found):
    out = {}
    for r in sorted(found.collect(), key=lambda r: (r.rank, r.vec_id)):
        out.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    return out


def test_recall_on_the_whole_table(spark):
    rows = [tuple(r) for r in load(spark, SF, "embeddings").select("vec_id", "embedding").collect()]
    queries = {i for i, _ in rows if i % 50 == 0}
    got = by_query(op9_nearest_neighbours(spark, SF))
    want = exact(rows, queries, 5)
    assert got.keys() == want.keys()
    vectors = {i: np.array(v, float) for i, v in rows}
    hits = 0
    for q, best in want.items():
        assert [r for r, _, _ in got[q]] == [1, 2, 3, 4, 5]
        assert got[q] == sorted(got[q], key=lambda x: (-x[2], x[1]))
        hits += len({i for _, i in best} & {i for _, i, _ in got[q]})
        for _, i, score in got[q]:
            u, v = vectors[i], vectors[q]
            assert score == pytest.approx((u @ v) / np.sqrt((u @ u) * (v @ v)), abs=1e-12)
    assert hits >= 0.9 * 5 * len(want)


def test_small_parts_and_blocks_give_the_same(spark):
    table = load(spark, "/root/testdata/sf0.001", "embeddings")
    queries = table.select("vec_id").filter("vec_id % 20 = 0")
    rows = [tuple(r) for r in table.select("vec_id", "embedding").collect()]
    want = exact(rows, {i for i, _ in rows if i % 20 == 0}, 5)
    settings = Settings(rows_per_part=100, queries_per_block=7)
    got = by_query(nearest(table, queries, 5, settings))
    hits = sum(len({i for _, i in b} & {i for _, i, _ in got[q]}) for q, b in want.items())
    assert got.keys() == want.keys() and hits >= 0.9 * 5 * len(want)


def test_odd_rows(spark):
    copies = [(i, [1.0, 2.0, 0.0]) for i in range(10, 40)]
    rows = copies + [
        (0, [1.0, 2.0, 0.1]), (1, [1.0, 2.0, 0.1]), (1, [1.0, 2.0, 0.1]), (2, None),
        (3, [0.0, 0.0, 0.0]), (4, [None, 1.0, 1.0]), (5, [float("nan"), 1.0, 1.0]),
        (6, [float("inf"), 1.0, 1.0]), (7, [1.0, 1.0]), (None, [1.0, 2.0, 0.0]), (8, []),
        (9, [-3.0, 1.0, 2.0]), (9, [-3.5, 1.0, 2.0]), (70, [2.0, 1.0]), (7, [5.0, 0.5, 1.0]),
        (71, [3.0]), (72, [0.0, -1.0]),
    ]
    table = spark.createDataFrame(
        [(i, v, 1, 2) for i, v in rows], "vec_id long, embedding array<double>, v int, part int"
    )
    asked = {0, 2, 3, 4, 5, 6, 7, 8, 9, 10, 25, 71}
    queries = spark.createDataFrame([(i,) for i in asked] + [(0,), (None,)], "vec_id long")
    got = by_query(nearest(table, queries, 5))
    want = exact(rows, asked, 5)
    assert got.keys() == want.keys()
    for q, best in want.items():
        assert [(rank, i) for rank, i, _ in got[q]] == best
    assert [rank for rank, _, _ in got[9]] == [1, 1, 2, 2, 3, 3, 4, 4, 5, 5]
    assert {i for _, i, _ in got[7]} > {70, 72}


def test_an_id_of_most_rows(spark):
    draw = np.random.default_rng(5)
    rows = [(50 if i % 3 else i, draw.standard_normal(4).tolist()) for i in range(300)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    ids = spark.createDataFrame([(50,), (0,)], "vec_id long")
    got = by_query(nearest(table, ids, 3, Settings(rows_per_part=64, queries_per_block=9)))
    want = exact(rows, {0, 50}, 3)
    assert got.keys() == want.keys()
    assert {q: len(found) for q, found in got.items()} == {q: len(best) for q, best in want.items()}
    hits = [
        len(set(best) & {(rank, i) for rank, i, _ in got[q]}) / len(set(best))
        for q, best in want.items()
    ]
    assert min(hits) >= 0.9


def test_fewer_candidates_and_empty_tables(spark):
    table = spark.createDataFrame([(0, [1.0]), (1, [-1.0]), (2, [2.0])], "vec_id long, embedding array<float>")
    ids = table.select("vec_id")
    assert [(i, s) for _, i, s in by_query(nearest(table, ids, 5))[0]] == [(2, 1.0), (1, -1.0)]
    assert nearest(table, ids.limit(0), 5).collect() == []
    assert nearest(table.limit(0), ids, 5).collect() == []
    one = by_query(nearest(table.limit(1), ids, 5))
    assert one == {}
