"""Nearest neighbours by collision counting over single-projection sorted arrays.

The vectors are dealt over parts. A part keeps, for each of a number of random
projections, its vectors in the order of the projected value. Around a query's own
value a window is opened in every array and widened in rounds (virtual rehashing: no
round builds new tables). A vector collides where it lies in the window; those that
collide in enough arrays are verified with the exact measure.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from siltstone.llm.tables import materialize


@dataclass(frozen=True)
class Settings:
    """``share`` of the ``projections`` in which a vector must collide to be verified.

    Windows have half the width ``first`` at the start, in standard deviations of a
    projected unit vector, and grow by ``growth`` until ``spare`` times as many vectors as
    asked for are verified, and the worst of those to be returned is no farther than
    what the window would let through in ``share`` of the arrays.
    """

    projections: int = 48
    share: float = 0.6
    first: float = 0.4
    growth: float = 1.5
    spare: int = 8
    seed: int = 17
    rows_per_part: int = 8192
    queries_per_block: int = 8192


def taking_part(vectors: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """(vec_id, v): distinct rows with an id and a finite vector other than zero."""
    v = F.col(vector_column).cast("array<double>")
    rows = vectors.select(F.col(id_column).cast("long").alias("vec_id"), v.alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & (F.abs(x) < float("inf")))
    rows = rows.filter(F.col("vec_id").isNotNull() & finite)
    return rows.filter(F.exists("v", lambda x: x != 0)).distinct()


class Part:
    """The sorted arrays of some vectors, and the search in them."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, settings: Settings):
        self.settings = settings
        order = np.argsort(ids, kind="stable")
        self.ids, self.vectors = ids[order], vectors[order]
        self.norms = np.sqrt((self.vectors**2).sum(axis=1))
        dims = vectors.shape[1]
        draw = np.random.default_rng(settings.seed)
        # A unit vector's projections have deviation one.
        self.axes = draw.standard_normal((dims, settings.projections))
        values = (self.vectors / self.norms[:, None]) @ self.axes
        self.order = np.argsort(values, axis=0, kind="stable").T.astype(np.int32)
        self.values = np.take_along_axis(values.T, self.order, axis=1)

    def search(
        self, ids: np.ndarray, queries: np.ndarray, k: int
    ) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(place, vec_ids, scores) with the k best that were verified, best first.

        A query's own row, equal in id and vector, is none of them.
        """
        s, n = self.settings, len(self.ids)
        norms = np.sqrt((queries**2).sum(axis=1))
        at = (queries / norms[:, None]) @ self.axes
        need = int(np.ceil(s.share * s.projections))
        widths = [s.first]
        while widths[-1] < 2 * np.abs(self.axes).sum():
            widths.append(widths[-1] * s.growth)
        ends: dict[float, tuple[list, list]] = {}

        def window(width: float) -> tuple[list, list]:
            """Where all queries' windows of a width begin and end in each array."""
            if width not in ends:
                sides = [
                    np.stack([np.searchsorted(v, c) for v, c in zip(self.values, side.T)], 1)
                    for side in (at - width, at + width)
                ]
                ends[width] = (sides[0].tolist(), sides[1].tolist())
            return ends[width]

        for q in range(len(ids)):
            own = int(ids[q])
            counts = np.zeros(n, np.int64)
            lows = highs = None
            seen = np.zeros(n, bool)
            found = np.zeros(0, np.int64)
            scores = np.zeros(0)
            for width in widths:
                low, high = window(width)[0][q], window(width)[1][q]
                if lows is None:
                    pieces = [o[a:b] for o, a, b in zip(self.order, low, high)]
                else:
                    pieces = [o[a:b] for o, a, b in zip(self.order, low, lows)]
                    pieces += [o[a:b] for o, a, b in zip(self.order, highs, high)]
                lows, highs = low, high
                counts += np.bincount(np.concatenate(pieces), minlength=n)
                new = np.flatnonzero((counts >= need) & ~seen)
                if len(new):
                    seen[new] = True
                    same = self.ids[new] == own
                    if same.any():
                        same &= (self.vectors[new] == queries[q]).all(axis=1)
                    new = new[~same]
                    exact = (self.vectors[new] @ queries[q]) / (self.norms[new] * norms[q])
                    found = np.concatenate([found, new])
                    scores = np.concatenate([scores, exact])
                if len(found) >= min(s.spare * k, n):
                    best = np.lexsort((self.ids[found], -scores))[:k]
                    # A neighbour at this distance collides in this window, on the
                    # average, in the share asked for.
                    distance = np.sqrt(max(0.0, 2 - 2 * scores[best[-1]]))
                    if distance * 1.04 <= width:
                        break
                if seen.all():
                    break
            best = np.lexsort((self.ids[found], -scores))[:k]
            yield q, self.ids[found[best]], scores[best]


def nearest(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 5,
    settings: Settings = Settings(),
    id_column: str = "vec_id",
    vector_column: str = "embedding",
) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's ``k`` nearest by cosine.

    ``queries`` has the ids (in a column of the same name) of the rows of ``vectors`` to
    search for, each against every other row with a vector of the same length. Ties go
    to the smaller id. Vectors that are null or zero, or hold null or non-finite numbers,
    take no part, nor do rows without id. Rows equal in id and vector count once; an id
    with several vectors gets the neighbours of each, ranked apart. There is a row for
    each neighbour found: all candidates, if there are fewer than ``k``.

    Equal vectors are candidates ``k`` + 1 times at most, with their smallest ids; no
    other could be returned. Each part's arrays are built once, and the queries of its
    vector length stream past them.
    """
    rows = materialize(taking_part(vectors, id_column, vector_column))
    copies = Window.partitionBy("v").orderBy("vec_id")
    kept = rows.withColumn("n", F.row_number().over(copies)).filter(F.col("n") <= k + 1)
    kept = materialize(kept.select(F.size("v").alias("dims"), "vec_id", "v"))
    parts = F.ceil(F.count(F.lit(1)) / settings.rows_per_part).cast("int").alias("parts")
    sizes = materialize(kept.groupBy("dims").agg(parts))
    part = F.pmod(F.xxhash64("vec_id", "v"), F.col("parts").cast("long")).cast("int")
    dealt = kept.join(sizes, "dims").select(
        "dims",
        part.alias("part"),
        F.lit(False).alias("asks"),
        F.lit(0).cast("long").alias("query"),
        "vec_id",
        "v",
    )
    ids = queries.select(F.col(id_column).cast("long").alias("vec_id")).distinct()
    asked = rows.join(ids, "vec_id", "left_semi").select(F.size("v").alias("dims"), "vec_id", "v")
    asked = materialize(asked.withColumn("query", F.monotonically_increasing_id()))
    sent = asked.join(sizes, "dims").select(
        "dims",
        F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"),
        F.lit(True).alias("asks"),
        "query",
        "vec_id",
        "v",
    )
    # The number is given, as the parts are few bytes, but much work.
    tasks = 2 * (sizes.agg(F.sum("parts")).first()[0] or 1)
    met = dealt.unionByName(sent).repartition(tasks, "dims", "part")
    found = met.sortWithinPartitions("dims", "part", "asks").mapInArrow(
        _searcher(k, settings), "query long, query_id long, vec_id long, score double"
    )
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order))
    return ranked.filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _searcher(k: int, settings: Settings):
    """Searches rows sorted by part: first a part's vectors, then the queries for it."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held, own = None, [], None
        for batch in batches:
            for key, asks, rows in _stretches(batch, settings.queries_per_block):
                ids, vectors = rows.column("vec_id").to_numpy(), _matrix(rows.column("v"))
                if not asks:
                    if key != at:
                        at, held, own = key, [], None
                    held.append((ids, vectors))
                elif key == at:
                    if own is None:
                        own = Part(*[np.concatenate(x) for x in zip(*held)], settings)
                        held = []
                    yield _answers(rows, list(own.search(ids, vectors, k)))

    return search


def _stretches(batch: pa.RecordBatch, most: int):
    """(part, whether they ask, rows): the batch cut where these change, and by number."""
    keys = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("dims", "part", "asks")]
    change = np.zeros(batch.num_rows, bool)
    for values in keys:
        change[1:] |= values[1:] != values[:-1]
    ends = [*np.flatnonzero(change).tolist(), batch.num_rows]
    start = 0
    for end in ends:
        for low in range(start, end, most):
            dims, part, asks = (values[low] for values in keys)
            yield (dims, part), asks, batch.slice(low, min(most, end - low))
        start = end


def _answers(rows: pa.RecordBatch, found: list) -> pa.RecordBatch:
    places = np.repeat([f[0] for f in found], [len(f[1]) for f in found]).astype(np.int64)
    return pa.RecordBatch.from_pydict(
        {
            "query": rows.column("query").to_numpy()[places],
            "query_id": rows.column("vec_id").to_numpy()[places],
            "vec_id": np.concatenate([f[1] for f in found]),
            "score": np.concatenate([f[2] for f in found]),
        }
    )


def _matrix(column: pa.ListArray) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)
