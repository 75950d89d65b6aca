"""SimHash near-duplicates by an inverted index over byte positions.

A 64-bit fingerprint is eight (position, byte) terms. Two fingerprints that differ
in at most four bits share at least four terms, so the index is asked for pairs
whose tally of shared terms reaches four, and these are verified bit by bit.

The posting lists are not those of single terms, each of which would hold a 256th
of all documents: they belong to sets of four terms, and a pair reaches the
tally exactly if it meets in one of these lists. Lists stay short that way at any
size of the table. Lists that are long all the same (dense clusters of near copies) are
handled exactly without pairing: fingerprints at distance d share a point within
d/2 of each, so linking all that reach a point finds every link.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltstone.llm.components import connected_components
from siltstone.llm.tables import (
    empty_text,
    few_parts,
    materialize,
    parts_for,
    row_slices,
    short_batches,
    whole_row,
)

BITS = 64
BYTES = 8
# Fingerprints a task posts; each makes tens of entries.
SPREAD_ROWS = 25_000
# Documents that a task of the kept ones has at least; texts may be long.
KEPT_ROWS = 1_000


# --- fingerprints -----------------------------------------------------------


def shingle_hashes(text: str, shingle: int) -> np.ndarray:
    """XXH64 (seed 42) of each word shingle of the text, in order."""
    import xxhash

    words = text.encode("utf-8", "replace").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    if len(words) <= shingle:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), 42)], np.uint64)
    joined, digest = b" ".join(words), xxhash.xxh64_intdigest
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 1
    ends = np.cumsum(sizes)
    starts = (ends - sizes)[: len(words) - shingle + 1].tolist()
    ends = (ends[shingle - 1 :] - 1).tolist()
    hashes = [digest(joined[a:b], 42) for a, b in zip(starts, ends)]
    return np.array(hashes, np.uint64)


def majority_bits(hashes: np.ndarray) -> int:
    """The number whose bits are set in over half of the hashes; 0 for none."""
    if not len(hashes):
        return 0
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        octets = hashes[at : at + (1 << 16)].astype("<u8").view(np.uint8)
        bits = np.unpackbits(octets.reshape(-1, BYTES), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    kept = np.packbits(2 * ones > len(hashes), bitorder="little")
    return int(kept.view("<u8")[0])


def row_hash(df: DataFrame) -> Column:
    """A number for the row's content, to find the row again in another scan."""
    plain = [f.name for f in df.schema.fields if "map<" not in f.dataType.simpleString()]
    return F.xxhash64(*[F.col(f"`{c}`") for c in plain])


def fingerprints(
    docs: DataFrame,
    shingle: int = 4,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """(doc_id, row_hash, fp) for each row; fp is the fingerprint as a signed long.

    Letters A-Z are lowered and words are what ASCII white space separates. A text
    with fewer words than a shingle is one shingle; a text without words, or a
    null, has fingerprint zero.
    """

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in row_slices(batches):
            found = [
                majority_bits(shingle_hashes(text, shingle))
                for text in batch.column(2).to_pylist()
            ]
            fps = np.array(found, np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(fps)],
                names=["doc_id", "row_hash", "fp"],
            )

    short_batches(docs)
    texts = docs.select(
        F.col(id_column).cast("long"), row_hash(docs), empty_text(text_column)
    )
    return texts.mapInArrow(digest, "doc_id long, row_hash long, fp long")


# --- links ------------------------------------------------------------------


def list_keys(fp: str, max_bits: int) -> list[Column]:
    """A number for each set of terms that a pair may be bound to share.

    ``max_bits`` differing bits spoil at most as many positions; the others are shared.
    """
    shared = BYTES - max_bits
    if not 1 <= shared <= 6:
        raise ValueError("between 2 and 7 differing bits can be indexed by bytes")
    keys = []
    for number, positions in enumerate(combinations(range(BYTES), shared)):
        key = F.lit(number).cast("long")
        for p in positions:
            octet = F.shiftrightunsigned(F.col(fp), 8 * p).bitwiseAND(F.lit(255))
            key = F.shiftleft(key, 8).bitwiseOR(octet)
        keys.append(key)
    return keys


def forest(fps: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """Links enough to join what is joined by links of at most ``max_bits``."""
    if len(fps) == 2:
        near = int(np.bitwise_count(fps[0] ^ fps[1])) <= max_bits
        return [(int(fps[0]), int(fps[1]))] if near else []
    links, unseen = [], fps
    while len(unseen):
        reached, unseen = [unseen[0]], unseen[1:]
        while reached and len(unseen):
            at = reached.pop()
            near = np.bitwise_count(unseen ^ at) <= max_bits
            found, unseen = unseen[near], unseen[~near]
            links += [(int(at), int(x)) for x in found]
            reached.extend(found)
    return links


def scan_lists(max_bits: int, long_list: int):
    """Walk posting lists that arrive sorted by key, then fingerprint.

    Yields links of the lists up to ``long_list`` entries, and the entries of longer
    ones as (fp, null). Memory holds one list of that length at most.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key_open, held, long = None, np.zeros(0, np.uint64), False

        def close(run: np.ndarray) -> list[tuple[int, int]]:
            return forest(run, max_bits) if len(run) > 1 else []

        for batch in batches:
            keys = batch.column(0).to_numpy(zero_copy_only=False)
            fps = batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64)
            if not len(keys):
                continue
            cuts = np.flatnonzero(np.diff(keys)) + 1
            starts = np.concatenate([[0], cuts])
            ends = np.concatenate([cuts, [len(keys)]])
            links: list[tuple[int, int]] = []
            hot: list[np.ndarray] = []
            # Lists of one entry need no look, but the first and last may go on.
            busy = np.flatnonzero(ends - starts > 1).tolist()
            last = len(starts) - 1
            for i in dict.fromkeys([0, *busy, last]):
                run = fps[starts[i] : ends[i]]
                if i == 0 and key_open == keys[0]:
                    run = np.concatenate([held, run])
                elif i == 0:
                    links += [] if long else close(held)
                    long = False
                if i > 0 and last > 0 and i == last:
                    long = False
                if long or len(run) > long_list:
                    hot.append(run)
                    run, long = run[:0], True
                if i == last:
                    key_open, held = keys[-1], run
                elif long:
                    long = False
                else:
                    links += close(run)
            yield as_batch(links, hot)
        yield as_batch([] if long else close(held), [])

    def as_batch(links, hot) -> pa.RecordBatch:
        pairs = np.array(links, np.uint64).reshape(-1, 2).view(np.int64)
        entries = np.concatenate([*hot, np.zeros(0, np.uint64)]).view(np.int64)
        a = np.concatenate([pairs[:, 0], entries])
        b = np.concatenate([pairs[:, 1], np.zeros(len(entries), np.int64)])
        null = np.arange(len(a)) >= len(pairs)
        return pa.RecordBatch.from_arrays(
            [pa.array(a), pa.array(b, mask=null)], names=["a", "b"]
        )

    return scan


def points_within(radius: int):
    """Each fingerprint with every point at most ``radius`` bits away."""
    flips = [0]
    for n in range(1, radius + 1):
        flips += [sum(1 << i for i in c) for c in combinations(range(BITS), n)]

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        masks = np.array(flips, np.uint64)
        for batch in row_slices(batches, 64):
            fps = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            points = (fps[:, None] ^ masks[None, :]).ravel().view(np.int64)
            owner = np.repeat(fps, len(masks)).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(points), pa.array(owner)], names=["point", "a"]
            )

    return expand


def _links_in_long_lists(fps: DataFrame, max_bits: int) -> DataFrame:
    """All links between fingerprints of long lists, as stars around points.

    For odd distances the second point may be one bit further off; what a star then
    joins is verified against its centre's other points by exact distance.
    """
    if max_bits % 2:
        raise ValueError("long lists need an even number of differing bits")
    near = fps.mapInArrow(points_within(max_bits // 2), "point long, a long")
    centre = near.groupBy("point").agg(F.min("a").alias("b"), F.count("a").alias("n"))
    centre = centre.filter("n > 1").drop("n")
    return near.join(centre, "point").filter("a <> b").select("a", "b").distinct()


def links(fps: DataFrame, max_bits: int = 4, long_list: int = 1024) -> DataFrame:
    """(a, b): links that join all fingerprints within ``max_bits`` of each other.

    ``fps`` holds distinct values in a column ``fp``. Within a list only as many links
    are given as it takes to join what is joined; none is between others.
    """
    # A few numbers become many entries here: first spread over enough tasks.
    n_fps, keys = fps.count(), list_keys("fp", max_bits)
    spread = fps.repartition(parts_for(n_fps, SPREAD_ROWS), "fp")
    posted = spread.select(F.explode(F.array(*keys)).alias("key"), "fp")
    found = (
        posted.repartition("key")
        .sortWithinPartitions("key", "fp")
        .mapInArrow(scan_lists(max_bits, long_list), "a long, b long")
    )
    found = materialize(few_parts(found, n_fps * len(keys)))
    short = few_parts(found.filter("b is not null").distinct(), found.count())
    entries = found.filter("b is null").select("a").distinct()
    if entries.isEmpty():
        return short
    return short.unionByName(_links_in_long_lists(entries, max_bits))


# --- the operator -----------------------------------------------------------


def near_duplicates(
    docs: DataFrame,
    shingle: int = 4,
    max_bits: int = 4,
    long_list: int = 1024,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """(doc_id, row_hash, fp, fingerprint, component, component_id) for each row.

    ``component_id`` is the smallest doc_id that links reach; rows with a null id take
    part, but never give the id. Rows with equal ids are separate texts. Equal
    fingerprints are one node, so copies cost no links; ``component`` is the component's
    smallest fingerprint as a signed number.
    """
    prints = materialize(fingerprints(docs, shingle, id_column, text_column))
    n_rows = prints.count()
    classes = prints.groupBy("fp").agg(F.min("doc_id").alias("first_id"))
    classes = materialize(few_parts(classes, n_rows))
    found = links(classes.select("fp"), max_bits, long_list)
    labels = connected_components(found)
    linked = classes.join(labels.withColumnRenamed("node", "fp"), "fp")
    smallest = linked.groupBy("label").agg(F.min("first_id").alias("linked_id"))
    linked = linked.join(smallest, "label").select("fp", "label", "linked_id")
    classes = classes.join(linked, "fp", "left").select(
        "fp",
        F.coalesce("label", "fp").alias("component"),
        F.when(F.col("label").isNull(), F.col("first_id"))
        .otherwise(F.col("linked_id"))
        .alias("component_id"),
    )
    rows = prints.join(classes, "fp").select(
        "doc_id",
        "row_hash",
        "fp",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component",
        "component_id",
    )
    return few_parts(rows, n_rows)


def keep_one(
    docs: DataFrame,
    shingle: int = 4,
    max_bits: int = 4,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One row of ``docs`` for each group of near-duplicates, as it is.

    It is the one with the smallest id; rows without id come last. Of rows with equal
    ids, and of repeated rows, one stays.
    """
    rows = materialize(near_duplicates(docs, shingle, max_bits, id_column=id_column, text_column=text_column))
    first = F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "row_hash")
    chosen = rows.groupBy("component").agg(F.min(first).alias("c")).select("c.doc_id", "c.row_hash")
    # The same row may be there several times; in few tables it is.
    times = rows.groupBy("doc_id", "row_hash").agg(F.count(F.lit(1)).alias("times"))
    both = chosen["doc_id"].eqNullSafe(times["doc_id"]) & (
        chosen["row_hash"] == times["row_hash"]
    )
    chosen = chosen.join(times, both).select(chosen["doc_id"], chosen["row_hash"], "times")
    n_rows = rows.count()
    chosen = materialize(few_parts(chosen, n_rows))
    data = docs.select(whole_row(docs).alias("row"), F.col(id_column).cast("long").alias("i"), row_hash(docs).alias("h"))

    def found(keys: DataFrame) -> DataFrame:
        same = data["i"].eqNullSafe(keys["doc_id"]) & (data["h"] == keys["row_hash"])
        return data.join(keys, same, "left_semi")

    kept = found(chosen.filter("times = 1"))
    again = chosen.filter("times > 1")
    if not again.isEmpty():
        order = Window.partitionBy("i", "h").orderBy(F.lit(0))
        numbered = found(again).withColumn("n", F.row_number().over(order))
        kept = kept.unionByName(numbered.filter("n = 1").drop("n"))
    kept = kept.select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns])
    return few_parts(kept, n_rows, KEPT_ROWS)
