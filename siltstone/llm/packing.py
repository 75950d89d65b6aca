"""Best-fit packing of documents into token sequences, certified by lower bounds.

Pieces are dealt over partitions and packed by best-fit decreasing. Bounds from
dual-feasible functions certify each partition's number of bins. Partitions with a
gap give the documents of their unfilled bins to a pool, which is dealt anew and
packed again, as long as that saves bins.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm.tables import (
    empty_text,
    materialize,
    parts_for,
    row_slices,
    short_batches,
)

PIECE_COLUMNS = (
    "uid long, doc_id long, piece int, start long, length long, ids_crc32 long"
)
PLACED_COLUMNS = (
    f"{PIECE_COLUMNS}, sequence_id long, offset long, round int, part long, "
    "part_bins long, part_bound long, filled boolean"
)
_PIECES = [c.split()[0] for c in PIECE_COLUMNS.split(", ")]

# The fast encoder backtracks over white space and fails at some 500,000 characters.
LONGEST_BLANK = 50_000


# --- tokens -----------------------------------------------------------------


def public_encoder(
    name: str = "byte_bpe_50k", special: str = "<|endoftext|>"
) -> Callable[[], Callable[[str], list[int]]]:
    """A function that opens a byte-level BPE in a task and returns its encoder.

    The ids are those of the ``tokenizers`` file of that name, without added special
    tokens. They are taken from the same vocabulary by ``tiktoken``, which is four
    times as fast (11.8 against 2.8 MB/s per core); a test compares both. Texts that
    it refuses, texts with the special token's string, and texts with a run of over
    ``LONGEST_BLANK`` blanks, on which it breaks down, go through ``tokenizers``.
    """

    longest_blank = LONGEST_BLANK

    def open_encoder() -> Callable[[str], list[int]]:
        import base64
        import re

        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        with open(public_tokenizers.path(f"{name}.tiktoken"), "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        fast = tiktoken.Encoding(
            name,
            pat_str=public_tokenizers.PATTERN,
            mergeable_ranks=ranks,
            special_tokens={},
        )
        slow: list[Tokenizer] = []
        blanks = re.compile(r"\s+")

        def has_long_blank(text: str) -> bool:
            if len(text) <= longest_blank:
                return False
            return any(m.end() - m.start() > longest_blank for m in blanks.finditer(text))

        def encode(text: str) -> list[int]:
            if special not in text and not has_long_blank(text):
                try:
                    return fast.encode_ordinary(text)
                except ValueError:
                    pass
            if not slow:
                slow.append(Tokenizer.from_file(public_tokenizers.path(f"{name}.json")))
            return slow[0].encode(text, add_special_tokens=False).ids

        return encode

    return open_encoder


def piece_bounds(length: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document; only the first may be shorter."""
    first = length % capacity or min(length, capacity)
    starts = [0, *range(first, length, capacity)]
    return [(s, (first if s == 0 else capacity)) for s in starts]


def pieces(
    docs: DataFrame,
    capacity: int = 2048,
    end_id: int = 0,
    encoder: Callable[[], Callable[[str], list[int]]] | None = None,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """The documents' token ids, cut into pieces of at most ``capacity``.

    A null text is empty and has the end id alone. A null id stays null, and rows
    with the same id are separate documents. Other columns are not looked at.
    """
    short_batches(docs)
    open_encoder = encoder or public_encoder()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = open_encoder()
        uid = TaskContext.get().partitionId() << 40
        for batch in row_slices(batches):
            rows = []
            for doc_id, text in zip(*(c.to_pylist() for c in batch.columns)):
                ids = np.array([*encode(text), end_id], dtype="<u4")
                for n, (start, length) in enumerate(piece_bounds(len(ids), capacity)):
                    crc = zlib.crc32(ids[start : start + length].tobytes())
                    rows.append((uid, doc_id, n, start, length, crc))
                    uid += 1
            kinds = [pa.int64(), pa.int64(), pa.int32(), *[pa.int64()] * 3]
            arrays = [pa.array(c, k) for c, k in zip(zip(*rows), kinds)]
            yield pa.RecordBatch.from_arrays(arrays, names=_PIECES)

    texts = docs.select(F.col(id_column).cast("long"), empty_text(text_column))
    return texts.mapInArrow(cut, PIECE_COLUMNS)


# --- one partition ----------------------------------------------------------


def lower_bound(lengths: np.ndarray, capacity: int) -> int:
    """Bins that any packing needs, by two families of dual-feasible functions.

    The first drops pieces below a threshold and rounds those above its complement
    up to a whole bin; the second rounds to multiples of a k-th of a bin.
    """
    if not len(lengths):
        return 0
    count = np.bincount(lengths, minlength=capacity + 1).astype(np.int64)
    size = np.arange(capacity + 1)
    above = np.concatenate([np.cumsum(count[::-1])[::-1], [0]])
    total = np.concatenate([[0], np.cumsum(count * size)])
    cut = np.arange(0, capacity // 2 + 1)
    whole = above[capacity - cut + 1] * capacity
    kept = total[capacity - cut + 1] - total[cut]
    best = int(-(-(whole + kept).max() // capacity))
    for k in range(1, 33):
        scaled = size * (k + 1)
        exact = scaled % capacity == 0
        # In units of a k-th of the capacity, times capacity.
        value = np.where(exact, size * k, scaled // capacity * capacity)
        best = max(best, int(-(-int((value * count).sum()) // (k * capacity))))
    return best


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[list[int], int]:
    """The bin of each of the lengths, which come in decreasing order.

    Bins are kept by the room they have left; a bit set of the rooms in use finds
    the smallest that suffices.
    """
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms, bins, placed = 0, 0, []
    for length in lengths.tolist():
        fitting = rooms >> length
        if fitting:
            room = length + (fitting & -fitting).bit_length() - 1
            at = by_room[room].pop()
            if not by_room[room]:
                rooms ^= 1 << room
        else:
            room, at, bins = capacity, bins, bins + 1
        left = room - length
        if left:
            by_room[left].append(at)
            rooms |= 1 << left
        placed.append(at)
    return placed, bins


def pack_partition(capacity: int, turn: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    def pack(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["length", "uid"], ascending=[False, True])
        lengths = rows["length"].to_numpy(np.int64)
        placed, bins = best_fit_decreasing(lengths, capacity)
        rows = rows.assign(bin=placed, round=turn, part_bins=bins)
        in_bin = rows.groupby("bin")
        rows["sequence_id"] = in_bin["uid"].transform("first")
        rows["offset"] = in_bin["length"].cumsum() - rows["length"]
        rows["filled"] = in_bin["length"].transform("sum") == capacity
        rows["part_bound"] = lower_bound(lengths, capacity)
        return rows[[c.split()[0] for c in PLACED_COLUMNS.split(", ")]]

    return pack


# --- all partitions ---------------------------------------------------------


def _deal(pool: DataFrame, rows: int, each: int, capacity: int, turn: int) -> DataFrame:
    parts = parts_for(rows, each)
    dealt = pool.withColumn(
        "part", F.pmod(F.xxhash64(F.lit(turn), "uid"), F.lit(parts).cast("long"))
    )
    return dealt.groupBy("part").applyInPandas(
        pack_partition(capacity, turn), PLACED_COLUMNS
    )


def pack(
    docs: DataFrame,
    capacity: int = 2048,
    end_id: int = 0,
    encoder: Callable[[], Callable[[str], list[int]]] | None = None,
    pieces_per_part: int = 8192,
    rounds: int = 4,
) -> DataFrame:
    """Every piece of every document with its place in a sequence.

    Columns: ``PLACED_COLUMNS``. ``part_bins`` and ``part_bound`` certify the packing
    of the partition that placed the piece: no packing of that partition's pieces
    needs fewer than ``part_bound`` bins. Pieces that fill a sequence have part -1.

    A partition holds about ``pieces_per_part`` rows of a few numbers, doubled in each
    round, whatever the table's size or the repetition of ids. Ties in length go by the order of the
    token table. An empty table gives an empty result.
    """
    table = materialize(pieces(docs, capacity, end_id, encoder))
    alone = table.filter(F.col("length") == capacity).select(
        *_PIECES,
        F.col("uid").alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"),
        F.lit(0).alias("round"),
        F.lit(-1).cast("long").alias("part"),
        F.lit(1).cast("long").alias("part_bins"),
        F.lit(1).cast("long").alias("part_bound"),
        F.lit(True).alias("filled"),
    )
    settled, pool = [alone], table.filter(F.col("length") < capacity)
    placed = materialize(_deal(pool, pool.count(), pieces_per_part, capacity, 0))
    for turn in range(1, rounds):
        gap = (F.col("part_bins") > F.col("part_bound")) & ~F.col("filled")
        loose = placed.filter(gap)
        rows, bins = loose.agg(
            F.count(F.lit(1)), F.count_if(F.col("offset") == 0)
        ).first()
        if not rows:
            break
        loose = loose.select(*_PIECES)
        # Twice the rows a partition, so that more documents can find each other.
        each = pieces_per_part << turn
        trial = materialize(_deal(loose, rows, each, capacity, turn))
        if trial.filter("offset = 0").count() >= bins:
            break
        settled.append(placed.filter(~gap))
        placed = trial
    for part in settled:
        placed = placed.unionByName(part)
    return placed


def packed_summary(placed: DataFrame, capacity: int = 2048) -> dict[str, float]:
    """Sequences, tokens, the bound of all tokens together, and the share filled."""
    row = placed.agg(
        F.count_if(F.col("offset") == 0).alias("bins"),
        F.coalesce(F.sum("length"), F.lit(0)).alias("tokens"),
    ).first()
    bound = math.ceil(row["tokens"] / capacity)
    fill = row["tokens"] / (row["bins"] * capacity) if row["bins"] else 1.0
    return {"bins": row["bins"], "tokens": row["tokens"], "bound": bound, "fill": fill}
