"""Packing of documents into sequences by a plan of length combinations.

Shallow combinations of piece lengths that fill a sequence exactly are enumerated, and
non-negative least squares finds how often to repeat each so that the lengths' histogram is
met. The counts are rounded, and what they leave over is strung together and cut where a
sequence is full. A piece's place follows from its length and its number among the pieces
of that length alone, so pieces are never sorted, grouped or shuffled to be packed.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator, Mapping
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from siltstone.llm.packing import public_encoder
from siltstone.llm.tables import empty_text, materialize, row_slices, short_batches

NUMBERED = (
    "part int, nth long, doc_id long, start long, length long, doc_tokens long, "
    "ids_crc32 long, ids binary"
)
PLACED = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
    "sequence_id long, offset long, planned boolean"
)

# The table of first numbers is broadcast up to this many rows of three integers, and
# joined by a shuffle beyond.
BROADCAST_ROWS = 500_000


def _names(columns: str) -> list[str]:
    return [c.split()[0] for c in columns.split(", ")]


# --- the plan ---------------------------------------------------------------


def combinations(lengths: np.ndarray, capacity: int) -> np.ndarray:
    """All triples a >= b >= c of the lengths that add up to the capacity.

    A zero stands for no piece: (a, b, 0) are pairs, and (capacity, 0, 0) is the full
    piece alone.
    """
    present = np.zeros(capacity + 1, bool)
    present[lengths] = True
    present[0] = True
    found = []
    for c in np.flatnonzero(present[: capacity // 3 + 1]):
        b = np.arange(c, (capacity - c) // 2 + 1)
        a = capacity - c - b
        # Nothing but a full piece goes with two places left empty.
        fits = present[a] & present[b] & ((b > 0) | (a == capacity))
        found.append(np.stack([a[fits], b[fits], np.full(fits.sum(), c)], axis=1))
    return np.concatenate(found)


def least_squares(combos: np.ndarray, wanted: np.ndarray, rounds: int = 300) -> np.ndarray:
    """Repeat counts >= 0 whose use of each length is nearest to ``wanted``.

    ``wanted`` holds the number of pieces by length. Projected gradient with Nesterov's
    momentum, started again where the momentum points uphill.
    """
    size = len(wanted)
    scale = float(wanted.max()) or 1.0
    target = wanted / scale

    def used(x: np.ndarray) -> np.ndarray:
        by_place = [np.bincount(place, x, minlength=size) for place in combos.T]
        total = np.sum(by_place, axis=0)
        total[0] = 0  # an empty place is no piece
        return total

    def gathered(y: np.ndarray) -> np.ndarray:
        return sum(y[place] for place in combos.T)

    probe = np.ones(len(combos))
    for _ in range(30):  # the largest eigenvalue sets the step
        probe = gathered(used(probe))
        norm = float(np.linalg.norm(probe)) or 1.0
        probe /= norm
    step = 1.0 / (1.02 * norm)
    x = y = np.zeros(len(combos))
    pace = 1.0
    for _ in range(rounds):
        gradient = gathered(used(y) - target)
        moved = np.maximum(0.0, y - step * gradient)
        if float(gradient @ (moved - x)) > 0:
            pace = 1.0
        following = (1 + np.sqrt(1 + 4 * pace * pace)) / 2
        y = moved + (pace - 1) / following * (moved - x)
        x, pace = moved, following
    return x * scale


class Plan(NamedTuple):
    """Where the n-th piece of a length goes.

    Slots are numbered ranges of pieces, by length and first number: piece r of the slot
    goes to sequence ``sequence`` + r - ``first``, at ``offset``. From ``spare[length]``
    on, pieces of a length are strung together, by length and number; the string of a
    length starts at ``string[length]``. The string is cut at multiples of the capacity,
    and what remains behind ``tail[0]`` at the other places in ``tail``.
    """

    capacity: int
    length: np.ndarray
    first: np.ndarray
    sequence: np.ndarray
    offset: np.ndarray
    spare: np.ndarray
    string: np.ndarray
    tail: np.ndarray
    string_sequence: int


def solve(histogram: Mapping[int, int], capacity: int, passes: int = 3) -> Plan:
    """The plan for so many pieces of each length.

    Rounded counts never use more pieces of a length than there are. What they leave is
    solved again while a pass takes in pieces, ``passes`` times at most; the string takes
    the rest, so that every piece has a place whatever the solution's quality.
    """
    left = np.zeros(capacity + 1, np.int64)
    for length, count in histogram.items():
        left[length] = count
    total, slots, sequences = left.copy(), [], 0
    for _ in range(passes):
        combos = combinations(np.flatnonzero(left), capacity)
        if not len(combos):
            break
        before = sequences
        counts = least_squares(combos, left)
        for at in np.argsort(-counts, kind="stable"):
            if counts[at] < 0.5:
                break
            lengths, each = np.unique(combos[at][combos[at] > 0], return_counts=True)
            n = min(round(counts[at]), int((left[lengths] // each).min()))
            if n == 0:
                continue
            offset = 0
            for piece in combos[at][combos[at] > 0]:
                slots.append((piece, total[piece] - left[piece], sequences, offset))
                left[piece] -= n
                offset += int(piece)
            sequences += n
        if sequences == before:
            break
    string = np.concatenate([[0], np.cumsum(left * np.arange(capacity + 1))])
    # The last, unfilled sequence is split into powers of two, which need no padding.
    end, rest = divmod(int(string[-1]), capacity)
    tail = [end * capacity]
    for bit in reversed(range(rest.bit_length())):
        if rest >> bit & 1:
            tail.append(tail[-1] + (1 << bit))
    columns = np.array(sorted(slots), np.int64).reshape(-1, 4).T
    return Plan(
        capacity, *columns, total - left, string[:-1], np.array(tail, np.int64), sequences
    )


def string_cuts(plan: Plan, at: int, length: int) -> list[tuple[int, int, int, int]]:
    """(start, length, sequence, offset) of the parts of a piece put at a place of the string."""
    capacity, tail = plan.capacity, plan.tail
    parts, start = [], at
    while start < at + length:
        if start < tail[0]:
            begin = start // capacity * capacity
            number, end = start // capacity, begin + capacity
        else:
            n = int(np.searchsorted(tail, start, side="right")) - 1
            begin, end = int(tail[n]), int(tail[n + 1])
            number = int(tail[0]) // capacity + n
        end = min(end, at + length)
        parts.append((start - at, end - start, plan.string_sequence + number, start - begin))
        start = end
    return parts


# --- pieces -----------------------------------------------------------------


def numbered_pieces(
    docs: DataFrame,
    capacity: int,
    end_id: int,
    encoder: Callable[[], Callable[[str], list[int]]] | None,
    id_column: str,
    text_column: str,
) -> DataFrame:
    """Token ids cut after every ``capacity``, each piece numbered in its task by length.

    Full pieces are done and come without their ids.
    """
    open_encoder = encoder or public_encoder()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = open_encoder()
        part, numbers = TaskContext.get().partitionId(), [0] * (capacity + 1)
        kinds = [pa.int32(), *[pa.int64()] * 6, pa.binary()]
        for batch in row_slices(batches):
            rows = []
            for doc_id, text in zip(*(c.to_pylist() for c in batch.columns)):
                ids = np.array([*encode(text), end_id], dtype="<u4")
                for start in range(0, len(ids), capacity):
                    raw = ids[start : start + capacity].tobytes()
                    n = len(raw) // 4
                    kept = raw if n < capacity else None
                    rows.append(
                        (part, numbers[n], doc_id, start, n, len(ids), zlib.crc32(raw), kept)
                    )
                    numbers[n] += 1
            arrays = [pa.array(c, k) for c, k in zip(zip(*rows), kinds)]
            yield pa.RecordBatch.from_arrays(arrays, names=_names(NUMBERED))

    texts = docs.select(F.col(id_column).cast("long"), empty_text(text_column))
    return texts.mapInArrow(cut, NUMBERED)


def placer(shared) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The function that gives pieces, numbered over all tasks, their places."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan = Plan(*shared.value)
        # Lengths stay below 2^20, numbers below 2^43.
        slots = (plan.length << 43) + plan.first
        for batch in row_slices(batches):
            column = {n: batch.column(n) for n in batch.schema.names}
            number = column["number"].to_numpy()
            length = column["length"].to_numpy()
            planned = number < plan.spare[length]
            slot = np.searchsorted(slots, (length << 43) + number, side="right") - 1
            at = slot[planned]
            sequence = plan.sequence[at] + number[planned] - plan.first[at]
            mask = pa.array(planned)
            same = ("doc_id", "start", "length", "ids_crc32", "doc_tokens")
            arrays = [
                *[column[n].filter(mask) for n in same],
                pa.array(sequence),
                pa.array(plan.offset[at]),
                pa.array(np.ones(len(at), bool)),
            ]
            yield pa.RecordBatch.from_arrays(arrays, names=_names(PLACED))
            rows = []
            for row in batch.filter(pa.array(~planned)).to_pylist():
                n, doc = row["length"], (row["doc_id"], row["doc_tokens"])
                at = int(plan.string[n] + (row["number"] - plan.spare[n]) * n)
                for skip, size, into, offset in string_cuts(plan, at, n):
                    crc = zlib.crc32(row["ids"][4 * skip : 4 * (skip + size)])
                    start = row["start"] + skip
                    rows.append((doc[0], start, size, crc, doc[1], into, offset, False))
            if rows:
                kinds = [*[pa.int64()] * 7, pa.bool_()]
                arrays = [pa.array(c, k) for c, k in zip(zip(*rows), kinds)]
                yield pa.RecordBatch.from_arrays(arrays, names=_names(PLACED))

    return place


def pack_by_counts(
    docs: DataFrame,
    capacity: int = 1024,
    end_id: int = 0,
    encoder: Callable[[], Callable[[str], list[int]]] | None = None,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Every token of every document with its place in a sequence: ``PLACED``.

    Sequences have ``capacity`` tokens, except for the last ones of the string, whose
    lengths are powers of two: with sequences padded to the capacity or a power of two
    nothing is padded. Documents longer than the capacity are cut after every full
    sequence, others only where they are ``planned`` false and meet a sequence's end.
    Sequences are numbered without gaps.

    A null text is empty and has the end id alone. A null id stays null; rows with equal
    ids are separate documents, and repeated rows are packed each. An empty table gives
    an empty result. Other columns are not looked at. To the driver comes the histogram of
    lengths, ``capacity`` rows at most; the solution's work depends on the capacity only.
    """
    if not 2 <= capacity < 1 << 20:
        raise ValueError("the capacity must be at least 2 and below 2^20")
    short_batches(docs)
    table = materialize(
        numbered_pieces(docs, capacity, end_id, encoder, id_column, text_column)
    )
    held = materialize(table.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n")))
    sizes = held.groupBy("length").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("parts"))
    rows = sizes.collect()
    plan = solve({r["length"]: r["n"] for r in rows}, capacity)
    # One row per task and length; the window holds one length's tasks.
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(
        Window.unboundedPreceding, -1
    )
    before = held.select(
        "part", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before")
    )
    if sum(r["parts"] for r in rows) <= BROADCAST_ROWS:
        before = F.broadcast(before)
    numbered = table.join(before, ["part", "length"]).select(
        (F.col("nth") + F.col("before")).alias("number"),
        *["doc_id", "start", "length", "doc_tokens", "ids_crc32"],
        # Planned pieces are not cut, so their ids need not be read again by Python.
        F.when(
            F.col("nth") + F.col("before")
            >= F.get(F.lit(plan.spare.tolist()), F.col("length").cast("int")),
            F.col("ids"),
        ).alias("ids"),
    )
    shared = docs.sparkSession.sparkContext.broadcast(tuple(plan))
    return numbered.mapInArrow(placer(shared), PLACED)

