"""Katz backoff language model over words, trained and evaluated in one corpus.

Good-Turing discounts lower the counts of n-grams seen; what that frees goes to words not
seen after a history, in proportion to their probability after the shorter history, with
weights that make every distribution sum to one exactly.

A token needs counts from all over the corpus, but there are far too many n-grams to
broadcast, and too many tokens to join one by one. So texts are kept in chunks, each with
its distinct n-grams, and n-grams are partitioned into buckets by key. A chunk asks
each bucket for all its n-grams at once: a sorted array of keys goes there, and an array
of values, in the same order, comes back. Chunks and answers are tables bucketed by chunk,
so that they meet again without moving.

Most long n-grams occur once, and nobody asks for them. An n-gram is no more frequent than
its first or its last n - 1 words; where one of these was seen once, the n-gram's count is
one and known to its chunk, unless both are also in a held-out text, whose chunk must learn
of it. A seen n-gram is divided by its history's count, a count of the order below, which
the chunk has; a bucket is asked for a history's weight only where a held-out text follows it
by a word not seen there. All this leaves out what is known, so no result depends on it.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm.tables import (
    empty_text,
    materialize,
    parts_for,
    row_slices,
    short_batches,
    shuffles_freed,
)
from siltstone.sources.paths import delete_folder
from siltstone.sources.scratch import scratch_dir

#: Counts above this are not discounted.
RELIABLE = 5
CHUNK_TOKENS = 1_500_000
BUCKET_ENTRIES = 2_000_000
# Buckets of the table of chunks; with more chunks, a task takes several, one by one.
MAX_FILES = 20_000

START, END = np.uint64(0x53D4A1), np.uint64(0xE4D)
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


# --- arrays in cells ---------------------------------------------------------


def packed(values: np.ndarray) -> bytes:
    """The array's bytes, compressed with equal places of the numbers side by side."""
    planes = values.view(np.uint8).reshape(len(values), values.itemsize).T
    return pa.compress(np.ascontiguousarray(planes).tobytes(), "zstd", asbytes=True)


def unpacked(cell: bytes, size: int, kind) -> np.ndarray:
    width = np.dtype(kind).itemsize
    raw = pa.decompress(cell, size * width, "zstd", asbytes=True)
    planes = np.frombuffer(raw, np.uint8).reshape(width, size)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


def packed_keys(keys: np.ndarray) -> bytes:
    """Of sorted keys, as their differences are smaller."""
    return packed(np.diff(keys, prepend=np.uint64(0)))


def unpacked_keys(cell: bytes, size: int) -> np.ndarray:
    return np.cumsum(unpacked(cell, size, np.uint64), dtype=np.uint64)


# --- chunks ------------------------------------------------------------------

CHUNK_COLUMNS = (
    "chunk long, doc_ids array<bigint>, held array<boolean>, sizes array<int>, "
    "n_words int, n_tokens int, words binary, tokens binary"
)


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts, one after another, and how many each text has."""
    split = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    words = split.flatten()
    # Space at a text's ends leaves empty pieces there.
    some = pc.greater(pc.binary_length(words), 0)
    before = np.concatenate([[0], np.cumsum(some.to_numpy(zero_copy_only=False))])
    ends = np.concatenate([[0], np.cumsum(pc.list_value_length(split).to_numpy())])
    return words.filter(some), np.diff(before[ends])


def tokenized(docs: DataFrame, chunk_tokens: int) -> DataFrame:
    """(``CHUNK_COLUMNS``): consecutive documents, with their tokens as numbers of words.

    ``docs``: doc_id, held, text. ``words`` has the hashes of a chunk's distinct words;
    the hash of 64 bits is a word's identity.
    """

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        chunk = TaskContext.get().partitionId() << 32
        names = [c.split()[0] for c in CHUNK_COLUMNS.split(", ")]
        ids, held, sizes, pieces, count = [], [], [], [], 0

        def row() -> pa.RecordBatch:
            numbered = pa.chunked_array(pieces).dictionary_encode().chunks
            # Each has the words of all; without words there is none.
            words = [w for n in numbered[-1:] for w in n.dictionary.cast(pa.large_binary()).to_pylist()]
            words = [xxhash.xxh64_intdigest(w, 1) for w in words]
            tokens = np.zeros(count, np.int32)
            tokens[np.cumsum(sizes) - 1] = -1
            tokens[tokens == 0] = np.concatenate([np.zeros(0, np.int32), *(n.indices.to_numpy() for n in numbered)])
            cells = [
                pa.array([chunk]),
                pa.array([ids], pa.list_(pa.int64())),
                pa.array([held], pa.list_(pa.bool_())),
                pa.array([sizes], pa.list_(pa.int32())),
                pa.array([len(words)], pa.int32()),
                pa.array([len(tokens)], pa.int32()),
                pa.array([packed(np.array(words, np.uint64))]),
                pa.array([packed(tokens)]),
            ]
            return pa.RecordBatch.from_arrays(cells, names=names)

        for batch in row_slices(batches):
            words, n_words = split_words(batch.column(2))
            while batch.num_rows:
                ends = np.cumsum(n_words + 1)
                n = min(int(np.searchsorted(ends, chunk_tokens - count)) + 1, len(ends))
                taken = int(ends[n - 1])
                pieces.append(words.slice(0, taken - n))
                ids += batch.column(0)[:n].to_pylist()
                held += batch.column(1)[:n].to_pylist()
                sizes += (n_words[:n] + 1).tolist()
                count += taken
                batch, words, n_words = batch.slice(n), words.slice(taken - n), n_words[n:]
                if count >= chunk_tokens:
                    yield row()
                    ids, held, sizes, pieces, count = [], [], [], [], 0
                    chunk += 1
        if ids:
            yield row()

    return docs.mapInArrow(build, CHUNK_COLUMNS)


class Chunk:
    """A chunk's tokens and the keys of the n-grams that end at them, up to order ``top``.

    ``grams[k]`` are the distinct keys of order k, sorted, and ``at[k]`` each token's
    place among them. Of each such n-gram ``past[k]`` and ``last[k]`` are the places of its
    first and last k - 1 words among ``grams[k - 1]``. The places before a text's first
    word are filled with marks: that history is ``starts[k]``, one place beyond the others.
    """

    def __init__(self, row: dict, top: int):
        hashes = unpacked(row["words"], row["n_words"], np.uint64)
        tokens = unpacked(row["tokens"], row["n_tokens"], np.int32)
        self.sizes = np.array(row["sizes"], np.int64)
        self.held = np.array(row["held"], bool)
        self.ids = row["doc_ids"]
        self._held_at = np.flatnonzero(np.repeat(self.held, self.sizes))
        first = np.cumsum(self.sizes) - self.sizes
        words = np.append(hashes, END)
        own, rank, _ = grouped(_joined(np.zeros(len(words), np.uint64), words))
        self.grams, self.at, self.end = {1: own}, {1: rank[tokens]}, rank[-1]
        self.past, self.last, self.starts = {}, {}, {}
        self._own: dict[int, tuple] = {}
        word, key, start = words[tokens], own[self.at[1]], np.zeros(1, np.uint64)
        for k in range(2, top + 1):
            start = _joined(start, np.array([START]))
            past, past_at = np.roll(key, 1), np.roll(self.at[k - 1], 1)
            past[first], past_at[first] = start, len(self.grams[k - 1])
            key = _joined(past, word)
            self.grams[k], self.at[k], some = grouped(key)
            self.past[k] = past_at[some].astype(np.int64)
            self.last[k] = self.at[k - 1][some].astype(np.int64)
            self.starts[k] = start

    def own_counts(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """How often the chunk's training texts have its n-grams; if held-out ones do."""
        if k not in self._own:
            n = len(self.grams[k])
            held = np.bincount(self.at[k][self._held_at], minlength=n)
            self._own[k] = np.bincount(self.at[k], minlength=n) - held, held > 0
        return self._own[k]


def grouped(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distinct keys, sorted; the place of each key among them; where each is first).

    Sorts numbers made of a key's upper bits and its place, which is several times faster
    than to sort places by key. Keys that differ in lower bits only are rare in hashes; they
    are put in order after that.
    """
    n = len(keys)
    low = np.uint64(n.bit_length())
    order = np.sort(keys >> low << low | np.arange(n, dtype=np.uint64))
    order = (order & np.uint64((1 << n.bit_length()) - 1)).view(np.int64)
    ranked = keys[order]
    if (ranked[1:] < ranked[:-1]).any():
        again = np.argsort(ranked, kind="stable")
        order, ranked = order[again], ranked[again]
    new = np.ones(n, bool)
    np.not_equal(ranked[1:], ranked[:-1], out=new[1:])
    place = np.empty(n, np.int32)
    place[order] = np.cumsum(new, dtype=np.int32) - 1
    return ranked[new], place, order[new]


def _joined(past: np.ndarray, word: np.ndarray) -> np.ndarray:
    """A key for the words of ``past`` and one more."""
    key = past * _A + word * _B + _A
    key ^= key >> np.uint64(32)
    key *= _A
    return key ^ (key >> np.uint64(29))


# --- questions and answers ---------------------------------------------------

ASK_COLUMNS = "chunk long, kind string, bucket int, size int, keys binary, values binary"
ANSWER_COLUMNS = "chunk long, kind string, bucket int, size int, values binary"


def cuts(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Where each bucket's keys begin among sorted keys, and where the last ends."""
    edges = np.array([(b << 64) // buckets for b in range(buckets)], np.uint64)
    return np.append(np.searchsorted(keys, edges), len(keys))


def questions(
    chunk: int, kind: str, keys: np.ndarray, values: np.ndarray, buckets: int
) -> Iterator[tuple]:
    """Rows of ``ASK_COLUMNS``; ``values`` has a column for each key."""
    edges = cuts(keys, buckets)
    for b in np.flatnonzero(np.diff(edges)).tolist():
        part = slice(edges[b], edges[b + 1])
        block = np.ascontiguousarray(values[..., part]).reshape(-1)
        size = int(edges[b + 1] - edges[b])
        yield chunk, kind, b, size, packed_keys(keys[part]), packed(block)


def answers(rows: Sequence[dict], kind: str, size: int, dtype, width: int) -> np.ndarray:
    """A chunk's answers of one kind, in the order of its keys."""
    mine = sorted((r for r in rows if r["kind"] == kind), key=lambda r: r["bucket"])
    found = in_columns(mine, dtype, width)
    if found.shape[1] != size:
        raise ValueError(f"{found.shape[1]} answers to {size} questions of kind {kind}")
    return found


def in_columns(rows: Sequence[dict], dtype, width: int) -> np.ndarray:
    """The values of all rows side by side, ``width`` of them to a key."""
    cells = [unpacked(r["values"], r["size"] * width, dtype).reshape(width, -1) for r in rows]
    return np.concatenate([np.zeros((width, 0), dtype), *cells], axis=1)


def asked(table: pa.Table) -> tuple[np.ndarray, np.ndarray, list[dict]]:
    """Of a bucket's questions: distinct keys, each question's place, and the rows."""
    rows = sorted(table.to_pylist(), key=lambda r: r["chunk"])
    keys = np.concatenate([unpacked_keys(r["keys"], r["size"]) for r in rows])
    distinct, place, _ = grouped(keys)
    return distinct, place, rows


def as_table(rows: Iterator[tuple], columns: str) -> pa.Table:
    kinds = {
        "long": pa.int64(),
        "int": pa.int32(),
        "string": pa.string(),
        "binary": pa.binary(),
        "boolean": pa.bool_(),
        "double": pa.float64(),
    }
    fields = [pa.field(n, kinds[k]) for n, k in (c.split() for c in columns.split(", "))]
    data = list(rows)
    arrays = [pa.array([r[i] for r in data], f.type) for i, f in enumerate(fields)]
    return pa.Table.from_arrays(arrays, schema=pa.schema(fields))


def per_chunk(rows: Callable[[dict, list[dict]], Iterator[tuple]], columns: str):
    """A function of Spark's groups from one of a chunk's cells and its answers."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        replies = right.to_pylist()
        found = (row for cells in left.to_pylist() for row in rows(cells, replies))
        return as_table(found, columns)

    return run


def ask_short(top: int, buckets: int) -> Callable[[pa.Table], pa.Table]:
    """Questions for a chunk's n-grams of the orders up to ``top``, all of them."""

    def ask(table: pa.Table) -> pa.Table:
        def rows():
            for cells in table.to_pylist():
                own = Chunk(cells, top)
                every = Evaluation(own, [], None, 0)
                for k in range(1, top + 1):
                    yield from count_questions(cells["chunk"], every, k, buckets)

        return as_table(rows(), ASK_COLUMNS)

    return ask


def count_questions(chunk: int, found: Evaluation, k: int, buckets: int):
    """For the n-grams of order k whose counts a chunk does not know.

    Of those it knows to have been seen once, one row tells how many there are.
    """
    asks = found.asks(k)
    learned, held = found.chunk.own_counts(k)
    n = (learned << 1 | held)[asks].astype(np.uint32)
    yield from questions(chunk, f"count{k}", found.chunk.grams[k][asks], n, buckets)
    alone = int((~asks & (learned > 0)).sum())
    if alone:
        yield chunk, f"alone{k}", chunk % buckets, alone, b"", b""


def ask_longer(k: int, order: int, buckets: int, model: Model):
    """What histories of order k get from a chunk, and counts of the order above."""

    def rows(cells: dict, replies: list[dict]):
        found = Evaluation(Chunk(cells, min(k + 1, order)), replies, model, k - 1)
        yield from found.past_questions(cells["chunk"], k, buckets)
        if k < order:
            yield from count_questions(cells["chunk"], found, k + 1, buckets)

    return per_chunk(rows, ASK_COLUMNS)


def answer(table: pa.Table) -> pa.Table:
    """The answers to one kind of questions to a bucket."""
    kind, bucket = table["kind"][0].as_py(), table["bucket"][0].as_py()
    if kind.startswith("alone"):
        n = sum(table["size"].to_pylist())
        stats = np.zeros(RELIABLE + 3, np.int64)
        stats[1] = stats[-1] = n
        row = None, kind.replace("alone", "count"), bucket, len(stats), packed(stats)
        return as_table(iter([row]), ANSWER_COLUMNS)
    distinct, place, rows = asked(table)
    answered = answer_counts if kind.startswith("count") else answer_backoff
    values, stats = answered(place, len(distinct), rows)

    def out():
        at = 0
        for r in rows:
            part = np.ascontiguousarray(values[..., at : at + r["size"]]).reshape(-1)
            yield r["chunk"], kind, bucket, r["size"], packed(part)
            at += r["size"]
        if stats is not None:
            yield None, kind, bucket, len(stats), packed(stats)

    return as_table(out(), ANSWER_COLUMNS)


def answer_counts(place: np.ndarray, n: int, rows: list[dict]):
    """Total counts, with a mark if held-out texts have the n-gram, and a mark for the
    first chunk that has learned it.

    Also the bucket's number of n-grams by count (0 for more than ``RELIABLE`` + 1) and
    the sum of all counts.
    """
    own = in_columns(rows, np.uint32, 1)[0]
    learned = own >> np.uint32(1)
    totals = np.bincount(place, weights=learned, minlength=n).astype(np.uint64)
    held = (np.bincount(place, weights=own & np.uint32(1), minlength=n) > 0).astype(np.uint64)
    at = np.flatnonzero(learned)
    _, first = np.unique(place[at], return_index=True)
    owner = np.zeros(len(place), np.uint64)
    owner[at[first]] = 1
    values = (totals << np.uint64(2) | held << np.uint64(1))[place] | owner
    sizes = np.where(totals > RELIABLE + 1, 0, totals)[totals > 0].astype(np.int64)
    stats = np.append(np.bincount(sizes, minlength=RELIABLE + 2), totals.sum())
    return values, stats.astype(np.int64)


def answer_backoff(place: np.ndarray, n: int, rows: list[dict]):
    """(what the divisor of seen n-grams is above the history's count, weight of the
    probability after the shorter history; one where the chunk does not use it)."""
    own = in_columns(rows, np.float64, 4)
    seen, kept, lower = (np.bincount(place, weights=w, minlength=n) for w in own[:3])
    divisor, weight = backoff(seen, kept, lower)
    more = np.where(seen > 0, divisor - seen, 0.0)
    return np.stack([more[place], np.where(own[3] > 0, weight[place], 1.0)]), None


# --- the model ---------------------------------------------------------------


def backoff(seen, kept, lower):
    """(divisor, weight) from a history's count, discounted count and lower mass.

    Where no discount left anything over, one is added to the divisor. A history that was
    not seen leaves all to the shorter one.
    """
    seen, kept, lower = map(np.asarray, (seen, kept, lower))
    divisor = np.where(kept > seen - 1e-9 * (seen + 1), seen + 1, seen)
    left = 1 - kept / np.maximum(divisor, 1)
    weight = np.where(seen > 0, left / np.maximum(1 - lower, 1e-300), 1.0)
    return np.where(seen > 0, divisor, 1.0), weight


def discounts(by_count: Sequence[int]) -> np.ndarray:
    """Factors for counts 0 to ``RELIABLE`` from the numbers of n-grams by count.

    Katz's formula; where the numbers do not allow it (some are zero, or it leaves the
    range from 0 to 1 or comes within a millionth of 1), half a count is taken off instead.
    """
    n = np.array(by_count, float)
    factors = np.ones(RELIABLE + 1)
    last = (RELIABLE + 1) * n[RELIABLE + 1] / n[1] if n[1] else 1.0
    for r in range(1, RELIABLE + 1):
        factor = -1.0
        if n[r] and n[r + 1] and last < 1:
            factor = ((r + 1) * n[r + 1] / (r * n[r]) - last) / (1 - last)
        factors[r] = factor if 0 < factor < 1 - 1e-6 else (r - 0.5) / r
    return factors


class Model:
    """What all chunks share: a few numbers per order."""

    def __init__(self, by_count: dict[int, Sequence[int]], tokens: int):
        self.factors = {k: discounts(n) for k, n in by_count.items()}
        self.tokens = tokens  # of all training texts
        self.types = int(sum(by_count[1]))
        kept = sum(
            self.discounted(1, r) * by_count[1][r] for r in range(1, RELIABLE + 1)
        )
        small = sum(r * by_count[1][r] for r in range(1, RELIABLE + 1))
        kept += tokens - small
        divisor, weight = backoff(tokens, kept, 0.0)
        self.divisor, self.unseen = float(divisor), float(weight)

    def discounted(self, k: int, counts) -> np.ndarray:
        counts = np.asarray(counts)
        few = np.minimum(counts, RELIABLE).astype(np.int64)
        return np.where(counts > RELIABLE, 1.0, self.factors[k][few]) * counts

    def single(self, counts: np.ndarray) -> np.ndarray:
        """Probabilities of words with these counts; all unseen words are one type."""
        return np.where(counts > 0, self.discounted(1, counts) / self.divisor, self.unseen)


class Evaluation:
    """Probabilities of a chunk's n-grams after their histories, order by order up to ``top``."""

    def __init__(self, chunk: Chunk, replies: Sequence[dict], model: Model | None, top: int):
        self.chunk, self.replies, self.model = chunk, replies, model
        self._counts: dict[int, tuple] = {}
        if top:
            self.p = model.single(self.counts(1)[0])
        for k in range(2, top + 1):
            c = self.counts(k)[0]
            seen, _ = self.histories(k)
            place, _ = self.past_places(k)
            more, weight = np.zeros(len(seen)), np.ones(len(seen))
            more[place], weight[place] = answers(replies, f"past{k}", len(place), np.float64, 2)
            past, unseen = chunk.past[k], np.flatnonzero(c == 0)
            p = model.discounted(k, c) / np.maximum(seen + more, 1)[past]
            p[unseen] = weight[past[unseen]] * self.p[chunk.last[k][unseen]]
            self.p = p

    def asks(self, k: int) -> np.ndarray:
        """Of which n-grams of order k the counts come from a bucket.

        The others have no training text at all, or are known to be in no more than one.
        """
        chunk = self.chunk
        if k <= 2:
            return np.ones(len(chunk.grams[k]), bool)
        seen, held = self.histories(k)
        # In one byte, as these are looked up in no order: 0, 1 or more, and the mark.
        state = (np.minimum(seen, 2) << 1 | held).astype(np.int8)
        past, last = state[chunk.past[k]], state[chunk.last[k]]
        few = np.minimum(past, last) >> 1
        learned, _ = chunk.own_counts(k)
        return np.where(learned > 0, (few > 1) | (past & last & 1 > 0), few > 0)

    def counts(self, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of the n-grams of order k: training counts, whether held-out texts have them
        too, and which of them this chunk stands for."""
        if k not in self._counts:
            asks = self.asks(k)
            found = answers(self.replies, f"count{k}", int(asks.sum()), np.uint64, 1)[0]
            learned, held = self.chunk.own_counts(k)
            counts, owner = learned.copy(), learned > 0
            counts[asks] = found >> np.uint64(2)
            held[asks] = (found & np.uint64(2)) > 0
            owner[asks] = (found & np.uint64(1)) > 0
            self._counts[k] = counts, held, owner
        return self._counts[k]

    def histories(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Counts of the histories of order k, and whether held-out texts have them.

        Every (k - 1)-gram but those at a text's end is followed by a token, so its count
        is the history's; every text has one start and one end.
        """
        counts, held, _ = self.counts(k - 1)
        texts = self.counts(1)[0][self.chunk.end]
        return np.append(counts, texts), np.append(held, True)

    def past_places(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Places of the histories sent to buckets, in order of key, and where the weight
        is used.

        A chunk sends what n-grams it stands for take from a history that is in held-out
        texts or frequent. It needs the weight for words not seen after the history, and
        the divisor if a frequent n-gram has the history, or the history itself is so
        frequent that discounts are small beside it: otherwise nothing is added to it.
        """
        chunk = self.chunk
        counts, _, owner = self.counts(k)
        seen, held = self.histories(k)
        past = chunk.past[k]
        wanted, sent = np.zeros(len(seen), bool), np.zeros(len(seen), bool)
        wanted[past[counts == 0]] = True
        wanted &= seen > 0
        sent[past[owner]] = True
        sent &= held | (seen > RELIABLE)
        sent[past[(counts > RELIABLE) | (seen > 1000)[past]]] = True
        place = np.flatnonzero(sent | wanted)
        keys = np.append(chunk.grams[k - 1], chunk.starts[k])
        place = place[np.argsort(keys[place], kind="stable")]
        return place, wanted[place]

    def past_questions(self, chunk: int, k: int, buckets: int) -> Iterator[tuple]:
        own = self.chunk
        counts, _, owner = self.counts(k)
        _, held = self.histories(k)
        place, wanted = self.past_places(k)
        n = len(held)
        sent = np.zeros(n, bool)
        sent[place] = True
        mine = np.flatnonzero(owner & sent[own.past[k]])
        past, c, shorter = own.past[k][mine], counts[mine], self.p[own.last[k][mine]]
        sums = [
            np.bincount(past, weights=w, minlength=n)[place]
            for w in (c, self.model.discounted(k, c), shorter * held[past])
        ]
        keys = np.append(own.grams[k - 1], own.starts[k])[place]
        values = np.stack([*sums, wanted.astype(float)])
        yield from questions(chunk, f"past{k}", keys, values, buckets)


SCORE_COLUMNS = (
    "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
    "base_score double, score double"
)


def scores(order: int, model: Model) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def rows(cells: dict, replies: list[dict]):
        own = Chunk(cells, order)
        found = Evaluation(own, replies, model, order)
        doc = np.repeat(np.arange(len(own.sizes)), own.sizes)
        known = found.counts(1)[0]
        base = np.log10((known + 1) / (model.tokens + model.types + 1))
        per_token = (known > 0)[own.at[1]], base[own.at[1]], np.log10(found.p)[own.at[order]]
        sums = [np.bincount(doc, weights=w, minlength=len(own.sizes)) for w in per_token]
        for i, doc_id in enumerate(own.ids):
            yield (
                doc_id,
                bool(own.held[i]),
                int(own.sizes[i]),
                int(sums[0][i]),
                model.tokens,
                float(sums[1][i]),
                float(sums[2][i]),
            )

    return per_chunk(rows, SCORE_COLUMNS)


# --- the operator ------------------------------------------------------------


def train_and_score(
    docs: DataFrame,
    held: str = "crc32(cast(doc_id AS string)) % 7 = 2",
    order: int = 3,
    chunk_tokens: int = CHUNK_TOKENS,
    bucket_entries: int = BUCKET_ENTRIES,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """(``SCORE_COLUMNS``) of each whole text, learning from those that are not held out.

    Letters A-Z are lowered, words are what ASCII white space separates, and each text
    ends in one more token. A null text is empty; rows with equal ids are separate texts;
    texts for which ``held`` (an expression in doc_id) is null are learned from. All
    words not seen in training are one type, whose probability is what the discounts of
    single words leave over.

    A task holds a chunk (about ``chunk_tokens``, or one longer text) or a bucket (about
    ``bucket_entries`` distinct n-grams of chunks) at a time. A frequent word or n-gram
    is one entry per chunk. The driver gets a few sums per bucket. Disk holds the chunks,
    all answers, and the questions of one order.
    """
    short_batches(docs)
    spark = docs.sparkSession
    texts = docs.select(F.col(id_column).cast("long").alias("doc_id"), empty_text(text_column).alias("text"))
    texts = texts.select("doc_id", F.coalesce(F.expr(held), F.lit(False)), "text")
    with shuffles_freed(spark):
        n_bytes = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    files = min(parts_for(n_bytes, 6 * chunk_tokens), MAX_FILES)
    names = {part: f"katz_{part}_{uuid.uuid4().hex}" for part in ("chunks", "replies")}
    paths = {part: scratch_dir(spark) for part in names}

    def bucketed(rows: DataFrame, part: str) -> DataFrame:
        """The table with these rows added, which is read by chunk without a shuffle."""
        writer = rows.write.mode("append").bucketBy(files, "chunk")
        writer.option("path", paths[part]).saveAsTable(names[part])
        return spark.table(names[part])

    try:
        with shuffles_freed(spark):
            chunks = bucketed(tokenized(texts, chunk_tokens), "chunks")
            n_tokens = chunks.agg(F.sum("n_tokens")).first()[0] or 0
            if not n_tokens:
                return spark.createDataFrame([], SCORE_COLUMNS)
            buckets = parts_for(n_tokens, bucket_entries)
            by_chunk = chunks.groupBy("chunk")
            asking = by_chunk.applyInArrow(ask_short(min(2, order), buckets), ASK_COLUMNS)
            for k in range(1, order + 1):
                if k > 1:
                    asking = both.applyInArrow(ask_longer(k, order, buckets, model), ASK_COLUMNS)
                found = asking.groupBy("kind", "bucket").applyInArrow(answer, ANSWER_COLUMNS)
                replies = bucketed(found.repartition(files, "chunk"), "replies")
                sums = summed(replies.filter("chunk IS NULL"))
                nothing = [0] * (RELIABLE + 3)
                counts = [sums.get(f"count{j}", nothing) for j in range(1, order + 1)]
                model = Model({j: c[:-1] for j, c in enumerate(counts, 1)}, counts[0][-1])
                replies = replies.filter("chunk IS NOT NULL")
                both = by_chunk.cogroup(replies.groupBy("chunk"))
            return materialize(both.applyInArrow(scores(order, model), SCORE_COLUMNS))
    finally:
        for part, name in names.items():
            spark.sql(f"DROP TABLE IF EXISTS {name}")
            delete_folder(spark, paths[part])


def summed(rows: DataFrame) -> dict[str, list[int]]:
    """The sums of all buckets by kind of count; there is a row per bucket and kind."""
    sums: dict[str, np.ndarray] = {}
    for row in rows.toLocalIterator():
        stats = unpacked(bytes(row["values"]), row["size"], np.int64)
        sums[row["kind"]] = sums.get(row["kind"], 0) + stats
    return {kind: [int(x) for x in total] for kind, total in sums.items()}
