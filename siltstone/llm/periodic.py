"""Periodic runs of words in texts, by seed and extend on diagonals.

A run is a maximal stretch of words with smallest period q, repeated often enough. On the
diagonal of lag q (word i beside word i + q) it is a stretch of equal words, of a length
that is known from below. Lags are searched by octaves, from 2^j to 2^(j+1) - 1, each with
an index of the k-grams of the smallest overlap that the octave guarantees. As such a gram
is at least as long as the lag, its occurrences within a run follow each other at exactly
the run's period, so the pairs of neighbouring occurrences include a seed of every run and
their number stays below that of the words. A table of how far each lag is covered keeps
a run's other seeds from being extended again.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.llm.tables import row_slices, short_batches

RUNS = "array<struct<start: bigint, length: bigint, period: bigint>>"
FOUND = f"struct<n_words: bigint, runs: {RUNS}, collapsed: string>"

# Words of several texts are searched together, up to about so many.
WORDS_AT_ONCE = 200_000


# --- one array of words -----------------------------------------------------


def repeated_grams(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Numbers of the pairs (left, right) that occur repeatedly; -1 for all others.

    Equal pairs have equal numbers. A pair with a -1 in it is a gram whose part occurs
    once, so it occurs once itself.
    """
    out = np.full(len(left), -1, np.int64)
    at = np.flatnonzero((left >= 0) & (right >= 0))
    if len(at):
        _, which, count = np.unique(
            left[at] * (right.max() + 1) + right[at], return_inverse=True, return_counts=True
        )
        out[at] = np.where(count[which] > 1, which, -1)
    return out


def joined(grams: np.ndarray, shift: int) -> np.ndarray:
    """Numbers of the repeated grams made of each gram and the one ``shift`` later."""
    last = max(0, len(grams) - shift)
    return repeated_grams(grams[:last], grams[shift:])


def next_occurrences(grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place, lag) for each occurrence of a gram that is followed by another."""
    at = np.flatnonzero(grams >= 0)
    order = at[np.argsort(grams[at], kind="stable")]
    here, there = order[:-1], order[1:]
    same = grams[here] == grams[there]
    here, lag = here[same], (there - here)[same]
    by_place = np.argsort(here)
    return here[by_place], lag[by_place]


def stretch(ids: np.ndarray, at: int, lag: int, sure: int) -> tuple[int, int]:
    """The maximal [a, b) around [at, at + sure) in which ids equal those a lag later."""
    a, b, step = at, at + sure, 64
    while b + lag < len(ids):
        end = min(b + step, len(ids) - lag)
        differ = np.flatnonzero(ids[b:end] != ids[b + lag : end + lag])
        if len(differ):
            b += int(differ[0])
            break
        b, step = end, step * 2
    step = 64
    while a > 0:
        start = max(0, a - step)
        differ = np.flatnonzero(ids[start:a] != ids[start + lag : a + lag])
        if len(differ):
            a = start + int(differ[-1]) + 1
            break
        a, step = start, step * 2
    return a, b


def runs_of(ids: np.ndarray, min_length: int, min_repeats: int) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run, by start and period.

    ``ids`` holds a number per word; a negative one equals no other word.
    """
    words = np.where(ids < 0, -1, ids)
    grams, size = repeated_grams(words, np.zeros_like(words)), 1  # grams of 2^f words
    found, octave = [], 1
    while octave * min_repeats <= len(ids) and (grams >= 0).any():
        # Of this octave or a later one, so that it never shrinks.
        lags = range(octave, max(2 * octave, min_length))
        overlap = min(max(min_length - q, (min_repeats - 1) * q) for q in lags)
        while 2 * size <= overlap:
            grams, size = joined(grams, size), 2 * size
        # Two grams of a power of two, overlapping, make one of the wanted length.
        shift = overlap - size
        seeds = joined(grams, shift) if shift else grams
        places, lags = next_occurrences(seeds)
        in_octave = (lags >= octave) & (lags < 2 * octave)
        covered: dict[int, int] = {}
        for at, lag in zip(places[in_octave].tolist(), lags[in_octave].tolist()):
            if at < covered.get(lag, 0):
                continue
            a, b = stretch(ids, at, lag, overlap)
            covered[lag] = b
            length = b - a + lag
            if length >= max(min_length, min_repeats * lag):
                found.append((a, length, lag))
        octave *= 2
    return sorted(found, key=lambda r: (r[0], r[2]))


# --- texts ------------------------------------------------------------------


def words_of(text: str | None) -> list[bytes]:
    """Runs of characters other than the blank and U+0009 to U+000D."""
    return (text or "").encode("utf-8", "replace").split()


def search(texts: list[list[bytes]], min_length: int, min_repeats: int) -> list[list]:
    """The runs of each of some texts, found in one array with breaks between texts."""
    number: dict[bytes, int] = {}
    starts, flat = [], []
    for words in texts:
        starts.append(len(flat))
        flat += [number.setdefault(w, len(number)) for w in words]
        flat.append(-len(starts))
    out: list[list] = [[] for _ in texts]
    found = runs_of(np.array(flat, np.int64), min_length, min_repeats)
    owners = np.searchsorted(starts, [r[0] for r in found], side="right") - 1
    for owner, (start, length, period) in zip(owners.tolist(), found):
        out[owner].append((start - starts[owner], length, period))
    return out


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> str:
    """The words with each run cut to its first period, joined by blanks."""
    kept, at = [], 0
    for a, b in sorted((s + q, s + n) for s, n, q in runs):
        kept += words[at : max(at, a)]
        at = max(at, b)
    return b" ".join(kept + words[at:]).decode("utf-8", "replace")


def grouped(texts: pa.Array, limit: int = WORDS_AT_ONCE) -> Iterator[list[list[bytes]]]:
    """Words of the texts, in groups of about ``limit`` words; a text is never cut."""
    group, held = [], 0
    for text in texts:
        words = words_of(text.as_py())
        if group and held + len(words) > limit:
            yield group
            group, held = [], 0
        group.append(words)
        held += len(words)
    if group:
        yield group


def run_finder(min_length: int, min_repeats: int):
    """Function of a text: ``FOUND``."""

    @F.arrow_udf(FOUND)
    def find(texts: pa.Array) -> pa.Array:
        counts, runs, collapsed = [], [], []
        for group in grouped(texts):
            for words, own in zip(group, search(group, min_length, min_repeats)):
                counts.append(len(words))
                runs.append([dict(zip(("start", "length", "period"), r)) for r in own])
                collapsed.append(collapse(words, own))
        run = pa.struct([(n, pa.int64()) for n in ("start", "length", "period")])
        columns = [
            pa.array(counts, pa.int64()),
            pa.array(runs, pa.list_(run)),
            pa.array(collapsed, pa.string()),
        ]
        return pa.StructArray.from_arrays(columns, names=["n_words", "runs", "collapsed"])

    return find.asNondeterministic()


def periodic_runs(
    docs: DataFrame,
    min_length: int = 6,
    min_repeats: int = 4,
    text: str | Column = "text",
) -> DataFrame:
    """Each row of ``docs`` with the periodic runs of its text.

    Columns: row (a struct c0, c1, ... of the columns of ``docs``), n_words, runs (start,
    length, period, counted in words, by start and period), collapsed (the words that
    follow the first period of no run, joined by single blanks). A run is a maximal
    stretch with smallest period q of at least ``min_length`` words and ``min_repeats``
    (three or more) periods.

    Words are divided by blanks and U+0009 to U+000D and compared as they are. A null or
    blank text has no words, no runs and an empty ``collapsed``. Rows are independent:
    nothing is shuffled, repeated rows and ids give repeated results, and a text of any
    length is searched whole, in a time that grows as n log n with its words. An empty
    table gives an empty result. Only the text goes to Python.
    """
    if min_repeats < 3 or min_length < 2:
        raise ValueError("a run has two words and three periods at least")
    short_batches(docs)
    row = F.struct(
        *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns)],
        F.lit(0).alias("end"),
    )
    text = F.col(f"`{text}`") if isinstance(text, str) else text
    find = run_finder(min_length, min_repeats)
    found = docs.select(row.alias("row"), find(text.cast("string")).alias("found"))
    return found.select("row", *[f"found.{f}" for f in ("n_words", "runs", "collapsed")])


def longest_run(runs: str | Column = "runs") -> Column:
    """The longest of some runs, of those the first, then the shortest period; or null."""
    keyed = F.transform(
        runs, lambda r: F.struct(r["length"], -r["start"], -r["period"], r.alias("run"))
    )
    return F.array_max(keyed)["run"]


def runs_digest(runs: str | Column = "runs") -> Column:
    """SHA-256 of ``start,length,period`` and a line feed for each run."""
    lines = F.transform(
        runs, lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))
    )
    return F.sha2(F.array_join(lines, ""), 256)


def looped_text(doc_id: str, text: str) -> Column:
    """The text, for one id in ten with a part of it repeated from some word on.

    With h the CRC-32 of the id's decimal digits, g = h // 10 and n words: if 10 divides
    h, each word i >= a is replaced by word a + (i - a) % p, where a = g % n and
    p = 1 + (n - a) // (3 + g % 8). Texts without words and rows without id stay.
    """
    h = F.crc32(F.col(doc_id).cast("string").cast("binary"))
    g = F.floor(h / 10)
    words = F.regexp_extract_all(F.col(text), F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))

    def loop(words: Column) -> Column:
        n = F.size(words)
        a = g % n
        p = F.lit(1) + F.floor((n - a) / (F.lit(3) + g % 8))
        place = lambda i: F.when(i < a, i).otherwise(a + (i - a) % p).cast("int")
        looped = F.transform(words, lambda _, i: F.get(words, place(i)))
        return F.when(n > 0, F.array_join(looped, " ")).otherwise(F.col(text))

    # Bound to a one-element array, the words are taken from the text once.
    return F.when(h % 10 == 0, F.get(F.transform(F.array(words), loop), 0)).otherwise(
        F.col(text)
    )
