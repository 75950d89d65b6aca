"""Benchmark decontamination with a suffix automaton over the test items' words.

The items are a stated set of queries against all documents. They are cut into
blocks of a fixed number of words; each block becomes one generalised automaton
(every factor of every item of it is a path), which is broadcast, and the documents'
words are streamed through it, keeping the length of the longest match that ends
at each word.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.llm.tables import empty_text, materialize, short_batches

WORD = re.compile(rb"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
# A-Z lowered; bytes that cannot be part of a word become blanks.
_FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32
    for b in range(256)
)
BLOCK_WORDS = 50_000
FOUND = (
    "struct<n_words: bigint, spans: array<struct<a: int, b: int>>, items: array<string>, "
    "cleaned: string>"
)


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "replace").translate(_FOLD).split()


@dataclass
class Automaton:
    """Suffix automaton of a block of items; states are numbers, 0 is the root.

    ``cut[s]`` lists the item windows that end a match of at least ``window`` words in
    state s; ``whole[s]`` the nearest state, s or above it, at which an item shorter
    than a window ends, or 0.
    """

    window: int
    steps: list[dict[bytes, int]] = field(default_factory=lambda: [{}])
    length: list[int] = field(default_factory=lambda: [0])
    link: list[int] = field(default_factory=lambda: [-1])
    items: dict[int, set] = field(default_factory=dict)
    whole: list[int] = field(default_factory=list)
    watch: list[bool] = field(default_factory=list)

    def _state(self, length: int, steps: dict[bytes, int], link: int) -> int:
        self.steps.append(steps)
        self.length.append(length)
        self.link.append(link)
        return len(self.length) - 1

    def _split(self, p: int, word: bytes, q: int) -> int:
        """The state for p's word alone, where q also stands for longer factors."""
        if self.length[q] == self.length[p] + 1:
            return q
        clone = self._state(self.length[p] + 1, dict(self.steps[q]), self.link[q])
        self.link[q] = clone
        while p >= 0 and self.steps[p].get(word) == q:
            self.steps[p][word] = clone
            p = self.link[p]
        return clone

    def _extend(self, last: int, word: bytes) -> int:
        if (q := self.steps[last].get(word)) is not None:
            return self._split(last, word, q)
        new = self._state(self.length[last] + 1, {}, 0)
        p = last
        while p >= 0 and word not in self.steps[p]:
            self.steps[p][word] = new
            p = self.link[p]
        if p >= 0:
            self.link[new] = self._split(p, word, self.steps[p][word])
        return new

    def _cut(self, state: int) -> int:
        """The state of the last ``window`` words of a match in ``state``."""
        while self.length[self.link[state]] >= self.window:
            state = self.link[state]
        return state

    @classmethod
    def build(cls, items: Iterable[tuple[object, list[bytes]]], window: int) -> Automaton:
        made, paths = cls(window), []
        for item, words in items:
            last, path = 0, []
            for word in words:
                last = made._extend(last, word)
                path.append(last)
            paths.append((item, words))
        ends: dict[int, set] = {}
        for item, words in paths:
            state = 0
            for n, word in enumerate(words, 1):
                state = made.steps[state][word]
                if n >= window:
                    made.items.setdefault(made._cut(state), set()).add(item)
            if 0 < len(words) < window:
                ends.setdefault(state, set()).add(item)
        made.items |= ends
        order = sorted(range(1, len(made.length)), key=made.length.__getitem__)
        made.whole = [0] * len(made.length)
        for s in order:
            made.whole[s] = s if s in ends else made.whole[made.link[s]]
        made.watch = [
            bool(made.whole[s]) or made.length[s] >= window for s in range(len(made.length))
        ]
        return made

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set]:
        """Spans [start, end) of hit words, by their end, and the items found."""
        steps, length, link = self.steps, self.length, self.link
        watch, window, whole = self.watch, self.window, self.whole
        state = size = 0
        spans: list[tuple[int, int]] = []
        seen: set[int] = set()
        for at, word in enumerate(words):
            to = steps[state].get(word)
            while to is None and state:
                state = link[state]
                size = length[state]
                to = steps[state].get(word)
            if to is None:
                continue
            state, size = to, size + 1
            if not watch[state]:
                continue
            if size >= window:
                seen.add(self._cut(state))
                spans.append((at + 1 - size, at + 1))
            short = whole[state]
            if short == state and size < length[state]:
                short = whole[link[state]]
            while short:
                seen.add(short)
                spans.append((at + 1 - length[short], at + 1))
                short = whole[link[short]]
        return spans, set().union(*(self.items[s] for s in seen))


def merge(spans: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    """Disjoint spans, sorted; those that touch are joined."""
    merged: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if merged and a <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(b, merged[-1][1]))
        else:
            merged.append((a, b))
    return merged


def item_blocks(
    items: DataFrame, window: int, block_words: int, id_column: str, text_column: str
) -> Iterator[list[tuple[object, list[bytes]]]]:
    """The items' words in blocks of at most ``block_words``, one block at a time.

    An item that is longer is cut into parts that overlap by a window less one word,
    so that they have the same windows.
    """
    rows = items.select(F.col(id_column).alias("i"), empty_text(text_column).alias("t"))
    block, held = [], 0
    for row in rows.toLocalIterator():
        words, at = words_of(row["t"]), 0
        while at < len(words) and (at == 0 or len(words) - at >= window):
            part = words[at : at + block_words]
            if held and held + len(part) > block_words:
                yield block
                block, held = [], 0
            block.append((row["i"], part))
            held += len(part)
            at += max(1, block_words - window + 1)
    if block:
        yield block


def find_leaks(
    docs: DataFrame,
    items: DataFrame,
    window: int = 10,
    block_words: int = BLOCK_WORDS,
    text_column: str = "text",
    item_id_column: str = "item_id",
    item_text_column: str = "text",
    min_span: int | None = None,
) -> DataFrame:
    """Each row of ``docs`` with what it shares with the items.

    Columns: row (a struct c0, c1, ... of the columns other than the text, in their
    order), text, n_words, spans (disjoint word ranges that
    are hit), items (ids found, as text, sorted). Words are runs of ASCII letters and
    digits and of other characters than ASCII, with A-Z lowered; a null has none. An
    item without id takes part, but is not listed; items with equal ids are listed
    once. Rows with equal ids are separate. With ``min_span``, a column cleaned has the
    text without spans of that many words or more; it is null where there is none.
    """
    if window < 2 or block_words < 2 * window:
        raise ValueError("a window has two words at least, a block two windows")
    short_batches(docs)
    others = [c for c in docs.columns if c != text_column]
    frame = docs.select(
        F.struct(
            *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(others)],
            F.lit(0).alias("end"),
        ).alias("row"),
        F.col(f"`{text_column}`").cast("string").alias("text"),
        F.lit(None).cast(FOUND).alias("found"),
    )
    share = docs.sparkSession.sparkContext.broadcast
    blocks = item_blocks(items, window, block_words, item_id_column, item_text_column)
    block = next(blocks, [])
    while True:
        following = next(blocks, None)
        # Plain values: executors need not have this package to read a broadcast.
        shared = share(tuple(vars(Automaton.build(block, window)).values()))
        match = matcher(shared, min_span if following is None else None)
        frame = frame.withColumn("found", match("text", "found"))
        if following is None:
            break
        frame = materialize(frame)  # one automaton at a time in a task
        block = following
    fields = ["n_words", "spans", "items", *["cleaned"] * (min_span is not None)]
    return frame.select("row", "text", *[f"found.{f}" for f in fields])


def matcher(shared, min_span: int | None):
    """Function of a text and of what earlier blocks found in it; ``FOUND``.

    Only these columns go to Python; the others of a row stay where they are.
    """

    @F.arrow_udf(FOUND)
    def match(texts: pa.Array, before: pa.Array) -> pa.Array:
        automaton = Automaton(*shared.value)
        rows = []
        for text, old in zip(texts, before):
            text = text.as_py()
            words = words_of(text)
            hit, found = automaton.scan(words)
            found = {str(i) for i in found if i is not None}
            if (old := old.as_py()) is not None:
                hit += [(s["a"], s["b"]) for s in old["spans"]]
                found |= set(old["items"])
            spans, cleaned = merge(hit), None
            if min_span is not None:
                long = [(a, b) for a, b in spans if b - a >= min_span]
                cleaned = without_spans(text, long) if long else None
            spans = [{"a": a, "b": b} for a, b in spans]
            rows.append((len(words), spans, sorted(found), cleaned))
        span = pa.struct([("a", pa.int32()), ("b", pa.int32())])
        kinds = (pa.int64(), pa.list_(span), pa.list_(pa.string()), pa.string())
        columns = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)]
        return pa.StructArray.from_arrays(columns, names=["n_words", "spans", "items", "cleaned"])

    # A deterministic function would be run once for a filter on what it finds and once
    # more for the rows that pass.
    return match.asNondeterministic()


def without_spans(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without the words of the spans and what stands between them."""
    raw = text.encode("utf-8", "replace")
    places = [m.span() for m in WORD.finditer(raw.lower())]
    kept, at = [], 0
    for a, b in spans:
        kept.append(raw[at : places[a][0]])
        at = places[b - 1][1]
    return b"".join([*kept, raw[at:]]).decode("utf-8", "replace")


def remove_leaks(
    docs: DataFrame,
    items: DataFrame,
    window: int = 10,
    min_span: int = 1,
    max_share: float = 0.5,
    text_column: str = "text",
    length_column: str = "n_chars",
    **more,
) -> DataFrame:
    """The documents, without spans they share with the items.

    Spans of ``min_span`` words or more are cut out of the text, and ``length_column``,
    if there, is set to its new length. Documents of which more than ``max_share`` of
    the words are hit go. Others are returned as they are, with their columns.
    """
    found = find_leaks(
        docs, items, window, text_column=text_column, min_span=min_span, **more
    )
    found = found.filter(hit_words("spans") <= F.col("n_words") * max_share)
    columns, others = [], [c for c in docs.columns if c != text_column]
    for c in docs.columns:
        if c == text_column:
            value = F.coalesce("cleaned", "text")
        else:
            value = F.col(f"row.c{others.index(c)}")
        if c == length_column:
            changed = F.char_length("cleaned").cast(docs.schema[c].dataType)
            value = F.coalesce(changed, value)
        columns.append(value.alias(c))
    return found.select(*columns)


def hit_words(spans: str) -> Column:
    """How many words the spans cover."""
    return F.aggregate(
        spans, F.lit(0).cast("long"), lambda n, s: n + (s["b"] - s["a"]).cast("long")
    )


# What find_leaks gives for windows of ten words, by comparing every run of words.
ORACLE = r"""
WITH texts AS (
    SELECT row_number() OVER () AS row_id, doc_id,
        regexp_extract_all(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
    FROM documents
), items AS (
    SELECT item_id,
        regexp_extract_all(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
    FROM benchmark
), windows AS (
    SELECT DISTINCT item_id, size, array_to_string(words[i : i + size - 1], ' ') AS run
    FROM (SELECT item_id, words, least(10, len(words)) AS size,
            unnest(range(1, greatest(len(words) - 10, 0) + 2)) AS i
        FROM items WHERE len(words) > 0)
), runs AS (
    SELECT row_id, i, size, array_to_string(words[i : i + size - 1], ' ') AS run
    FROM (SELECT row_id, words, size, unnest(range(1, len(words) - size + 2)) AS i
        FROM texts CROSS JOIN (SELECT DISTINCT size FROM windows))
), hits AS (
    SELECT row_id, i, size, item_id FROM runs JOIN windows USING (size, run)
), hit_words AS (
    SELECT row_id, count(DISTINCT word) AS n
    FROM (SELECT row_id, unnest(range(i, i + size)) AS word FROM hits) GROUP BY row_id
), hit_items AS (
    SELECT row_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS listed
    FROM (SELECT DISTINCT row_id, cast(item_id AS varchar) AS item FROM hits
        WHERE item_id IS NOT NULL) GROUP BY row_id
)
SELECT t.doc_id, cast(len(t.words) AS bigint) AS n_words, coalesce(w.n, 0) AS n_hit,
    coalesce(i.n, 0) AS n_items, sha256(coalesce(i.listed, '')) AS items_sha256,
    coalesce(w.n, 0) > 0 AS contaminated
FROM texts t LEFT JOIN hit_words w USING (row_id) LEFT JOIN hit_items i USING (row_id)
"""
