"""Words that differ by one letter, from a dictionary of pairs of trie nodes.

The nodes of the trie of all words and of the trie of all reversed words are numbered. A
word and a place in it give a pair of numbers: the node of what stands before the place
and the reversed node of what stands behind it, or behind the letter there, which is
skipped. Two words that share a pair with a letter skipped in both differ by that letter
alone; a pair with a letter skipped in one word, and none in the other, tells an inserted
letter. The numbers are exact, so no pair of words needs to be compared.

Words stay in sorted ranges, one range to a task, in which a trie is walked from word to
word. Only nodes above the ends of ranges are shared by tasks; they are named after the
first end they lie above.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.llm.tables import materialize, parts_for, short_batches

COUNTED = "word string, n long"
NODES = "key long, place long, word string, nodes array<long>"
PAIRS = "prefix long, suffix long, rank long, n long, kind int"

# What a pair skips: no letter, a letter that follows its like, or another letter.
WHOLE, LATER, FIRST = 0, 1, 2

# Places of words, and numbers of nodes, within a range of words.
IN_RANGE = 1 << 40

LETTERS = r"A-Za-z\u00C0-\u00FF"
LOWERED = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


# --- words ------------------------------------------------------------------


def letter_runs(text: str, slice_chars: int = 1 << 20) -> Counter:
    """How often each run of letters occurs, with A-Z lowered.

    The text is read in slices, cut behind runs, so that a long one is never held as a
    list of all its words.
    """
    runs, other = re.compile(f"[{LETTERS}]+"), re.compile(f"[^{LETTERS}]")
    found, at = Counter(), 0
    while at < len(text):
        cut = other.search(text, min(len(text), at + slice_chars))
        end = cut.start() if cut else len(text)
        found.update(runs.findall(text[at:end].translate(LOWERED)))
        at = end
    return found


def misspelt(run: str, doc_id: object, every: int) -> str:
    """The run, or if ``every`` divides the CRC-32 of ``<doc_id>:<run>``, less one letter.

    The letter is the one whose place is the CRC-32 modulo the length.
    """
    h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
    if h % every:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def count_words(
    docs: DataFrame,
    min_length: int = 5,
    min_count: int = 3,
    misspell_every: int | None = None,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """(word, n): the words of the texts and how often they occur.

    A word is a maximal run of the letters A-Z, a-z and U+00C0 to U+00FF with A-Z lowered,
    of ``min_length`` code points or more that occurs ``min_count`` times or more. With
    ``misspell_every``, runs lose a letter first, as ``misspelt`` says; a null id is then
    taken as empty text. A null text has no words; repeated rows count each. Tasks count
    words before they are shuffled, so a word that is a third of all costs no more.
    """
    short_batches(docs)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, chars = Counter(), 0

        def counted() -> pa.RecordBatch:
            arrays = [pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())]
            return pa.RecordBatch.from_arrays(arrays, names=["word", "n"])

        for batch in batches:
            for doc_id, text in zip(*batch.columns):
                doc_id = doc_id.as_py()
                for run, n in letter_runs(text.as_py() or "").items():
                    if len(run) < min_length:
                        continue
                    if misspell_every:
                        run = misspelt(run, doc_id, misspell_every)
                        if len(run) < min_length:
                            continue
                    if run not in total:
                        chars += len(run)
                    total[run] += n
                if chars > 2_000_000:
                    yield counted()
                    total, chars = Counter(), 0
        yield counted()

    texts = docs.select(F.col(id_column), F.col(text_column).cast("string"))
    found = texts.mapInArrow(count, COUNTED).groupBy("word").agg(F.sum("n").alias("n"))
    return found.filter(F.col("n") >= min_count)


# --- tries ------------------------------------------------------------------


class Range(NamedTuple):
    """What a task must know of other ranges of words.

    ``above_first[d]`` names the node of the first word's first d letters, as far as the
    range before has it too; ``above_last`` does so for the letters ``end`` that the last
    word has in common with the next range's first.
    """

    number: int
    above_first: list[int]
    end: str
    above_last: list[int]


def shared_length(a: str, b: str) -> int:
    """How many letters two words have in common at their start."""
    for i, (x, y) in enumerate(zip(a, b)):
        if x != y:
            return i
    return min(len(a), len(b))


def ranges(ends: list[tuple[int, str, str]]) -> dict[int, Range]:
    """The ranges, by part, from each one's (part, first word, last word) in order."""
    found, above = {}, []
    for number, (part, first, last) in enumerate(ends):
        end, following = "", []
        if number + 1 < len(ends):
            shared = shared_length(last, ends[number + 1][1])
            end = last[:shared]
            # Nodes above all of the range, and so above the end before, keep their name.
            following = above[: min(shared, shared_length(first, last)) + 1]
            following += [
                -(number * IN_RANGE + d + 1) for d in range(len(following), shared + 1)
            ]
        found[part] = Range(number, above, end, following)
        above = following
    return found


def walk(words: list[str], where: Range) -> Iterator[list[int]]:
    """For each of the sorted words the nodes of its first 0, 1, ... letters.

    Nodes are numbered as they are met; shared ones have their names.
    """
    fresh, path, before = where.number * IN_RANGE, list(where.above_first), None
    for word in words:
        if before is not None:
            del path[shared_length(before, word) + 1 :]
        named = shared_length(word, where.end) + 1 if where.above_last else 0
        path += where.above_last[len(path) : named]
        new = len(word) + 1 - len(path)
        path += range(fresh, fresh + new)
        fresh += new
        before = word
        yield list(path)


def trie_nodes(words: DataFrame, words_per_part: int = 50_000) -> DataFrame:
    """``NODES`` for each (key, word): its place in sorted order and its trie nodes.

    Words must be distinct. Two of each part come to the driver, its first and its last.
    """
    parts = parts_for(words.count(), words_per_part)
    placed = words.repartitionByRange(parts, "word").select(
        "key", "word", F.spark_partition_id().alias("part")
    )
    placed = materialize(placed)
    ends = placed.groupBy("part").agg(F.min("word"), F.max("word"))
    known = ranges(sorted(tuple(r) for r in ends.collect()))

    def number(rows: pd.DataFrame) -> pd.DataFrame:
        where = known[rows["part"].iat[0]]
        rows = rows.sort_values("word")
        nodes = [np.array(n, np.int64) for n in walk(rows["word"].tolist(), where)]
        place = where.number * IN_RANGE + np.arange(len(rows))
        return rows[["key"]].assign(place=place, word=rows["word"], nodes=nodes)

    return placed.groupBy("part").applyInPandas(number, NODES)


# --- pairs ------------------------------------------------------------------


def node_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``PAIRS`` of words (rank, n, word, forward, backward): one to a place and kind."""
    for batch in batches:
        for at in range(0, batch.num_rows, 5000):
            columns: list[list[np.ndarray]] = [[] for _ in range(5)]
            rank, n, words, forward, backward = batch.slice(at, 5000).columns
            for r, c, word, f, b in zip(
                rank.to_pylist(), n.to_pylist(), words.to_pylist(), forward, backward
            ):
                before = f.values.to_numpy()
                behind = b.values.to_numpy()[::-1]
                letters = np.frombuffer(word.encode("utf-32-le"), "<u4")
                repeats = np.concatenate([[False], letters[1:] == letters[:-1]])
                size = len(before) + len(letters)
                columns[0] += [before, before[:-1]]
                columns[1] += [behind, behind[1:]]
                columns[2].append(np.full(size, r))
                columns[3].append(np.full(size, c))
                columns[4] += [
                    np.full(len(before), WHOLE, np.int32),
                    np.where(repeats, LATER, FIRST).astype(np.int32),
                ]
            if columns[0]:
                arrays = [pa.array(np.concatenate(c)) for c in columns]
                names = [c.split()[0] for c in PAIRS.split(", ")]
                yield pa.RecordBatch.from_arrays(arrays, names=names)


def neighbours(pairs: DataFrame) -> DataFrame:
    """(rank, n_near, best) of the words that have others near them.

    ``best`` is the struct (n, order) of the most frequent near word, of those with equal
    n the first in sorted order; order is its negated rank. The words that share a pair
    differ in one letter, so a group has no more members than there are letters, and one
    word that skips none. Each near word is met in one group alone: a replaced letter has
    one place, and of the places where a letter could be inserted beside its like the
    first counts.
    """
    member = F.struct("n", (-F.col("rank")).alias("order"), "kind")
    groups = pairs.groupBy("prefix", "suffix").agg(F.collect_list(member).alias("members"))
    groups = groups.filter(F.size("members") > 1)

    def words(kind: Callable[[Column], Column]) -> Column:
        chosen = F.filter("members", lambda m: kind(m["kind"]))
        return F.transform(chosen, lambda m: F.struct(m["n"], m["order"]))

    groups = groups.select(
        "members",
        words(lambda k: k != WHOLE).alias("skipping"),
        words(lambda k: k == FIRST).alias("longer"),
        F.get(words(lambda k: k == WHOLE), 0).alias("shorter"),
    )
    groups = groups.select("*", F.array_max("skipping").alias("most"))
    groups = groups.select(
        "*", F.array_max(F.filter("skipping", lambda m: m != F.col("most"))).alias("next")
    )
    found = groups.select(F.explode("members").alias("m"), *groups.columns[1:])
    own = F.struct(F.col("m.n"), F.col("m.order"))
    other = F.when(own == F.col("most"), F.col("next")).otherwise(F.col("most"))
    inserted = F.when(F.col("m.kind") == FIRST, F.col("shorter"))
    whole = F.col("m.kind") == WHOLE
    found = found.select(
        (-F.col("m.order")).alias("rank"),
        F.when(whole, F.size("longer"))
        .otherwise(F.size("skipping") - 1 + inserted.isNotNull().cast("int"))
        .alias("near"),
        F.when(whole, F.array_max("longer"))
        # Neither or one of the two may be there.
        .otherwise(F.array_max(F.array_compact(F.array(other, inserted))))
        .alias("best"),
    )
    return found.groupBy("rank").agg(
        F.sum("near").cast("long").alias("n_near"), F.max("best").alias("best")
    ).filter("n_near > 0")


def last_of_chains(steps: DataFrame) -> DataFrame:
    """(rank, root) for each step (rank, to): where following the steps ends.

    There must be no cycles. Each round doubles how far a row has come, and is stored.
    """
    reached = materialize(steps.select("rank", F.col("to").alias("root")))
    while True:
        ahead = reached.select(F.col("rank").alias("root"), F.col("root").alias("further"))
        moved = reached.join(ahead, "root", "left")
        if moved.filter("further IS NOT NULL").isEmpty():
            return reached
        reached = materialize(
            moved.select("rank", F.coalesce("further", "root").alias("root"))
        )


def spelling_variants(
    words: DataFrame, dominance: int = 2, words_per_part: int = 50_000
) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for each (word, n) of a dictionary.

    Two words are near if one inserted, deleted or replaced code point tells them apart;
    ``n_near`` counts a word's near words. Its ``form`` is the most frequent of them (of
    those with equal n the first by code points), if that is at least ``dominance``
    (over one) times as frequent; else null. ``root`` is where forms lead in the end; the
    word itself if it has no form.

    Words must be distinct and not null. An empty dictionary gives an empty result. A
    word of any length is taken whole; its rows grow with its length, not with the square.
    """
    if dominance < 2:
        raise ValueError("a form is at least twice as frequent")
    listed = materialize(
        words.select(F.monotonically_increasing_id().alias("key"), "word", "n")
    )
    forward = trie_nodes(listed.select("key", "word"), words_per_part)
    forward = materialize(
        forward.join(listed.select("key", "n"), "key").select(
            F.col("place").alias("rank"), "n", "word", F.col("nodes").alias("forward")
        )
    )
    reverse = forward.select(F.col("rank").alias("key"), F.reverse("word").alias("word"))
    backward = trie_nodes(reverse, words_per_part).select(
        F.col("key").alias("rank"), F.col("nodes").alias("backward")
    )
    both = forward.join(backward, "rank").select("rank", "n", "word", "forward", "backward")
    near = materialize(neighbours(both.mapInArrow(node_pairs, PAIRS)))

    ranked = forward.select("rank", "word", "n").join(near, "rank", "left")
    form = F.when(F.col("best.n") >= dominance * F.col("n"), F.col("best"))
    ranked = materialize(
        ranked.select(
            "rank",
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).alias("n_near"),
            (-form["order"]).alias("to"),
            form["n"].alias("form_n"),
        )
    )
    roots = last_of_chains(ranked.filter("to IS NOT NULL"))
    name = ranked.select("rank", "word")
    return (
        ranked.join(roots, "rank", "left")
        .join(name.toDF("to", "form"), "to", "left")
        .join(name.toDF("root", "root_word"), "root", "left")
        .select(
            "word",
            "form",
            F.coalesce("root_word", "word").alias("root"),
            "n",
            "n_near",
            "form_n",
        )
    )
