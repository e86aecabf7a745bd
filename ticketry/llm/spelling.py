"""Spelling variants by permuterm rotations: words one insertion, deletion or replacement apart.

A word w with a terminator has a rotation at each place: w[i+1:] $ w[:i] w[i] ends in the character
at i. Two words that differ by replacing it share that rotation up to its last character; a word
without it has what is left as a whole rotation. So each word gives, for every character, the rotation
that skips it (``open``), and every whole rotation (``closed``). All of them are range-sorted, and
words near each other stand in one group of equal strings: at most one closed word, and open ones that
differ in the skipped character, which the alphabet bounds. A scan of the groups gives each member the
number and the best of its neighbours there; no pairs are made.

Each neighbour is met once: words of one length differ at one place, and of a run of equal characters
only the first is deleted. Rotations of long words would be long themselves, so they go by 127-bit
rolling hashes, one row a place as well.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketry.llm.common import cut

#: Letters of a word: the Latin ones up to code point 255.
RUN = re.compile("[A-Za-zÀ-ÿ]+")
#: A run is altered where this divides its number.
ALTERED = 97
#: Code points and occurrences that a word has at least.
LEAST_POINTS, LEAST_TIMES = 5, 3
#: Distinct words a task counts before it passes them on.
HELD_WORDS = 200_000
#: Words of more code points go by hashes of their rotations.
LONG = 64
#: Rows of a batch that leaves Python.
BATCH = 50_000
#: The terminator is no letter.
END = "\0"
#: Rolling hashes are polynomials modulo a Mersenne prime; the base is an odd constant of 126 bits.
PRIME = (1 << 127) - 1
BASE = 0x2545F4914F6CDD1D9E3779B97F4A7C15 & (PRIME >> 1) | 1


def variants(doc_id: int | None, text: str, altered: int = ALTERED) -> Counter:
    """Words of a text, with some altered: lower-cased (A-Z) runs of letters, and how often.

    h is the crc32 of id, colon and run; where ``altered`` divides it, the code point at h modulo the
    length is deleted. A null id is empty.
    """
    lowered = text.encode().lower().decode()  # of bytes, lower() changes A-Z only
    start = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    out: Counter = Counter()
    for word, times in Counter(RUN.findall(lowered)).items():
        h = zlib.crc32(word.encode(), start)
        if h % altered == 0:
            at = h % len(word)
            word = word[:at] + word[at + 1 :]
        out[word] += times
    return out


def _counted(least: int, altered: int):
    def run(batches):
        held: Counter = Counter()
        for batch in batches:
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                for word, times in variants(doc, text, altered).items():
                    if len(word) >= least:
                        held[word] += times
                if len(held) >= HELD_WORDS:
                    yield _words(held)
                    held = Counter()
        if held:
            yield _words(held)

    return run


def _words(held: Counter):
    return pa.RecordBatch.from_arrays(
        [pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], ["word", "n"]
    )


def vocabulary(
    documents: DataFrame, least_points: int = LEAST_POINTS, least_times: int = LEAST_TIMES,
    altered: int = ALTERED,
) -> DataFrame:
    """word and n (occurrences in all documents) of the words that are long and frequent enough.

    Words are counted where they arise, so a common word is a few rows a task.
    """
    rows = documents.select(
        documents["doc_id"].cast("long").alias("doc_id"), documents["text"].alias("text")
    ).where("text IS NOT NULL")
    return (
        rows.mapInArrow(_counted(least_points, altered), "word string, n long")
        .groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_times)
    )


def rotations(word: str):
    """(key, open, first) of each rotation of a word: ``open`` ones skip the character at their place,
    which ``first`` says to be the first of a run of equal ones."""
    for i in range(len(word)):
        yield (word[i + 1 :] + END + word[:i]).encode(), True, i == 0 or word[i] != word[i - 1]
    for i in range(len(word) + 1):
        yield (word[i:] + END + word[:i]).encode(), False, False


def hashed_rotations(word: str, opened: bool):
    """The same with hashes for keys, in time and memory that grow with the word, not its square.

    ``opened`` is False for words that are only met as a whole.
    """
    total = 0
    for c in word:
        total = (total * BASE + ord(c) + 1) % PRIME
    size = len(word)
    inverse = pow(BASE, -1, PRIME)
    # Of the rotation at i: the rest's value is the total's less the front's; END counts as 0 + 1.
    front, up, down = 0, 1, pow(BASE, size, PRIME)
    for i in range(size + 1):
        tail = (total - front * down) % PRIME  # word[i:]
        whole = ((tail * BASE + 1) * up + front) % PRIME
        yield _mark(whole, size + 1), False, False
        if i < size:
            down = down * inverse % PRIME
            if opened:
                after = (total - (front * BASE + ord(word[i]) + 1) * down) % PRIME  # word[i + 1:]
                skipped = ((after * BASE + 1) * up + front) % PRIME
                yield _mark(skipped, size), True, i == 0 or word[i] != word[i - 1]
            front = (front * BASE + ord(word[i]) + 1) % PRIME
            up = up * BASE % PRIME


def _mark(value: int, size: int) -> bytes:
    return b"\xff" + value.to_bytes(16, "big") + size.to_bytes(8, "big")  # no text starts like this


ROTATIONS = "key binary, id long, n long, kind int"
#: Kinds of a rotation: whole, skipping a character, skipping the first of a run.
CLOSED, OPEN, FIRST = 0, 1, 2


def _rotated(batches):
    kinds = (pa.binary(), pa.int64(), pa.int64(), pa.int32())
    names = [c.split()[0] for c in ROTATIONS.split(", ")]
    out: list[list] = [[] for _ in names]

    def flush():
        batch = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], names)
        for column in out:
            column.clear()
        return batch

    for batch in batches:
        for word, n, number in zip(*(batch.column(c).to_pylist() for c in ("word", "n", "id"))):
            sources = []
            if len(word) <= LONG:
                sources.append(rotations(word))
            if len(word) >= LONG:  # the longest of the short ones also meet the shortest of the long
                sources.append(hashed_rotations(word, len(word) > LONG))
            for source in sources:
                for key, opened, first in source:
                    out[0].append(key)
                    out[1].append(number)
                    out[2].append(n)
                    out[3].append(FIRST if first else OPEN if opened else CLOSED)
                    if len(out[0]) >= BATCH:
                        yield flush()
    if out[0]:
        yield flush()


NEAR = "id long, n_near long, best_n long, best long"


def neighbours(group: list[tuple[int, int, int]]) -> list[tuple[int, int, int, int]]:
    """(id, n_near, best_n, best) of the members (id, n, kind) of a group that have neighbours in it."""
    opened = [m for m in group if m[2] != CLOSED]
    closed = [m for m in group if m[2] == CLOSED]
    firsts = [m for m in opened if m[2] == FIRST]
    rank = lambda m: (-m[1], m[0])
    best = sorted(opened, key=rank)[:2]
    out = []
    for m in opened:
        near = len(opened) - 1
        choice = [x for x in best if x[0] != m[0]][:1]
        if m[2] == FIRST:
            near += len(closed)
            choice += closed
        if near:
            top = min(choice, key=rank)
            out.append((m[0], near, top[1], top[0]))
    if firsts:
        top = min(firsts, key=rank)
        out += [(m[0], len(firsts), top[1], top[0]) for m in closed]
    return out


def _scanned(batches):
    kinds = [pa.int64()] * 4
    names = [c.split()[0] for c in NEAR.split(", ")]
    key, group = None, []

    def batch_of(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    for batch in batches:  # sorted by key
        out = []
        columns = [batch.column(c).to_pylist() for c in ("key", "id", "n", "kind")]
        for k, *member in zip(*columns):
            if k != key:
                if len(group) > 1:
                    out += neighbours(group)
                key, group = k, []
            group.append(tuple(member))
        if out:
            yield batch_of(out)
    if len(group) > 1 and (out := neighbours(group)):
        yield batch_of(out)


def near_words(numbered: DataFrame) -> DataFrame:
    """id, n_near, best_n and best (the near word of largest n, then of smallest id) for words with
    neighbours; ``numbered`` has word, n and id, which rises with the word in code-point order."""
    found = (
        numbered.select("word", "n", "id").mapInArrow(_rotated, ROTATIONS)
        .repartitionByRange("key").sortWithinPartitions("key").mapInArrow(_scanned, NEAR)
    )
    best = F.max(F.struct("best_n", (-F.col("best")).alias("back")))
    return found.groupBy("id").agg(F.sum("n_near").alias("n_near"), best.alias("top")).select(
        "id", "n_near", F.col("top.best_n").alias("best_n"), (-F.col("top.back")).alias("best")
    )


def followed(steps: DataFrame) -> DataFrame:
    """id and root for (id, form) rows: where the forms lead in the end.

    Each round doubles the way that is followed. A form occurs twice as often as its word at least,
    so there is no circle, and a way has fewer steps than an occurrence number has bits.
    """
    ways = cut(steps.select("id", F.col("form").alias("root")))
    while True:
        onward = ways.select(F.col("id").alias("at"), F.col("root").alias("next"))
        longer = cut(
            ways.join(onward, F.col("root") == F.col("at"), "left").select(
                "id", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")
            )
        )
        ways = longer.select("id", "root")
        if longer.where("moved").isEmpty():
            return ways


def spelling_variants(words: DataFrame, least_ratio: int = 2) -> DataFrame:
    """word, form, root, n, n_near and form_n of each row of ``words`` (distinct word, n).

    Two words are near if they differ by one inserted, deleted or replaced code point. A word's form
    is its near word of largest n (ties: the smallest in code-point order), if that occurs ``least_ratio``
    times as often at least; its root is where forms lead in the end, itself if it has none. Words of
    any length and groups of any kind are treated whole. Null words take no part; an empty table gives
    an empty result.
    """
    if least_ratio < 2:
        raise ValueError("forms lead to more frequent words, twice as frequent at least")
    # Numbers that rise with the words: range-sorted, then counted on inside each partition.
    numbered = cut(
        words.where("word IS NOT NULL").select("word", "n").repartitionByRange("word")
        .sortWithinPartitions("word").withColumn("id", F.monotonically_increasing_id())
    )
    near = cut(near_words(numbered))
    known = numbered.join(near, "id", "left")
    formed = F.col("best_n") >= least_ratio * F.col("n")
    forms = cut(
        known.where(formed).select("id", F.col("best").alias("form"), F.col("best_n").alias("form_n"))
    )
    names = numbered.select("id", "word")
    led = forms.join(followed(forms), "id")
    led = led.join(names.select(F.col("id").alias("form"), F.col("word").alias("form_word")), "form").join(
        names.select(F.col("id").alias("root"), F.col("word").alias("root_word")), "root"
    )
    return known.join(led.select("id", "form_word", "root_word", "form_n"), "id", "left").select(
        "word", F.col("form_word").alias("form"), F.coalesce("root_word", "word").alias("root"), "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form_n",
    )
