"""Packing of token sequences by a configuration linear program over the length histogram.

The histogram has one count per length, so its size depends on the capacity alone. Lengths are grouped
by the unit above them. The linear program asks for as few sequences as possible, each filled by some
configuration (so many pieces of this group, so many of that), that together take all pieces.
Multiplicative weights solve it: a group weighs the more, the less of it is covered, and the next
configuration is the one of most weight that fits, found by dynamic programming over the capacity;
rounds go on until every group is covered. The solution, scaled to what there is, is rounded to whole sequences, so that their
sum falls behind the program's by less than one. A configuration takes the longest pieces of its groups,
and the last two so that they fill the room that rounding to units has left. What is left over is packed
best-fit decreasing, on counts too.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, bisect_right, insort
from collections import defaultdict
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ticketry.llm.common import cut, doc_id, keyed
from ticketry.llm.tokens import Encoder, default_path, portions

CAPACITY, END = 4096, 1
#: Step of the multiplicative weights, and units of the capacity that lengths are grouped by.
STEP, UNITS = 0.1, 256
#: Pieces under one part in SHORT of the capacity fill the room that is left.
SHORT = 32
#: Slices a length is numbered in, so that a frequent length is no single task.
SLICES = 256

PIECE = "__id long, __th long, piece int, start long, length long, ids_crc32 long"
Pattern = list[tuple[int, int]]


def _knapsack(sizes: np.ndarray, values: np.ndarray, capacity: int) -> Pattern:
    """The pieces of most value that fit, a size as often as it pays (dynamic programming)."""
    best = np.zeros(capacity + 1)
    taken = np.full(capacity + 1, -1)
    fits = np.searchsorted(sizes, np.arange(capacity + 1), side="right")
    for room in range(int(sizes[0]), capacity + 1):
        n = fits[room]
        worth = best[room - sizes[:n]] + values[:n]
        at = worth.argmax()
        if worth[at] > best[room - 1]:
            best[room], taken[room] = worth[at], at
        else:
            best[room] = best[room - 1]
    pattern: dict[int, int] = defaultdict(int)
    room = capacity
    while room > 0:
        if taken[room] < 0:
            room -= 1
            continue
        pattern[int(taken[room])] += 1
        room -= int(sizes[taken[room]])
    return sorted(pattern.items(), reverse=True)


def _weighted(sizes: np.ndarray, counts: np.ndarray, capacity: int) -> dict[tuple, float]:
    """Configurations and how often each is used, by multiplicative weights, until all is covered.

    Scaled so that no size is used more often than it is there; then all configurations have room.
    """
    covered = np.zeros(len(sizes))
    used: dict[tuple, float] = defaultdict(float)
    while (covered < 1).any():
        # A token is worth a token, the less the more of its size is covered already.
        weight = np.exp(-covered / STEP) * sizes
        pattern = _knapsack(sizes, weight / weight.max(), capacity)
        at, times = np.array(pattern).T
        amount = float((STEP * counts[at] / times).min())
        covered[at] += amount * times / counts[at]
        used[tuple(pattern)] += amount
    return {pattern: amount / covered.max() for pattern, amount in used.items()}


class _Stock:
    """Pieces that are left, by length."""

    def __init__(self, left: dict[int, int], unit: int):
        self.left, self.unit, self.lengths = left, unit, sorted(left)

    def _drop(self, length: int) -> None:
        del self.left[length]
        del self.lengths[bisect_left(self.lengths, length)]

    def down(self, most: int, least: int, taken: dict[int, int]):
        """Lengths in [least, most], the longest first, of which one more than ``taken`` is left."""
        at = bisect_right(self.lengths, most) - 1
        while at >= 0 and self.lengths[at] >= least:
            if self.left[self.lengths[at]] > taken.get(self.lengths[at], 0):
                yield self.lengths[at]
            at -= 1

    def filled(self, groups: list[int], capacity: int) -> Pattern | None:
        """A sequence of the longest pieces of the groups; the last two are those that fill it best, the
        last one of whatever group."""
        taken: dict[int, int] = {}
        room = capacity
        for group in groups[:-2]:
            found = next(self.down(min(room, group * self.unit), (group - 1) * self.unit + 1, taken), None)
            if found is None:
                return None
            taken[found] = taken.get(found, 0) + 1
            room -= found
        ends: list[list[int]] = []
        if len(groups) > 1:
            group = groups[-2]
            for first in self.down(min(room, group * self.unit), (group - 1) * self.unit + 1, taken):
                both = {**taken, first: taken.get(first, 0) + 1}
                ends += [[first, last] for last in islice(self.down(room - first, 1, both), 1)]
        else:
            ends = [[last] for last in islice(self.down(room, 1, taken), 1)]
        if not ends:
            return None
        for found in max(ends, key=sum):
            taken[found] = taken.get(found, 0) + 1
        return sorted(taken.items(), reverse=True)

    def take(self, pattern: Pattern, most: int) -> int:
        """How many sequences of the pattern there are, ``most`` at most; they are taken out."""
        times = min(most, *(self.left[length] // each for length, each in pattern))
        for length, each in pattern:
            self.left[length] -= each * times
            if not self.left[length]:
                self._drop(length)
        return times


def _rounded(
    chosen: dict[tuple, float], sizes: np.ndarray, stock: _Stock, capacity: int
) -> list[tuple[Pattern, int]]:
    """Whole sequences for the configurations: each gets what the sum so far is short of.

    A pattern is followed until one of its lengths is used up, so there are no more patterns than
    lengths and configurations.
    """
    begun: list[tuple[Pattern, int]] = []
    due, placed = 0.0, 0
    for configuration in sorted(chosen, key=lambda c: (-chosen[c], c)):
        due += chosen[configuration]
        groups = [int(sizes[at]) for at, each in configuration for _ in range(each)]
        while placed < int(due):
            pattern = stock.filled(groups, capacity)
            if pattern is None:  # longest pieces of one group have filled in for another
                placed = int(due)
                break
            times = stock.take(pattern, int(due) - placed)
            begun.append((pattern, times))
            placed += times
    return begun


def _best_fit(left: dict[int, int], capacity: int, begun: list[tuple[Pattern, int]]):
    """Best-fit decreasing, on counts, into the sequences begun and into new ones."""
    by_room: dict[int, list[tuple[Pattern, int]]] = defaultdict(list)
    rooms: list[int] = []

    def add(room: int, pattern: Pattern, times: int) -> None:
        if not by_room[room]:
            insort(rooms, room)
        by_room[room].append((pattern, times))

    for pattern, times in begun:
        add(capacity - sum(s * k for s, k in pattern), pattern, times)
    for size in sorted(left, reverse=True):
        n = left[size]
        while n:
            at = bisect_left(rooms, size)
            if at < len(rooms):
                room = rooms[at]
                pattern, times = by_room[room].pop()
                if not by_room[room]:
                    del rooms[at]
            else:
                room, pattern, times = capacity, [], -(-n // (capacity // size))
            each = min(room // size, n)
            used = min(times, n // each)
            if used < times:
                add(room, pattern, times - used)
            add(room - each * size, [*pattern, (size, each)], used)
            n -= used * each
    return [(p, t) for held in by_room.values() for p, t in held if p]


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[Pattern, int]]:
    """Patterns [(length, how many)] and how many sequences follow each; takes every piece once.

    Short pieces stay out of the program; they fill what room there is.
    """
    begun, rest = program(histogram, capacity)
    return _best_fit(rest, capacity, begun)


def program(histogram: dict[int, int], capacity: int = CAPACITY) -> tuple[list[tuple[Pattern, int]], dict[int, int]]:
    """The sequences of the configuration program, and the pieces they leave, by length."""
    left = {int(s): int(n) for s, n in histogram.items() if n}
    unit = max(1, capacity // UNITS)
    counts: dict[int, int] = defaultdict(int)
    for s, n in left.items():
        if s * SHORT > capacity:
            counts[-(-s // unit)] += n
    if not counts:
        return [], left
    sizes = np.array(sorted(counts))
    # A size is rounded up to its unit, the capacity to one unit more than it holds whole.
    units = -(-capacity // unit)
    chosen = _weighted(sizes, np.array([counts[g] for g in sizes.tolist()], float), units)
    stock = _Stock(left, unit)
    return _rounded(chosen, sizes, stock, capacity), stock.left


def _places(patterns: list[tuple[Pattern, int]]) -> np.ndarray:
    """Sorted rows (length, first ordinal, sequences, first sequence, offset) of the plan."""
    rows, next_of, base = [], defaultdict(int), 0
    for pattern, times in patterns:
        offset = 0
        for size, each in pattern:
            rows.append((size, next_of[size], times, base, offset))
            next_of[size] += each * times
            offset += size * each
        base += times
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


def _pieces(path: str, capacity: int):
    def run(batches):
        encode = Encoder(path)
        end = END.to_bytes(4, "little")
        for batch in batches:
            out = [[] for _ in range(6)]
            rows = zip(*(batch.column(c).to_pylist() for c in ("__id", "__th", "__text")))
            for some in portions(rows):
                for (key, th, _), ids in zip(some, encode.all([data for _, _, data in some])):
                    ids += end
                    for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                        part = ids[at : at + 4 * capacity]
                        row = (key, th, piece, at // 4, len(part) // 4, zlib.crc32(part))
                        for column, value in zip(out, row):
                            column.append(value)
            kinds = [pa.int64()] * 2 + [pa.int32()] + [pa.int64()] * 3
            yield pa.RecordBatch.from_arrays(
                list(map(pa.array, out, kinds)), [c.split()[0] for c in PIECE.split(", ")]
            )

    return run


def _assign(places: np.ndarray):
    keys = places[:, 0] << 44 | places[:, 1]

    def run(batches):
        for batch in batches:
            length = batch.column("length").to_numpy()
            ordinal = batch.column("ordinal").to_numpy()
            at = np.searchsorted(keys, length << 44 | ordinal, side="right") - 1
            _, first, times, base, offset = places[at].T
            copy, sequence = np.divmod(ordinal - first, times)
            columns = [batch.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")]
            columns += [pa.array(base + sequence), pa.array(offset + copy * length)]
            yield pa.RecordBatch.from_arrays(
                columns,
                ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
            )

    return run


def pack(documents: DataFrame, path: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id and offset of each piece.

    A row's ids are those of its text (null text: none) and the end id; more than ``capacity`` are
    cut into pieces of that many, the last may be shorter. No sequence is longer than
    ``capacity`` and none has a gap. Repeated rows and rows with a null doc_id are packed like
    others; an empty table gives an empty result.

    The driver holds the histogram and the plan, whose sizes depend on the capacity alone:
    ``capacity`` counts, and a pattern for each round and about two for each length.
    """
    path = path or default_path()
    pieces = cut(keyed(documents).mapInArrow(_pieces(path, capacity), PIECE))
    slot = F.pmod(F.xxhash64("__id", "__th", "piece"), F.lit(SLICES)).cast("int")
    pieces = pieces.withColumn("slice", slot)
    sizes = pieces.groupBy("length", "slice").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("slice").rowsBetween(
        Window.unboundedPreceding, -1
    )
    starts = sizes.select(
        "length", "slice", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first")
    )
    histogram = {r.length: r.n for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    places = _places(plan(histogram, capacity))
    inside = Window.partitionBy("length", "slice").orderBy("__id", "__th", "piece")
    numbered = (
        pieces.withColumn("inside", F.row_number().over(inside)).join(starts, ["length", "slice"])
        .withColumn("ordinal", F.col("first") + F.col("inside") - 1)
    )
    return numbered.select(doc_id(), "piece", "start", "length", "ids_crc32", "ordinal").mapInArrow(
        _assign(places),
        "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long",
    )
