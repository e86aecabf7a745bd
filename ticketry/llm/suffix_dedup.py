"""Removal of repeated byte strings by prefix-free parsing.

A rolling hash over the bytes sets triggers: of every ``SPAN`` window ends, the smallest hash.
Triggers cut the texts into phrases, the same in every copy of a passage (``_phrases``). A string
of ``length`` bytes that starts inside a phrase is a suffix of that phrase (dictionary side) followed
by the bytes after the trigger (parse side). Strings that are equal have their trigger at the
same place, so what is equal meets under the bytes around the trigger (``centre``):

1. Phrase occurrences are counted by centre; those whose centre occurs once hold no repeat.
2. Occurrences that agree in all bytes their strings reach form one class. A class of two or
   more is repeated as a whole; for the rest of the corpus one representative stands for it.
3. Classes of one centre are put in corpus order: a suffix array of the dictionary side (bytes
   read backwards) and one of the parse side, each with its common-prefix lengths. Two strings
   of trigger distance d are equal if neither array has a shorter common prefix between them.
4. Centres with very many classes are split exactly: each string of them is hashed and counted.

The order is kept inside each class, never as one array, so no step holds the corpus.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketry.llm.common import cut, keyed
from ticketry.llm.rolling import minima, mixed

LENGTH = 400
#: Bytes of a trigger, and how far the end of a string's trigger lies from its start at most.
TRIGGER, SPAN = 8, 128
#: Classes of one centre that are ordered in memory; beyond it strings are counted one by one.
ORDERED = 4096
#: A class of more places is met by parts, so that no task has it alone.
HEAVY, PARTS = 4096, 64
#: Classes gathered before a batch of centres is ordered.
GATHERED = 16384


def _phrases(data: bytes, length: int):
    """Blocks of (end of trigger, first start, last start) of strings that share a trigger."""
    if len(data) < length:
        return
    grams = np.ndarray(len(data) - TRIGGER + 1, "<u8", data, 0, (1,))
    ends = len(data) - length + SPAN  # a string's triggers lie in its first SPAN bytes
    grams = mixed(np.ascontiguousarray(grams[: ends - TRIGGER + 1]))
    for at, places in minima(grams, SPAN - TRIGGER + 1):
        edges = np.flatnonzero(np.diff(places)) + 1
        first = np.concatenate([[0], edges])
        last = np.concatenate([edges - 1, [len(places) - 1]])
        yield places[first] + TRIGGER, first + at, last + at


def _keys(batch: pa.RecordBatch):
    """(__id, __th) of each row. Texts are taken out one at a time: a batch of them is large."""
    return zip(batch.column("__id").to_pylist(), batch.column("__th").to_pylist())


def _occurrences(length: int):
    tail = length - SPAN

    def run(batches):
        digest = xxhash.xxh3_64_intdigest
        for batch in batches:
            texts = batch.column("__text")
            for i, (doc, th) in enumerate(_keys(batch)):
                data = texts[i].as_buffer().to_pybytes()
                for ends, first, last in _phrases(data, length):
                    far, near = ends - first, ends - last
                    n = len(ends)
                    b, lo, hi = ends.tolist(), first.tolist(), last.tolist()
                    centre = np.array([digest(data[e - TRIGGER : e + tail]) for e in b], np.uint64)
                    whole = np.array(
                        [digest(data[s : t + length]) for s, t in zip(lo, hi)], np.uint64
                    )
                    whole = mixed(whole + (far * SPAN * 2 + near).astype(np.uint64))
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(centre.view(np.int64)), pa.array(whole.view(np.int64)),
                            pa.array(np.full(n, doc)), pa.array(np.full(n, th)),
                            pa.array(ends.astype(np.int64)),
                            pa.array((far * 1024 + near).astype(np.int32)),
                        ],
                        ["centre", "whole", "__id", "__th", "b", "reach"],
                    )

    return run


OCCURRENCE = "centre long, whole long, __id long, __th long, b long, reach int"


def _sides(length: int):
    """Adds the bytes of the dictionary side (backwards) and of the parse side to each place."""
    tail = length - SPAN

    def run(batches):
        for batch in batches:
            out = [[] for _ in range(9)]
            texts, lists = batch.column("__text"), batch.column("places")
            for i, (doc, th) in enumerate(_keys(batch)):
                data = texts[i].as_buffer().to_pybytes()
                for place in lists[i].as_py():
                    b, far, near = place["b"], place["reach"] // 1024, place["reach"] % 1024
                    left = data[b - far : b - TRIGGER][::-1]
                    right = data[b + tail : b - near + length]
                    row = (
                        place["centre"], place["n"], place["m"], doc, th, b, place["reach"],
                        left, right,
                    )
                    for column, value in zip(out, row):
                        column.append(value)
                if len(out[0]) > 50_000:
                    yield _side_batch(out)
                    out = [[] for _ in range(9)]
            if out[0]:
                yield _side_batch(out)

    return run


SIDES = (
    "centre long, n long, m long, __id long, __th long, b long, reach int,"
    " before binary, after binary"
)


def _side_batch(out):
    kinds = [pa.int64()] * 6 + [pa.int32(), pa.binary(), pa.binary()]
    names = [c.split()[0] for c in SIDES.split(",")]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], names)


def _ordered(groups: list[int], strings: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Suffix order of the strings inside their groups, and the common prefix with the one before."""
    order = sorted(range(len(strings)), key=lambda i: (groups[i], strings[i]))
    width = max(1, max(map(len, strings), default=0))
    lengths = np.array([len(strings[i]) for i in order])
    table = np.frombuffer(b"".join(strings[i].ljust(width, b"\0") for i in order), np.uint8)
    table = table.reshape(-1, width)
    common = np.zeros(len(order), np.int64)
    if len(order) > 1:
        differ = table[1:] != table[:-1]
        shared = np.where(differ.any(axis=1), differ.argmax(axis=1), width)
        common[1:] = np.minimum(shared, np.minimum(lengths[1:], lengths[:-1]))
        place = np.array([groups[i] for i in order])
        common[1:][place[1:] != place[:-1]] = -1
    common[:1] = -1
    return np.array(order), common


def _repeats(rows: list[tuple], length: int):
    """For classes (centre, n, far, near, before, after): (row, trigger distance) of repeats."""
    groups = [r[0] for r in rows]
    weight, far, near = (np.array([r[i] for r in rows]) for i in (1, 2, 3))
    orders = [_ordered(groups, [r[i] for r in rows]) for i in (4, 5)]
    for d in range(int(near.min()), int(far.max()) + 1):
        names = []
        for (order, common), need in zip(orders, (d - TRIGGER, SPAN - d)):
            name = np.empty(len(rows), np.int64)
            name[order] = np.cumsum(common < need)
            names.append(name)
        members = np.flatnonzero((near <= d) & (d <= far))
        if not len(members):
            continue
        _, same = np.unique(
            names[0][members] * (len(rows) + 1) + names[1][members], return_inverse=True
        )
        times = np.bincount(same, weights=weight[members])
        found = members[(times[same] >= 2) & (weight[members] == 1)]
        if len(found):
            yield d, found


def _order_classes(length: int):
    def ordered(rows):
        classes = [(r[0], r[1], r[5] // 1024, r[5] % 1024, r[6], r[7]) for r in rows]
        out = [[] for _ in range(4)]
        for d, found in _repeats(classes, length):
            for i in found.tolist():
                start = rows[i][4] - d
                for column, value in zip(out, (rows[i][2], rows[i][3], start, start + length)):
                    column.append(value)
        return pa.RecordBatch.from_arrays(
            [pa.array(c, pa.int64()) for c in out], ["__id", "__th", "start", "end"]
        )

    columns = ("centre", "n", "__id", "__th", "b", "reach", "before", "after")

    def run(batches):
        held: list[tuple] = []
        for batch in batches:  # sorted by centre
            for row in zip(*(batch.column(c).to_pylist() for c in columns)):
                if len(held) >= GATHERED and row[0] != held[-1][0]:
                    yield ordered(held)
                    held = []
                held.append(row)
        if held:
            yield ordered(held)

    return run


def _hash_strings(length: int):
    """One row per string of a class: its hash, its trigger distance and its place."""

    def run(batches):
        digest = xxhash.xxh3_64_intdigest
        columns = ("centre", "n", "__id", "__th", "b", "reach", "before", "after")
        for batch in batches:
            out = [[] for _ in range(7)]
            for centre, n, doc, th, b, reach, before, after in zip(
                *(batch.column(c).to_pylist() for c in columns)
            ):
                for d in range(reach % 1024, reach // 1024 + 1):
                    # The two sides have fixed lengths at each distance, so they can't run together.
                    value = digest(before[: d - TRIGGER] + after[: SPAN - d], d)
                    value -= (value >> 63) << 64
                    for column, x in zip(out, (centre, value, d, n, doc, th, b - d)):
                        column.append(x)
                if len(out[0]) > 100_000:
                    yield _string_batch(out)
                    out = [[] for _ in range(7)]
            yield _string_batch(out)

    return run


STRING = "centre long, string long, d long, n long, __id long, __th long, start long"


def _string_batch(out):
    names = [c.split()[0] for c in STRING.split(",")]
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], names)


def repeated_spans(rows: DataFrame, length: int = LENGTH) -> DataFrame:
    """__id, __th and ``spans`` (array of start, end): bytes of strings that occur elsewhere too.

    ``rows`` are ``keyed``.
    """
    if length < 2 * SPAN:
        raise ValueError(f"strings have to be of {2 * SPAN} bytes or more")
    all_places = rows.mapInArrow(_occurrences(length), OCCURRENCE)
    # Sides of joins are tables of their own, so that Spark can split a key with very many rows.
    twice = all_places.groupBy("centre").agg(F.count("*").alias("n")).where("n > 1")
    places = cut(all_places.join(cut(twice.select("centre")), "centre"))
    classes = cut(
        places.groupBy("centre", "whole").agg(
            F.count("*").alias("n"), F.min(F.struct("__id", "__th", "b", "reach")).alias("at")
        )
    )
    many = cut(classes.groupBy("centre").agg(F.count("*").alias("m")).where("m > 1"))
    # A heavy class is dealt to parts: one row in HEAVY at most is such a class, so its rows for all
    # parts are few against the places. What is left has no key with more than HEAVY rows.
    heavy = cut(
        classes.where(F.col("n") > HEAVY)
        .select("centre", "whole", F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1))).alias("part"))
    )
    dealt = places.withColumn("part", F.pmod(F.xxhash64("__id", "__th", "b"), F.lit(PARTS)).cast("int"))
    light = classes.where(F.col("n").between(2, HEAVY)).select("centre", "whole", F.lit(True).alias("twice"))
    marked = dealt.join(heavy.withColumn("hot", F.lit(True)), ["centre", "whole", "part"], "left")
    # Heavy rows need no second look: they go along under their part, not under their class.
    marked = marked.withColumn("whole", F.when(F.col("hot"), F.xxhash64("part")).otherwise(F.col("whole")))
    whole = marked.join(light, ["centre", "whole"], "left").where("hot OR twice")
    spans = whole.select(
        "__id", "__th",
        (F.col("b") - F.expr("reach div 1024")).alias("start"),
        (F.col("b") - F.col("reach") % 1024 + length).alias("end"),
    )
    open_classes = (
        classes.join(many, "centre")
        .select("at.*", F.struct("centre", "n", "m", "at.b", "at.reach").alias("place"))
        .groupBy("__id", "__th").agg(F.collect_list("place").alias("places"))
    )
    sides = rows.join(open_classes, ["__id", "__th"]).mapInArrow(_sides(length), SIDES)
    # Copies of one row are one place of a class each; the class has been counted already. A run of
    # strings that goes over a block edge of ``minima`` is two places, told apart by their reach.
    sides = cut(sides.dropDuplicates(["centre", "__id", "__th", "b", "reach"]))
    span = "__id long, __th long, start long, end long"
    ordered = (
        sides.where(F.col("m") <= ORDERED).repartition("centre").sortWithinPartitions("centre")
        .mapInArrow(_order_classes(length), span)
    )
    strings = sides.where(F.col("m") > ORDERED).mapInArrow(_hash_strings(length), STRING)
    key = ["centre", "d", "string"]
    repeated = strings.groupBy(*key).agg(F.sum("n").alias("times")).where("times > 1")
    counted = strings.where("n = 1").join(cut(repeated.select(*key)), key).select(
        "__id", "__th", "start", (F.col("start") + length).alias("end")
    )
    return (
        spans.unionByName(ordered).unionByName(counted)
        .groupBy("__id", "__th").agg(F.collect_list(F.struct("start", "end")).alias("spans"))
    )


def _cut_bytes():
    def run(batches):
        for batch in batches:
            out = [[] for _ in range(3)]
            # One text at a time as well; what is kept of a batch is no larger than the batch.
            for text, spans in zip(batch.column("__text"), batch.column("spans")):
                data = text.as_buffer().to_pybytes()
                runs, kept, at = [], [], 0
                if spans.is_valid:
                    starts = spans.values.field("start").to_numpy()
                    ends = spans.values.field("end").to_numpy()
                    order = np.argsort(starts, kind="stable")
                    starts, ends = starts[order], np.maximum.accumulate(ends[order])
                    breaks = np.flatnonzero(starts[1:] > ends[:-1]) + 1
                    lows = starts[np.concatenate([[0], breaks])].tolist()
                    highs = ends[np.concatenate([breaks - 1, [len(ends) - 1]])].tolist()
                    runs = list(zip(lows, highs))
                for low, high in runs:
                    kept.append(data[at:low])
                    at = high
                kept.append(data[at:])
                for column, value in zip(
                    out,
                    (len(data), [{"start": a, "end": b} for a, b in runs], b"".join(kept)),
                ):
                    column.append(value)
            span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("__id"), batch.column("__th"), pa.array(out[0], pa.int64()),
                    pa.array(out[1], span), pa.array(out[2], pa.binary()),
                ],
                ["__id", "__th", "n_bytes", "spans", "kept"],
            )

    return run


def suffix_dedup(documents: DataFrame, length: int = LENGTH) -> DataFrame:
    """__id, __th, n_bytes, spans (maximal removed runs) and kept (bytes) of each row.

    A text is its UTF-8 bytes, null text is empty. A byte goes if a string of ``length`` bytes covers
    it that starts at another place too, of the same or another row; strings don't cross rows,
    may overlap, and are judged on the input. What is kept may cut through a character, so it is
    binary. Equal rows are copies of each other and lose the same bytes. Texts shorter than
    ``length`` stay whole; an empty table gives an empty result.
    """
    rows = keyed(documents)
    return rows.join(repeated_spans(rows, length), ["__id", "__th"], "left").mapInArrow(
        _cut_bytes(),
        "__id long, __th long, n_bytes long, spans array<struct<start: long, end: long>>, kept binary",
    )
