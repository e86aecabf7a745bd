"""Substring dedup: Rabin-Karp hashes of token windows, counted in Spark.

A window is a run of words of one document, hashed by two rolling hashes (128 bits together). A
window that also starts in a document with a smaller id is removed, and what is removed merges into
maximal intervals.

Windows are counted without sending each of them through the shuffle:

1. Each window names an anchor, the smallest hash of a few words inside it; equal windows name equal
   anchors. Neighbours that name the same place are one run (about 22 windows). Runs whose
   anchor occurs in one document only hold no window of two documents and are done.
2. Runs that agree in all their words form one class. For every row of a class but those of its
   smallest id, all windows of the run are removed.
3. For those of the smallest id, it takes other classes of the same anchor: their windows are
   hashed, one run for a class, and the smallest id of each hash is counted.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketry.llm.common import cut, keyed, own_names, unknown
from ticketry.llm.rolling import minima, mixed, powers, windows

WINDOW = 50
#: Words of an anchor.
ANCHOR = 8
#: Rows handed over at a time.
HANDED = 1 << 16
BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


RUN = "anchor long, whole long, __id long, __th long, first long, last long"


def _runs(window: int, anchor: int):
    """Runs of windows that name the same anchor: a hash of the anchor and one of all their words."""

    def run(batches):
        up = down = np.empty(0, np.uint64)
        inverse = pow(BASES[1], -1, 1 << 64)
        for batch in batches:
            rows = zip(*(batch.column(c).to_pylist() for c in ("__id", "__th", "__text")))
            out = [[] for _ in range(6)]
            size = 0
            for doc, th, text in rows:
                words = text.encode().split()
                if len(words) < window:
                    continue
                hashes = word_hashes(words)
                if len(up) < len(hashes):
                    up, down = (powers(b, 2 * len(hashes)) for b in (BASES[1], inverse))
                sums = np.concatenate(
                    [np.zeros(1, np.uint64), np.cumsum(mixed(hashes) * up[: len(hashes)], dtype=np.uint64)]
                )
                grams = mixed(windows(hashes, anchor, BASES[0]))
                for at, places in minima(grams, window - anchor + 1):
                    edges = np.flatnonzero(np.diff(places)) + 1
                    first = np.concatenate([[0], edges]) + at
                    last = np.concatenate([edges - 1, [len(places) - 1]]) + at
                    places = places[first - at]
                    whole = (sums[last + window] - sums[first]) * down[first]
                    # Where the anchor lies, and how long the run is, belong to it.
                    form = (places - first) * 4096 + (last - first)
                    whole = mixed(whole + mixed(form.astype(np.uint64)))
                    n = len(first)
                    for column, values in zip(
                        out,
                        (
                            grams[places].view(np.int64), whole.view(np.int64), np.full(n, doc),
                            np.full(n, th), first, last,
                        ),
                    ):
                        column.append(values)
                    size += n
                if size > HANDED:
                    yield _batch(RUN, out)
                    out, size = [[] for _ in range(6)], 0
            if size:
                yield _batch(RUN, out)

    return run


def _batch(schema: str, columns: list[list[np.ndarray]]) -> pa.RecordBatch:
    names = [c.split()[0] for c in schema.split(", ")]
    arrays = [pa.array(np.concatenate(c).astype(np.int64)) for c in columns]
    return pa.RecordBatch.from_arrays(arrays, names)


WINDOWS = "anchor long, whole long, at long, least long, h1 long, h2 long"


def _hash_windows(window: int):
    """Both hashes of each window of the runs that stand for their classes."""

    def run(batches):
        for batch in batches:
            out, size = [[] for _ in range(6)], 0
            for text, runs in zip(batch.column("__text").to_pylist(), batch.column("runs")):
                values = word_hashes(text.encode().split())
                one = windows(values, window, BASES[0])
                two = windows(mixed(values), window, BASES[1])
                fields = [
                    runs.values.field(c).to_numpy() for c in ("anchor", "whole", "least", "first", "last")
                ]
                for anchor, whole, least, first, last in zip(*fields):
                    n = last - first + 1
                    for column, part in zip(
                        out,
                        (
                            np.full(n, anchor), np.full(n, whole), np.arange(n), np.full(n, least),
                            one[first : last + 1].view(np.int64), two[first : last + 1].view(np.int64),
                        ),
                    ):
                        column.append(part)
                    size += n
                if size > HANDED:
                    yield _batch(WINDOWS, out)
                    out, size = [[] for _ in range(6)], 0
            if size:
                yield _batch(WINDOWS, out)

    return run


def removed_windows(
    rows: DataFrame, window: int = WINDOW, anchor: int = ANCHOR
) -> DataFrame:
    """__id, __th and ``runs`` (array of first, last): windows to remove, by their first words.

    ``rows`` are ``keyed``; those without an id are left out: no id is smaller than theirs,
    and theirs is smaller than none.
    """
    # Named twice, once to count and once to keep what counts: a table of all runs is larger.
    runs = rows.where(~unknown()).mapInArrow(_runs(window, anchor), RUN)
    # Sides of joins are tables of their own, so that Spark can split a key with very many rows.
    shared = cut(
        runs.groupBy("anchor").agg(F.min("__id").alias("lo"), F.max("__id").alias("hi"))
        .where("lo < hi").select("anchor")
    )
    places = cut(runs.join(shared, "anchor"))
    kind = ["anchor", "whole"]
    at = F.struct("__id", "__th", "first", "last")
    classes = cut(places.groupBy(*kind).agg(F.min(at).alias("at"))).select(
        *kind, "at", F.col("at.__id").alias("least")
    )
    members = places.join(classes.select(*kind, "least"), kind)
    later = members.where(F.col("__id") > F.col("least")).select("__id", "__th", "first", "last")
    several = cut(
        classes.groupBy("anchor").agg(F.count("*").alias("m")).where("m > 1").select("anchor")
    )
    standing = (
        classes.join(several, "anchor")
        .groupBy(F.col("at.__id").alias("__id"), F.col("at.__th").alias("__th"))
        .agg(F.collect_list(F.struct(*kind, "least", "at.first", "at.last")).alias("runs"))
    )
    hashed = rows.join(standing, ["__id", "__th"]).mapInArrow(_hash_windows(window), WINDOWS)
    hashed = cut(hashed)
    counted = hashed.groupBy("h1", "h2").agg(
        F.min("least").alias("lo"), F.max("least").alias("hi")
    ).where("lo < hi").select("h1", "h2", "lo")
    early = hashed.join(cut(counted), ["h1", "h2"]).where("lo < least").select(
        *kind, "at"
    ).distinct()  # equal rows stand for a class more than once
    first_of_all = members.where(F.col("__id") == F.col("least")).join(early, kind).select(
        "__id", "__th", (F.col("first") + F.col("at")).alias("first"), (F.col("first") + F.col("at")).alias("last")
    )
    return later.unionByName(first_of_all).groupBy("__id", "__th").agg(
        F.collect_list(F.struct("first", "last")).alias("runs")
    )


def _intervals(runs, window: int) -> list[tuple[int, int]]:
    """Maximal runs of words covered by the windows."""
    if not runs.is_valid:
        return []
    first, last = (runs.values.field(c).to_numpy() for c in ("first", "last"))
    order = np.argsort(first, kind="stable")
    lows, highs = first[order], np.maximum.accumulate(last[order]) + window
    breaks = np.flatnonzero(lows[1:] > highs[:-1]) + 1
    starts = lows[np.concatenate([[0], breaks])].tolist()
    ends = highs[np.concatenate([breaks - 1, [len(highs) - 1]])].tolist()
    return list(zip(starts, ends))


#: A word of the rule, in text.
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _cut_out(window: int, layout: bool):
    def run(batches):
        for batch in batches:
            kept, spans, counts = [], [], []
            for text, found in zip(batch.column("__text").to_pylist(), batch.column("runs")):
                runs = _intervals(found, window)
                if not runs and layout:
                    kept.append(text)
                    counts.append(len(text.encode().split()))
                elif layout:
                    places = [m.span() for m in WORD.finditer(text)]
                    edges = [0, *(x for run in runs for x in run), len(places)]
                    pieces = zip(edges[::2], edges[1::2])
                    kept.append(" ".join(text[places[a][0] : places[b - 1][1]] for a, b in pieces if a < b))
                    counts.append(len(places))
                else:
                    words = text.encode().split()
                    counts.append(len(words))
                    for a, b in reversed(runs):
                        del words[a:b]
                    kept.append(b" ".join(words).decode())
                spans.append([{"start": a, "end": b} for a, b in runs])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("__id"), batch.column("__th"), pa.array(kept, pa.string()),
                    pa.array(counts, pa.int64()),
                    pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                ],
                ["__id", "__th", "kept", "n_words", "spans"],
            )

    return run


def substring_dedup(
    documents: DataFrame, window: int = WINDOW, anchor: int = ANCHOR, layout: bool = True
) -> DataFrame:
    """__id, __th, kept (text), n_words and spans (removed word intervals) of each row.

    A word goes if a window of ``window`` words covers it whose words also start in a document
    with a smaller doc_id; windows are judged on the input. Repeats inside one document, and
    rows that share a doc_id, don't count as smaller. Rows with a null id neither lose words nor
    cause a loss. Null text has no words. With ``layout`` the white space between kept words
    stays, else they are joined by one blank. Texts shorter than a window stay whole; an empty
    table gives an empty result; equal rows get equal results.
    """
    rows = keyed(documents)
    return rows.join(removed_windows(rows, window, anchor), ["__id", "__th"], "left").mapInArrow(
        _cut_out(window, layout),
        "__id long, __th long, kept string, n_words long, spans array<struct<start: long, end: long>>",
    )


@own_names("doc_id", "text", "n_chars")
def without_repeats(documents: DataFrame, window: int = WINDOW) -> DataFrame:
    """``documents`` with texts (and ``n_chars``, if there is one) that have lost their repeats.

    Rows stay, also those that lose all their words; a null text stays null.
    """
    found = substring_dedup(documents, window).where(F.size("spans") > 0)
    found = found.select("__id", "__th", F.col("kept").alias("__kept")).dropDuplicates(["__id", "__th"])
    rows = keyed(documents, *documents.columns).drop("__text")
    changed = {"text": F.coalesce("__kept", "text")}
    if "n_chars" in documents.columns:
        kind = documents.schema["n_chars"].dataType
        length = F.when(F.col("__kept").isNotNull(), F.length("__kept")).otherwise(F.col("n_chars"))
        changed["n_chars"] = length.cast(kind)
    return (
        rows.join(found, ["__id", "__th"], "left").withColumns(changed).select(*documents.columns)
    )
