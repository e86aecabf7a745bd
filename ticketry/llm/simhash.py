"""SimHash near-dedup by multi-index hashing.

Fingerprints of 64 bits are cut into two segments of 32. Of two that differ in at most three
bits, one segment differs in at most one: each fingerprint looks itself up under every value of
that small Hamming ball, and what a table holds there is verified over all bits.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketry.llm.common import cut, doc_id, keyed, own_names, unknown

BITS, SEGMENTS = 64, 2
WIDTH = BITS // SEGMENTS
#: A bucket with more fingerprints is looked up by the finer segments of the other half too.
WIDE_BUCKET = 256
#: Shingles hashed at a time, so that a very long text needs no more memory than a short one.
BLOCK = 1 << 14


def fingerprint(text: str, shingle: int = 3) -> int:
    """64-bit SimHash over word shingles: a bit is 1 if set in over half the hashes."""
    words = text.encode().lower().split()  # ASCII letters, ASCII blanks
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = (ends - np.fromiter(map(len, words), np.int64, len(words)) - 1).tolist()
    ends = (ends - 1).tolist()
    n = max(1, len(words) - shingle + 1)
    last = min(shingle, len(words)) - 1
    hashed = xxhash.xxh64_intdigest
    ones = np.zeros(BITS, np.int64)
    for at in range(0, n, BLOCK):
        h = np.array(
            [
                hashed(line[s:e], 42)
                for s, e in zip(starts[at : min(n, at + BLOCK)], ends[at + last :])
            ],
            np.uint64,
        )
        bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def _fingerprints(shingle: int):
    def run(batches):
        for batch in batches:
            marks = [fingerprint(t, shingle) for t in batch.column("__text").to_pylist()]
            marks = pa.array(np.array(marks, np.uint64).view(np.int64), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("__id"), batch.column("__th"), marks], ["__id", "__th", "fp"]
            )

    return run


def fingerprints(documents: DataFrame, shingle: int = 3) -> DataFrame:
    """__id, __th and fp (the fingerprint as a signed long) of each row."""
    return keyed(documents).mapInArrow(_fingerprints(shingle), "__id long, __th long, fp long")


def _part(column: str, segment: int, width: int = WIDTH):
    """The bits of one segment, as an unsigned number."""
    return F.shiftrightunsigned(F.col(column), segment * width).bitwiseAND((1 << width) - 1)


def links(distinct: DataFrame, max_bits: int = 3) -> DataFrame:
    """All pairs (a, b) of different fingerprints (column fp) at most ``max_bits`` apart.

    ``max_bits`` may be 3 or less. Pairs whose segments differ in one bit are found once, from
    the side where the bit is 0. Buckets with more than ``WIDE_BUCKET`` fingerprints (near
    copies share a segment) are dealt anew by the two 16-bit parts of the other half and their
    Hamming balls, so that no bucket's size is paid squared.
    """
    if not 0 <= max_bits < 2 * SEGMENTS:
        raise ValueError("two segments find pairs at up to 3 bits")
    table = distinct.select(
        "fp", F.posexplode(F.array(*[_part("fp", s) for s in range(SEGMENTS)])).alias("s", "v")
    )
    # A table of its own, so that Spark can split the rows that meet a hot value.
    sizes = cut(table.groupBy("s", "v").agg(F.count("*").alias("n")))
    bits = F.array(*[F.lit(1 << b).cast("long") for b in range(WIDTH)])
    raised = F.transform(
        F.filter(bits, lambda b: F.col("v").bitwiseAND(b) == 0), lambda b: F.col("v").bitwiseOR(b)
    )
    probes = table.select(
        F.col("fp").alias("a"), "s", F.col("v").alias("from"),
        F.explode(F.concat(F.array("v"), raised)).alias("v"),
    )
    # Only values that some fingerprint holds are worth a look.
    hits = probes.join(sizes, ["s", "v"])
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits
    # Found from both sides where the segments are equal: one is enough.
    once = (F.col("v") != F.col("from")) | (F.col("a") < F.col("b"))
    held = table.join(sizes, ["s", "v"]).withColumnRenamed("fp", "b")
    small = (
        hits.where(F.col("n") <= WIDE_BUCKET)
        .join(held.where(F.col("n") <= WIDE_BUCKET).drop("n"), ["s", "v"])
        .where(once & near)
    )
    half = lambda c: F.when(F.col("s") == 0, _part(c, 1)).otherwise(_part(c, 0))
    fine = WIDTH // 2
    part = lambda c: F.posexplode(
        F.array(*[_part(c, s, fine) for s in range(2)])
    )
    flips = F.array(F.lit(0).cast("long"), *[F.lit(1 << b).cast("long") for b in range(fine)])
    wide_table = held.where(F.col("n") > WIDE_BUCKET).withColumn("h", half("b")).select(
        "s", "v", "b", part("h").alias("t", "w")
    )
    wide_probes = (
        hits.where(F.col("n") > WIDE_BUCKET)
        .withColumn("h", half("a"))
        .select("s", "v", "from", "a", part("h").alias("t", "w"))
        .withColumn("w", F.explode(F.transform(flips, lambda f: F.col("w").bitwiseXOR(f))))
    )
    wide = wide_probes.join(wide_table, ["s", "v", "t", "w"]).where(once & near)
    return small.select("a", "b").unionByName(wide.select("a", "b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """node and root (the smallest node it hangs together with) for nodes that have an edge.

    Large and small stars in turn (Kiveris et al. 2014) until the edges stand still; a hot
    centre is met by aggregates and by joins with one row per node, which Spark can split.
    """
    edges = cut(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")))
    state = None
    while True:
        both = edges.union(edges.select(F.col("b"), F.col("a")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = (
            both.join(least, "a").where(F.col("b") > F.col("a"))
            .select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        )
        large = cut(large)
        lower = large.groupBy("a").agg(F.min("b").alias("m"))
        joined = large.join(lower, "a")
        small = (
            joined.where(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
            .union(lower.select("a", F.col("m").alias("b"))).distinct()
        )
        edges = cut(small)
        now = edges.agg(
            F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        ).first()
        if now == state:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        state = now


def near_duplicates(documents: DataFrame, shingle: int = 3, max_bits: int = 3) -> DataFrame:
    """__id, __th, fp, root (names the component by a fingerprint) and component_id.

    Texts are lower-cased in A-Z and cut into words at ASCII white space; a text with fewer
    words than a shingle is one shingle, an empty or null text has fingerprint 0, which links
    like any other. Rows whose fingerprints differ in at most ``max_bits`` bits hang together;
    component_id is the smallest doc_id reached (null ids are passed over; null if there is no
    other). Equal rows get equal results; an empty table gives an empty result.
    """
    rows = cut(fingerprints(documents, shingle))
    distinct = rows.groupBy("fp").agg(F.min(doc_id()).alias("least"))
    roots = components(links(distinct.select("fp"), max_bits))
    named = distinct.join(roots, distinct["fp"] == roots["node"], "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    named = cut(named)
    smallest = named.groupBy("root").agg(F.min("least").alias("component_id"))
    by_mark = named.join(smallest, "root").select("fp", "root", "component_id")
    return rows.join(by_mark, "fp").select("__id", "__th", "fp", "root", "component_id")


@own_names("doc_id", "text")
def one_of_each(documents: DataFrame, shingle: int = 3, max_bits: int = 3) -> DataFrame:
    """The rows of ``documents`` that stay: of each component the one with the smallest id.

    Ties (repeated or null ids) go to the smaller text hash; of equal rows one stays.
    """
    found = near_duplicates(documents, shingle, max_bits)
    first = F.min(F.struct(unknown().alias("u"), "__id", "__th"))
    stay = found.groupBy("root").agg(first.alias("row")).select(
        F.col("row.__id").alias("__id"), F.col("row.__th").alias("__th")
    ).distinct()
    marked = keyed(documents, *documents.columns).drop("__text")
    return (
        marked.join(stay, ["__id", "__th"], "left_semi")
        .dropDuplicates(["__id", "__th"]).select(*documents.columns)
    )
