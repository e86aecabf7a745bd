"""Sharding by a hierarchical weighted hash tree, in DataFrame functions only.

Shards are leaves of a tree of regions and racks. A document descends level by level: each child
draws u in (0, 1) from the hash of document and child, and the child with the smallest
-ln(u) / weight takes it, so that children are chosen in proportion to their weights. A child whose
weight grows only gains documents, a sibling whose weight stays only loses some to it: movement is
confined to the subtrees whose weights change. A new shard that opens a region of its own takes
documents only into itself.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Slices a shard's slots are numbered in, so that no shard is a single task.
SLICES = 1024
#: Hash digits of a draw (52 bits, exact in a double).
DIGITS = 13


@dataclass(frozen=True)
class Shard:
    region: int
    rack: int
    shard: int
    weight: int = 1


#: Two regions of two racks of two shards; the grown tree opens a third region.
TREE = tuple(Shard(s // 4, s // 2, s) for s in range(8))
GROWN = (*TREE, Shard(2, 4, 8))


def _children(tree: tuple[Shard, ...], level: str) -> dict[int, int]:
    """Weight of each node of a level: the sum over its shards."""
    weights: dict[int, int] = {}
    for shard in tree:
        weights[getattr(shard, level)] = weights.get(getattr(shard, level), 0) + shard.weight
    return weights


def draw(key: Column, node: str) -> Column:
    """-ln(u) of the document at a node, u in (0, 1) by its hash."""
    digits = F.substring(F.md5(F.concat(key, F.lit(f"/{node}"))), 1, DIGITS)
    u = (F.conv(digits, 16, 10).cast("double") + 0.5) / float(16**DIGITS)
    return -F.ln(u)


def _choose(key: Column, level: str, weights: dict[int, int]) -> Column:
    """The child with the least draw over weight; ties to the smaller number."""
    if len(weights) == 1:
        return F.lit(next(iter(weights)))
    offers = [
        F.struct((draw(key, f"{level} {n}") / float(w)).alias("d"), F.lit(n).alias("n"))
        for n, w in sorted(weights.items())
    ]
    return F.least(*offers)["n"]


def place(key: Column, tree: tuple[Shard, ...]) -> Column:
    """The shard a document comes to, level by level."""

    def below(shards: tuple[Shard, ...], levels: tuple[str, ...]) -> Column:
        level, rest = levels[0], levels[1:]
        weights = _children(shards, level)
        chosen = _choose(key, level, weights)
        if not rest:
            return chosen
        cases = [
            (n, below(tuple(s for s in shards if getattr(s, level) == n), rest)) for n in sorted(weights)
        ]
        return reduce(
            lambda out, case: F.when(chosen == case[0], case[1]).otherwise(out),
            cases[:-1], cases[-1][1],
        )

    return below(tree, ("region", "rack", "shard"))


def key_of(documents: DataFrame) -> Column:
    """What decides: the id; without one the text's hash, so that such rows spread too."""
    text = F.coalesce(documents["text"], F.lit(""))
    return F.coalesce(documents["doc_id"].cast("string"), F.concat(F.lit("text "), F.md5(text)))


def shard(
    documents: DataFrame, tree: tuple[Shard, ...] = TREE, grown: tuple[Shard, ...] = GROWN
) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot and grown_shard of each row.

    The law is ``key``: the id and the tree decide; with ``grown``, whose new shard is a region of
    its own, rows move only into the new shard. ``size`` is the UTF-8 bytes of the text (null: none)
    plus 1; slots count each shard's rows from 0 without gaps, in the order of hash slice, id and
    text. Repeated rows share a shard and have slots of their own; rows with a null id are placed by
    their text. An empty table gives an empty result.

    Texts stay where they are: what is shuffled is a few numbers a row. A shard's slots are numbered
    slice by slice, each slice starting where those before it end.
    """
    text = F.coalesce(documents["text"], F.lit(""))
    key = key_of(documents)
    rows = documents.select(
        documents["doc_id"].cast("long").alias("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        key.alias("key"),
    ).select(
        "*", place(F.col("key"), tree).alias("shard"), place(F.col("key"), grown).alias("grown_shard"),
        F.pmod(F.crc32(F.col("key").cast("binary")), F.lit(SLICES)).cast("int").alias("slice"),
    )
    sizes = rows.groupBy("shard", "slice").agg(F.count("*").alias("n"))
    ahead = Window.partitionBy("shard").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        "shard", "slice", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("first")
    )
    inside = Window.partitionBy("shard", "slice").orderBy("doc_id", "key", "text_crc32", "size")
    return (
        rows.withColumn("inside", F.row_number().over(inside))
        .join(starts, ["shard", "slice"])
        .select(
            "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard",
            (F.col("first") + F.col("inside") - 1).cast("long").alias("slot"), "grown_shard",
        )
    )
