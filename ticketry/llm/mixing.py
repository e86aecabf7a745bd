"""Mixing sources to target weights along a curriculum, in DataFrame functions only.

Each source has a target (its weight's share of all words, at most ``repeats`` times what it has)
and a schedule: its weight over training time, linear between knots. The integral of the schedule is
the source's cumulative demand for words. A source's documents stand in a line by the hash of their
ids, epoch after epoch; a copy that starts after c words is read when the demand has come to c, which
the inverse of the integral tells. Sorted by that time, the copies are the curriculum: at each time
the sources stand in proportion to targets times schedules.

What is shuffled is a few numbers a row; texts stay where they are. The line of a source is summed
slice by slice, so that a hot source is many tasks.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import inf

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ticketry.llm.common import cut

#: Sources by code point weigh in turn; the k-th of them follows the k-th schedule, in turn too.
WEIGHTS = (1, 2, 3)
#: (time, weight) knots: light sources fade out, the next stay, heavy ones come in late.
SCHEDULES = (
    ((0.0, 1.5), (0.5, 1.0), (1.0, 0.25)),
    ((0.0, 1.0), (1.0, 1.0)),
    ((0.0, 0.25), (0.5, 0.75), (0.75, 1.5), (1.0, 2.0)),
)
#: A source gives at most so many times the words it has.
REPEATS = 3
#: Hash digits that name a slice of a source's line (16**3 slices).
SLICE_DIGITS = 3

Knots = Sequence[tuple[float, float]]


def _checked(knots: Knots) -> Knots:
    times = [t for t, _ in knots]
    if times[0] != 0 or times[-1] != 1 or any(b <= a for a, b in zip(times, times[1:])):
        raise ValueError("the knots of a schedule run from time 0 to time 1")
    if min(w for _, w in knots) < 0 or not 0 < max(w for _, w in knots) < inf:
        raise ValueError("the weights of a schedule are finite, not negative, and not all zero")
    return knots


def areas(knots: Knots) -> list[tuple[float, float, float, float, float]]:
    """(area before, area up to the end, start, weight there, slope) of each linear segment; in all 1."""
    knots = _checked(knots)
    total = sum((b - a) * (u + v) / 2 for (a, u), (b, v) in zip(knots, knots[1:]))
    out, before = [], 0.0
    for (a, u), (b, v) in zip(knots, knots[1:]):
        after = before + (b - a) * (u + v) / 2 / total
        out.append((before, after, a, u / total, (v - u) / (b - a) / total))
        before = after
    return out


def inverted(demand: Column, knots: Knots) -> Column:
    """The time at which the integral of the schedule (1 in all) comes to ``demand``."""
    found = F.lit(1.0)
    for before, after, start, weight, slope in reversed(areas(knots)):
        x = F.greatest(demand - F.lit(before), F.lit(0.0))
        # The root of weight * u + slope / 2 * u^2 = x, in the form that bears a slope of zero.
        root = F.sqrt(F.greatest(F.lit(weight * weight) + F.lit(2 * slope) * x, F.lit(0.0)))
        u = F.when(x > 0, F.lit(2.0) * x / (F.lit(weight) + root)).otherwise(0.0)
        found = F.when(demand < F.lit(after), F.lit(start) + u).otherwise(found)
    return F.least(found, F.lit(1.0))


def targets(
    sizes: DataFrame, weights: Sequence[int] = WEIGHTS, repeats: int = REPEATS
) -> DataFrame:
    """Adds ``rank`` (by code point, null last), ``weight`` and ``target`` to one row per source.

    ``sizes`` has ``source`` and ``source_size``. The targets share all words by weight; one that
    comes above ``repeats`` times its source's size stops there, and the others share the excess by
    weight until none is above. In the order of size over weight, the sources that stop are a prefix:
    the least one of all is full exactly if its share of what is left is more than it has.
    The table has a row per source, and is ordered as a whole.
    """
    by_name = Window.orderBy(F.col("source").isNull(), "source")
    ranked = sizes.withColumn("rank", F.row_number().over(by_name) - 1).withColumn(
        "weight", F.element_at(F.array(*[F.lit(int(w)) for w in weights]), F.col("rank") % len(weights) + 1)
    )
    fill = Window.orderBy(F.col("source_size") / F.col("weight"), "rank")
    before, every = fill.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    full = F.col("source_size") * repeats
    rest = F.sum("source_size").over(every) - F.coalesce(F.sum(full).over(before), F.lit(0))
    heavy = F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    level = ranked.withColumns({"full": full, "rest": rest, "heavy": heavy}).withColumn(
        "stops",
        F.col("rest").cast("double") * F.col("weight") > F.col("full").cast("double") * F.col("heavy"),
    )
    # The first source that doesn't stop sets the level for all behind it.
    first = F.min(F.when(~F.col("stops"), F.struct(F.col("source_size") / F.col("weight"), "rank", "rest", "heavy")))
    level = level.withColumn("first", first.over(every))
    return level.select(
        "source", "source_size", "rank", "weight",
        F.when(F.col("stops"), F.col("full").cast("double"))
        .otherwise(F.col("first.rest").cast("double") * F.col("weight") / F.col("first.heavy"))
        .alias("target"),
    )


def mix(
    documents: DataFrame, weights: Sequence[int] = WEIGHTS, repeats: int = REPEATS,
    schedules: Sequence[Knots] = SCHEDULES,
) -> DataFrame:
    """doc_id, source, size, source_size, target and ``copies`` (epoch, words, position) of each row.

    ``size`` is the number of words (runs without ASCII white space) of the whole text. The mix takes
    each source's target, rounded down: whole epochs of the source, then a part of one, in which the
    document at the end gives its first words only. So the words taken from a source differ from its
    target by less than one, and no document gives more than ``repeats`` times its size. ``position``
    is the training time in [0, 1] at which a copy starts. Documents that give nothing have no copies.

    Null texts have no words, null sources are one source, and one that comes last. Rows with a null
    id stand by the hash of their text; equal rows stand side by side. An empty table gives an
    empty result. Reruns agree: the line depends on ids and texts alone.
    """
    if min(weights) <= 0 or repeats < 1:
        raise ValueError("weights are positive, and a source is read once at least")
    text = F.coalesce(documents["text"], F.lit(""))
    key = F.coalesce(documents["doc_id"].cast("string"), F.concat(F.lit("text "), F.md5(text)))
    rows = documents.select(
        documents["doc_id"].cast("long").alias("doc_id"),
        documents["source"].cast("string").alias("source"),
        F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+")).cast("long").alias("size"),
        F.md5(key).alias("place"),
    )
    # A few numbers a row, read by the two branches below.
    rows = cut(rows.withColumn("slice", F.left("place", F.lit(SLICE_DIGITS))))
    slices = rows.groupBy("source", "slice").agg(F.sum("size").alias("n"))
    ahead = Window.partitionBy("source").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = slices.withColumn("ahead", F.coalesce(F.sum("n").over(ahead), F.lit(0)))
    sources = targets(
        slices.groupBy("source").agg(F.sum("n").alias("source_size")), weights, repeats
    )
    # A row per source and slice: as a written table Spark knows its size, and sends it to the rows
    # if it is small. Otherwise a hot source is still as many keys as slices.
    starts = cut(
        starts.join(
            sources.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of"))
        ).select(
            F.col("source").alias("of"), F.col("slice").alias("part"), "ahead", "source_size", "target", "rank",
            F.floor("target").alias("budget"),
        )
    )
    inside = Window.partitionBy("source", "slice").orderBy("place", "size").rowsBetween(
        Window.unboundedPreceding, -1
    )
    line = rows.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0))).join(
        starts, (F.col("slice") == F.col("part")) & F.col("source").eqNullSafe(F.col("of"))
    )
    at = (F.col("ahead") + F.col("inside")).cast("long")
    line = line.withColumn("at", at)
    follows = F.col("rank") % len(schedules)

    def copy(epoch: int) -> Column:
        start = F.lit(epoch) * F.col("source_size") + F.col("at")
        words = F.least(F.col("budget") - start, F.col("size"))
        demand = start.cast("double") / F.greatest(F.col("budget"), F.lit(1)).cast("double")
        position = inverted(demand, schedules[-1])
        for k, knots in enumerate(schedules[:-1]):
            position = F.when(follows == k, inverted(demand, knots)).otherwise(position)
        return F.when(
            words > 0,
            F.struct(F.lit(epoch).alias("epoch"), words.cast("long").alias("words"), position.alias("position")),
        )

    copies = F.array_compact(F.array(*[copy(e) for e in range(repeats)]))
    return line.select("doc_id", "source", "size", "source_size", "target", copies.alias("copies"))


def curriculum(mixed: DataFrame) -> DataFrame:
    """The copies of ``mix``, one a row, in the order of training: range-sorted by position."""
    return mixed.select("doc_id", "source", "size", F.explode("copies").alias("copy")).select(
        "doc_id", "source", "size", "copy.*"
    ).orderBy("position", "source", "doc_id", "epoch")
