"""Quality rules with adaptive thresholds, in DataFrame functions only.

Fixed rules come first. What passes them is measured, and the distribution of each measure is kept
per language and source as a quantile sketch: counts by bucket, a bucket holding the values that
share their six leading bits. Sketches merge by adding counts, so those of a language, and of all
rows, are sums of those of the sources; a source with few rows is judged by its language, a language
with few by all. A row is rejected where a measure lies beyond the outer fence (quartile plus three
times the spread) of its group; a fence never cuts below a stated tolerance.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ticketry.llm.common import SPACES, SPACE_RUN, cut, own_names

#: Leading bits a bucket keeps: a quantile is off by less than one part in 32.
LEADING = 6
#: Rows a sketch needs to speak for its group.
ENOUGH = 200
#: Fences lie so many spreads outside the quartiles.
REACH = 3
#: Distinct repeated windows that are looked up one by one; beyond it they are sorted.
FEW = 64


@dataclass(frozen=True)
class Measure:
    """A whole number per row (``top`` * 1000 // ``bottom``), its least spread in parts of a
    thousand of the median, and the values no fence may cut into."""

    name: str
    top: str
    bottom: str
    spread: int
    at_most: int
    at_least: int | None = None


MEASURES = (
    Measure("word_length", "word_chars", "n_words", 150, 6500, 3500),
    Measure("symbols", "n_symbols", "n_words", 0, 100),
    Measure("dup_lines", "n_dup_lines", "n_lines", 0, 500),
    Measure("repeats", "n_repeat_words", "n_words", 0, 300),
)
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def measured(documents: DataFrame) -> DataFrame:
    """``documents`` with one more column ``__m``, a struct of the base counts and ``n_lines``.

    Arrays that a lambda looks into are columns of their own: inside a lambda an expression is
    evaluated for every element anew.
    """
    text = F.coalesce(documents["text"], F.lit(""))
    bare = F.trim(text, F.lit(SPACES))
    none = F.array().cast("array<bigint>")
    words, n, grams = F.col("__w"), F.size("__w"), F.col("__g")
    rows = documents.withColumn("__t", text).withColumn(
        "__w", F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, SPACE_RUN))
    )
    rows = rows.withColumn(
        "__g",  # a hash of each three-word window
        F.when(n < 3, none).otherwise(
            F.transform(
                F.sequence(F.lit(0), n - 3),
                lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)),
            )
        ),
    )
    rows = rows.withColumn(
        "__o", F.when(F.size(F.array_distinct(grams)) == F.size(grams), none).otherwise(F.sort_array(grams))
    )
    rows = rows.withColumn(
        "__s",  # the hashes that occur twice or more
        F.array_distinct(F.filter("__o", lambda x, i: (i > 0) & (F.get("__o", i - 1) == x))),
    )
    places = F.sequence(F.lit(0), n - 3)
    pairs = F.zip_with(grams, places, lambda g, i: F.struct(g.alias("g"), i.alias("i")))
    rows = rows.withColumn(
        "__p",  # windows in the order of their hashes, where many repeat
        F.when(F.size("__s") > FEW, F.sort_array(pairs)),
    )

    def same(pair: Column, at: Column) -> Column:
        return F.coalesce(F.get("__p", at)["g"] == pair["g"], F.lit(False))

    repeated = (
        F.when(F.size("__s") == 0, F.array().cast("array<int>"))
        .when(
            F.size("__s") <= FEW,
            F.filter(places, lambda i: F.array_contains("__s", F.get("__g", i))),
        )
        .otherwise(
            F.sort_array(
                F.transform(
                    F.filter("__p", lambda p, i: same(p, i - 1) | same(p, i + 1)), lambda p: p["i"]
                )
            )
        )
    )
    covered = F.aggregate(
        repeated, F.struct(F.lit(0).alias("n"), F.lit(-3).alias("last")),
        lambda a, x: F.struct(
            (a["n"] + F.least(F.lit(3), x - a["last"])).alias("n"), x.alias("last")
        ),
        lambda a: a["n"],
    )
    lines = F.filter(F.split("__t", "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))
    rows = rows.withColumn("__l", lines)
    counts = F.struct(
        n.cast("long").alias("n_words"),
        F.length(F.array_join("__w", "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace("__t", "[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        (F.size("__l") - F.size(F.array_distinct("__l"))).cast("long").alias("n_dup_lines"),
        covered.cast("long").alias("n_repeat_words"),
        F.size("__l").cast("long").alias("n_lines"),
    )
    return rows.withColumn("__m", counts).drop("__t", "__w", "__g", "__o", "__s", "__p", "__l")


def _dropped(value: Column) -> Column:
    return F.greatest(F.length(F.bin(value)) - LEADING, F.lit(0))


def bucket(value: Column) -> Column:
    """The least value that shares the leading bits (whole numbers, 0 or more)."""
    kept = F.call_function("shiftright", value, _dropped(value))
    return F.call_function("shiftleft", kept, _dropped(value))


def bucket_end(edge: Column) -> Column:
    """The greatest value of the bucket that starts at ``edge``."""
    return edge + F.call_function("shiftleft", F.lit(1).cast("long"), _dropped(edge)) - 1


def sketches(measures: DataFrame) -> DataFrame:
    """level (2: language and source, 1: language, 0: all), __lang, __source, measure, edge, n.

    ``measures`` has __lang, __source and a column for each measure. The levels above are
    merged from the sketches below, not from rows.
    """
    pairs = F.explode(
        F.array(*[F.struct(F.lit(m.name).alias("measure"), bucket(F.col(m.name)).alias("edge")) for m in MEASURES])
    ).alias("p")
    nothing = F.lit(None).cast("string")
    low = (
        measures.select("__lang", "__source", pairs).select("__lang", "__source", "p.*")
        .groupBy("__lang", "__source", "measure", "edge").agg(F.count("*").alias("n"))
    )
    middle = low.groupBy("__lang", "measure", "edge").agg(F.sum("n").alias("n"))
    top = middle.groupBy("measure", "edge").agg(F.sum("n").alias("n"))
    names = ("level", "__lang", "__source", "measure", "edge", "n")
    return (
        low.withColumn("level", F.lit(2)).select(*names)
        .unionByName(middle.withColumns({"level": F.lit(1), "__source": nothing}).select(*names))
        .unionByName(
            top.withColumns({"level": F.lit(0), "__lang": nothing, "__source": nothing}).select(*names)
        )
    )


def fences(sketch: DataFrame, enough: int = ENOUGH) -> DataFrame:
    """level, __lang, __source and, for each measure, ``low`` and ``high`` fences; groups with
    ``enough`` rows only, but always all rows."""
    group = ("level", "__lang", "__source", "measure")
    so_far = Window.partitionBy(*group).orderBy("edge")
    counted = sketch.withColumns(
        {"upto": F.sum("n").over(so_far), "total": F.sum("n").over(Window.partitionBy(*group))}
    )
    at = lambda q: F.min(F.when(F.col("upto") * 4 >= F.col("total") * q, F.col("edge")))
    quartiles = counted.groupBy(*group).agg(
        F.max("total").alias("total"), at(1).alias("q1"), at(2).alias("q2"), at(3).alias("q3")
    ).withColumn("q3_end", bucket_end(F.col("q3"))).where((F.col("total") >= enough) | (F.col("level") == 0))
    out = []
    for m in MEASURES:
        mine = lambda c: F.max(F.when(F.col("measure") == m.name, F.col(c)))  # noqa: B023,E731
        spread = F.greatest(mine("q3") - mine("q1"), F.floor(mine("q2") * m.spread / 1000))
        out.append(F.greatest(mine("q3_end") + REACH * spread, F.lit(m.at_most)).alias(f"{m.name}_high"))
        low = F.lit(None).cast("long") if m.at_least is None else F.least(
            mine("q1") - REACH * spread, F.lit(m.at_least)
        )
        out.append(low.alias(f"{m.name}_low"))
    return quartiles.groupBy("level", "__lang", "__source").agg(*out)


def judge(documents: DataFrame, enough: int = ENOUGH, columns: list[str] | None = None) -> DataFrame:
    """``columns`` of ``documents`` (default: all) with ``__m`` (the base counts), ``__base_failed``
    and ``__kept``.

    Null text has no words. A row fails the base rules with fewer than 50 words or with more than
    half of its words in repeated three-word windows; such rows are rejected and don't enter the
    sketches. Null languages and sources are groups of their own; missing columns ``lang`` or
    ``source`` count as null. Repeated rows count as often as they occur. An empty table gives an
    empty result.
    """
    # A column that is called like a result is replaced, like a working column passed over.
    documents = documents.drop(*[c for c in documents.columns if c.startswith("__")])
    wanted = documents.columns if columns is None else columns
    null = F.lit(None).cast("string")
    group = {
        f"__{c}": documents[c].cast("string") if c in documents.columns else null
        for c in ("lang", "source")
    }
    words = F.col("__m.n_words")
    failed = (words < 50) | (100 * F.col("__m.n_repeat_words") > 50 * words)
    rows = measured(documents.withColumns(group)).select(*wanted, "__lang", "__source", "__m")
    rows = cut(rows.withColumn("__base_failed", failed))
    per_mille = {
        m.name: F.when(
            F.col(f"__m.{m.bottom}") > 0,
            F.floor(F.col(f"__m.{m.top}") * 1000 / F.col(f"__m.{m.bottom}")),
        ).otherwise(0).cast("long")
        for m in MEASURES
    }
    values = rows.withColumns(per_mille)
    edges = fences(
        sketches(values.where(~F.col("__base_failed")).select("__lang", "__source", *per_mille)), enough
    )
    limits = [f"{m.name}_{side}" for m in MEASURES for side in ("high", "low")]
    own = edges.where("level = 2").select("__lang", "__source", F.struct(*limits).alias("own"))
    language = edges.where("level = 1").select(
        F.col("__lang").alias("__l1"), F.struct(*limits).alias("language")
    )
    every = edges.where("level = 0").select(F.struct(*limits).alias("every"))
    groups = values.select("__lang", "__source").distinct()
    same = groups["__lang"].eqNullSafe(own["__lang"]) & groups["__source"].eqNullSafe(own["__source"])
    table = (
        groups.join(own, same, "left").select(groups["*"], "own")
        .join(language, F.col("__lang").eqNullSafe(F.col("__l1")), "left").drop("__l1")
        .join(every, F.lit(True), "left")  # one row
        .select(
            F.col("__lang").alias("__gl"), F.col("__source").alias("__gs"),
            F.coalesce("own", "language", "every").alias("__limits"),
        )
    )
    # A row per language and source: Spark knows the size of a written table, and sends it to
    # the rows if it is small, or splits the rows of a hot source.
    table = cut(table)
    inside = F.lit(True)
    for m in MEASURES:
        limit = F.col(f"__limits.{m.name}_high")
        inside = inside & (F.col(m.name) <= F.coalesce(limit, F.col(m.name)))
        if m.at_least is not None:
            limit = F.col(f"__limits.{m.name}_low")
            inside = inside & (F.col(m.name) >= F.coalesce(limit, F.col(m.name)))
    match = F.col("__lang").eqNullSafe(F.col("__gl")) & F.col("__source").eqNullSafe(F.col("__gs"))
    return (
        values.join(table, match, "left")
        .withColumn("__kept", ~F.col("__base_failed") & inside)
        .select(*wanted, "__m", "__base_failed", "__kept")
    )


@own_names("doc_id", "text", "lang", "source")
def keep(documents: DataFrame, enough: int = ENOUGH) -> DataFrame:
    """The rows of ``documents`` that pass."""
    return judge(documents, enough).where("__kept").select(*documents.columns)
