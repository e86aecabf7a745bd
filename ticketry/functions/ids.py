"""Ticket ids: source prefixes, and dense numbers handed out without a single-task sort."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .. import catalogs as C
from .text import strip_blank, word_map

# Hash digits that spread the rows of one group over 16**3 tasks.
SPREAD_DIGITS = 3


def source_id(source: Column, original: Column, position: Column) -> Column:
    """Prefix an id by its source; a blank one becomes ``<prefix>GEN<row number>``.

    ``position`` counts rows of the source from zero. ``source`` may be a column, so all
    sources can be handled in one pass.
    """
    bare = strip_blank(F.coalesce(original, F.lit("")))
    prefix = word_map({name: start for name, (start, _) in C.SOURCE_PREFIXES.items()})[source]
    ready = "|".join(
        f"{name}:(?:{'|'.join(accepted)})" for name, (_, accepted) in C.SOURCE_PREFIXES.items()
    )
    return (
        F.when(bare == "", F.concat(prefix, F.lit("GEN"), (position + 1).cast("string")))
        .when(F.concat(source, F.lit(":"), bare).rlike(f"(?i)^(?:{ready})"), bare)
        .otherwise(F.concat(prefix, bare))
    )


def spread_row_number(
    df: DataFrame, key: str, by: list[str] | None = None, name: str = "row_number",
    digits: int = SPREAD_DIGITS,
) -> DataFrame:
    """Exact row numbers 1..n inside each ``by`` group, in the order of the key's hash.

    A plain window would sort a whole group in one task. Here every group is cut into
    16**digits slices by the leading hash digits; each slice is numbered on its own and
    starts where the slices before it end. ``key`` must be unique.
    """
    groups = list(by or [])
    hashed = df.withColumn("_hash", F.md5(F.col(key).cast("string"))).withColumn(
        "_slice", F.left("_hash", F.lit(digits))
    )
    sizes = hashed.groupBy(*groups, "_slice").agg(F.count("*").alias("_n"))
    ahead = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    if groups:
        ahead = Window.partitionBy(*groups).orderBy("_slice").rowsBetween(
            Window.unboundedPreceding, -1
        )
    starts = sizes.select(
        *[F.col(g).alias(f"_by{i}") for i, g in enumerate(groups)],
        F.col("_slice").alias("_start_slice"),
        F.coalesce(F.sum("_n").over(ahead), F.lit(0)).alias("_start"),
    )
    match = F.col("_slice") == F.col("_start_slice")
    for i, g in enumerate(groups):
        match = match & F.col(g).eqNullSafe(F.col(f"_by{i}"))
    inside = Window.partitionBy(*groups, "_slice").orderBy("_hash", key)
    numbered = hashed.withColumn("_inside", F.row_number().over(inside))
    return numbered.join(starts, match, "inner").select(
        *df.columns, (F.col("_start") + F.col("_inside")).cast("long").alias(name)
    )


def ticket_numbers(
    codes: DataFrame, known: DataFrame | None = None, start: int = C.FIRST_TICKET_ID
) -> DataFrame:
    """Surrogate numbers per ``ticket_code``: known codes keep theirs, new ones count on.

    ``codes`` may repeat a code; the result holds each once as (ticket_code, id_ticket).
    """
    distinct = codes.select("ticket_code").where("ticket_code IS NOT NULL").distinct()
    if known is None:
        return spread_row_number(distinct, "ticket_code").select(
            "ticket_code", (F.col("row_number") + (start - 1)).alias("id_ticket")
        )
    known = known.select("ticket_code", "id_ticket")
    last = known.agg(F.coalesce(F.max("id_ticket"), F.lit(start - 1)).alias("_last"))
    fresh = spread_row_number(distinct.join(known, "ticket_code", "left_anti"), "ticket_code")
    return (
        known.join(distinct, "ticket_code", "left_semi")
        .unionByName(
            fresh.join(F.broadcast(last)).select(
                "ticket_code", (F.col("_last") + F.col("row_number")).alias("id_ticket")
            )
        )
    )
