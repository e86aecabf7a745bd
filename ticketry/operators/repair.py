"""Coherence of closing dates with the state and the other dates, with a full audit."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .. import catalogs as C
from ..functions.dates import minute_text, moment, read_minute_text

# Names under which each correction is logged, in the order of application.
RULES = [
    "A_future_close_cleared",
    "1_open_with_close_cleared",
    "3_close_before_creation_cleared",
    "4_close_before_first_fixed_to_max",
    "4_close_before_first_cleared_open_state",
    "2_closed_without_close_imputed",
]

# The rules are applied one after the other, each on the date the one before left. Their
# outcome has a closed form, so no chain of columns is needed. With ``past`` for a closing
# date that is not in the future:
#   closed states  the latest of past, reply and creation (an early date is lifted, a missing
#                  one imputed, nulls are skipped)
#   open states    none
#   other states   past, unless it is before creation or reply


def repaired_close(opened: Column, replied: Column, closed: Column, state: Column,
                   as_of: Column) -> Column:
    """The closing date after all rules."""
    past = F.when(closed <= as_of, closed)
    return (
        F.when(state.isin(C.CLOSED_STATES), F.greatest(past, replied, opened))
        .when(state.isin(C.OPEN_STATES), None)
        .otherwise(
            F.when(~F.coalesce(past < F.greatest(replied, opened), F.lit(False)), past)
        )
    )


def _changes(opened: Column, replied: Column, closed: Column, state: Column,
             as_of: Column) -> Column:
    """Audit entries in the order the rules fire; a rule sees what the one before left."""
    is_open, is_closed = state.isin(C.OPEN_STATES), state.isin(C.CLOSED_STATES)
    future = F.coalesce(closed > as_of, F.lit(False))
    past = closed.isNotNull() & ~future
    early = past & ~is_open & F.coalesce(closed < opened, F.lit(False))
    kept = past & ~is_open & ~early
    unanswered = kept & F.coalesce(closed < replied, F.lit(False))
    latest = F.greatest(replied, opened)
    missing = is_closed & (closed.isNull() | future | early) & latest.isNotNull()
    before, after, blank = minute_text(closed), minute_text(latest), F.lit("")
    fired = [
        (future, before, blank),
        (past & is_open, before, blank),
        (early, before, blank),
        (unanswered & is_closed, before, after),
        (unanswered & ~is_closed, before, blank),
        (missing, blank, after),
    ]
    return F.array_compact(
        F.array(
            *[
                F.when(
                    test,
                    F.struct(
                        F.lit(rule).alias("regla"),
                        old.alias("antes_fecha_cierre"),
                        new.alias("despues_fecha_cierre"),
                    ),
                )
                for rule, (test, old, new) in zip(RULES, fired)
            ]
        )
    )


def repair_closing_dates(df: DataFrame, as_of=None) -> DataFrame:
    """Correct ``fecha_cierre``; adds ``cambios``, one entry per rule that fired.

    Dates are canonical text. ``as_of`` decides what lies in the future. Row-local: the
    audit costs nothing unless somebody reads it.
    """
    dated = df.withColumns(
        {
            "_opened": read_minute_text(F.col("fecha_creacion")),
            "_replied": read_minute_text(F.col("first_reply_at")),
            "_closed": read_minute_text(F.col("fecha_cierre")),
        }
    )
    parts = [F.col("_opened"), F.col("_replied"), F.col("_closed"),
             F.coalesce(F.col("estado"), F.lit("")), moment(as_of)]
    return dated.select(
        *[
            minute_text(repaired_close(*parts)).alias(c) if c == "fecha_cierre" else F.col(c)
            for c in df.columns
        ],
        _changes(*parts).alias("cambios"),
    )


def repair_audit(repaired: DataFrame) -> DataFrame:
    """One row per ticket and rule that changed its closing date."""
    return repaired.where(F.size("cambios") > 0).select(
        "id_ticket", F.inline("cambios")
    )


def repair_counts(audit: DataFrame) -> DataFrame:
    return audit.groupBy("regla").agg(F.count("*").alias("n"))
