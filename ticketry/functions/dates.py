"""Dates that arrive as text, and time spans. All times are wall-clock times without zone."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .text import strip_blank

# The readers below name their input once: Catalyst copies the input's own expression to each
# mention when it pushes a filter on the date down to the scan.
_CLOCK = r"\d{1,2}:\d{1,2}(?::\d{1,2}(?:\.\d+)?)?"
_ZONE = r"(?:Z|[+-]\d{2}(?::?\d{2})?)"
# A calendar date, then optionally a time; after a time an offset may follow.
_ISO = rf"^\d{{4}}-\d{{1,2}}-\d{{1,2}}(?:[T ](?:\d{{2}}|{_CLOCK})(?={_ZONE}?$))?(?={_ZONE}?$)"
_YEAR_FIRST = r"^(\d{4})/(\d{1,2})/(\d{1,2})"
# Day-first, unless the second number can only be a day.
_MONTH_FIRST = r"^(\d{1,2})([/.-])(1[3-9]|[23]\d)[/.-](\d{4})(?!\d)"
_DAY_FIRST = r"^(\d{1,2})[/.-](\d{1,2})[/.-](\d{4})(?!\d)"

# Staged dates: ISO, or day-first turned round and marked by ``=``.
_STAGED_DAY_FIRST = r"^(\d{1,2})([/-])(\d{1,2})\2(\d{4})(?!\d)"
_STAGED_TIME = r"\d{1,2}:\d{2}(?::\d{2})?"
_STAGED = (
    rf"^(?:=(?=[\d-]+(?: {_STAGED_TIME})?$)"
    rf"|(?=\d{{4}}-\d{{2}}-\d{{2}}(?:[T ]{_STAGED_TIME})?(?:$|[Z.]|[+-]\d{{2}}:?\d{{2}}$)))"
    rf"(\d{{4}}-\d{{1,2}}-\d{{1,2}}(?:[T ]{_STAGED_TIME})?)"
)


def _moment_in(text: Column, shape: str, group: int = 0) -> Column:
    """The part of a text that has the shape, as a time; null without one."""
    return F.regexp_extract(text, shape, group).try_cast("timestamp_ntz")


def flexible_datetime(text: Column) -> Column:
    """Read ISO dates first, then day-first, then month-first; null when none fits.

    An offset after the time is dropped, not applied.
    """
    cell = F.regexp_replace(strip_blank(text), r"\s+", " ")
    cell = F.regexp_replace(cell, _YEAR_FIRST, "$1-$2-$3")
    cell = F.regexp_replace(cell, _MONTH_FIRST, "$3/$1/$4")
    return _moment_in(F.regexp_replace(cell, _DAY_FIRST, "$3-$2-$1"), _ISO)


def staging_datetime(text: Column) -> Column:
    """Dates of the staging table: ISO, d/m/Y or d-m-Y, with seconds, minutes or no time."""
    turned = F.regexp_replace(F.rtrim(text), _STAGED_DAY_FIRST, "=$4-$3-$1")
    return _moment_in(turned, _STAGED, 1)


def minute_text(moment: Column) -> Column:
    """``YYYY-MM-DD HH:MM``; blank for a missing time."""
    return F.coalesce(F.left(moment.cast("string"), F.lit(16)), F.lit(""))


def read_minute_text(text: Column) -> Column:
    """Back from text: blank or unreadable cells are null."""
    return text.try_cast("timestamp_ntz")


def _whole_units(start: Column, end: Column, unit: str) -> Column:
    return F.call_function("div", end - start, F.expr(f"INTERVAL '1' {unit}"))


def minutes_between(start: Column, end: Column) -> Column:
    """Complete minutes, towards zero; null when either end is missing."""
    return _whole_units(start, end, "MINUTE")


def hours_between(start: Column, end: Column) -> Column:
    return _whole_units(start, end, "HOUR")


def moment(as_of=None) -> Column:
    """A chosen point in time, or the start of the query."""
    if as_of is None:
        return F.current_timestamp().cast("timestamp_ntz")
    return as_of if isinstance(as_of, Column) else F.lit(as_of).cast("timestamp_ntz")
