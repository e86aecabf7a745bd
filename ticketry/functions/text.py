"""Text columns: trimming, accents, matching keys and the text a model reads."""

from __future__ import annotations

import unicodedata
from functools import cache

from pyspark.sql import Column, functions as F

# Everything Python's str.strip() removes; SQL TRIM removes plain blanks only.
WHITESPACE = "".join(
    c for c in map(chr, range(0x3001)) if c.isspace()
)
# The same set inside a Java character class (Java's \s is ASCII).
SPACE_CLASS = r"\s\x1c-\x1f\x85\p{Z}"
# A letter, digit or underscore in any script, as Python's \w; Java's \w is ASCII.
WORD_CLASS = r"[\p{L}\p{N}_]"


def quoted(text: str) -> str:
    """A text as a SQL literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def word_map(pairs: dict[str, str]) -> Column:
    """A constant map; one parsed expression instead of a Column object per word."""
    return F.expr("map(" + ", ".join(quoted(x) for kv in pairs.items() for x in kv) + ")")


def strip_blank(col: Column) -> Column:
    return F.btrim(col, F.lit(WHITESPACE))


def blank_to_null(col: Column) -> Column:
    return F.nullif(F.trim(col), F.lit(""))


@cache
def _accent_table() -> tuple[str, str]:
    """Every precomposed letter below the surrogates, and its letter without marks."""
    source, target = [], []
    for code in range(0xC0, 0xD800):
        if 0xAC00 <= code <= 0xD7A3:  # Hangul syllables decompose without marks
            continue
        char = chr(code)
        plain = "".join(
            c for c in unicodedata.normalize("NFD", char) if unicodedata.category(c) != "Mn"
        )
        if len(plain) == 1 and plain != char:
            source.append(char)
            target.append(plain)
    return "".join(source), "".join(target)


def _without_marks(col: Column) -> Column:
    source, target = _accent_table()
    return F.regexp_replace(F.translate(col, source, target), r"\p{Mn}+", "")


def strip_accents(col: Column) -> Column:
    """Long texts without accents. Plain ASCII texts skip the translation altogether."""
    return F.when(F.octet_length(col) == F.char_length(col), col).otherwise(_without_marks(col))


def match_key(label: Column) -> Column:
    """Case- and accent-insensitive equality key of a label, as the dimensions compare."""
    return F.lower(_without_marks(label))


def rule_text(summary: Column, description: Column) -> Column:
    """The text the keyword rules read."""
    return F.concat(
        F.coalesce(summary, F.lit("")), F.lit(" | "), F.coalesce(description, F.lit(""))
    )


def lot_text(summary: Column, description: Column) -> Column:
    """The text of a scored lot: both parts, one blank between, ends stripped."""
    return strip_blank(
        F.concat(F.coalesce(summary, F.lit("")), F.lit(" "), F.coalesce(description, F.lit("")))
    )


def model_text(subject: Column, description: Column) -> Column:
    """The text of the warehouse views: empty parts leave no blank behind."""
    return F.concat_ws(" ", F.nullif(subject, F.lit("")), F.nullif(description, F.lit("")))


def usable_text(col: Column, least_bytes: int = 5) -> Column:
    return col.isNotNull() & (F.octet_length(F.trim(col)) >= least_bytes)


def ticket_label(code: Column, ticket_id: Column) -> Column:
    """Shown code; tickets without one get a padded number (cut past four digits)."""
    return F.coalesce(
        code, F.concat(F.lit("SOPORTE-"), F.lpad(ticket_id.cast("string"), 4, "0"))
    )
