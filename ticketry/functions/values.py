"""Value maps: free spellings to the closed lists, in the sources and in staging."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .. import catalogs as C
from .text import rule_text, strip_blank, word_map


def _choose(key: Column, words: dict[str, list[str]], default: Column) -> Column:
    """The value one of whose spellings the key is; the key is evaluated once."""
    pairs = {s: value for value, spellings in words.items() for s in spellings}
    return F.coalesce(word_map(pairs)[key], default)


def _key(col: Column) -> Column:
    return F.lower(strip_blank(F.coalesce(col, F.lit(""))))


def channel(col: Column) -> Column:
    return _choose(_key(col), C.CHANNEL_WORDS, F.lit(C.CHANNEL_DEFAULT))


def mentions_documents(summary: Column, description: Column) -> Column:
    text = F.concat_ws(
        " ", F.coalesce(summary, F.lit("")), F.coalesce(description, F.lit(""))
    )
    return text.rlike(rf"(?iU)\b(?:{C.DOCUMENT_WORDS})\b")


def document_channel(current: Column, summary: Column, description: Column) -> Column:
    """Texts about documentation move to the document portal, whatever channel they had."""
    return F.when(
        mentions_documents(summary, description), F.lit(C.DOCUMENT_CHANNEL)
    ).otherwise(current)


def channel_from_text(summary: Column, description: Column) -> Column:
    """Channel guessed from the words alone, for sources that carry none."""
    text = F.lower(rule_text(summary, description))
    return (
        F.when(text.contains("@") | text.rlike(r"(?U)\b(?:e-?mail|mail|correo)\b"), F.lit("EMAIL"))
        .when(mentions_documents(summary, description), F.lit(C.DOCUMENT_CHANNEL))
        .when(text.rlike(r"(?U)\b(?:phone|call|legal|agent|internal)\b"), F.lit("PORTAL_INTERNO"))
        .otherwise(F.lit("PORTAL_SOPORTE"))
    )


def priority(col: Column) -> Column:
    return _choose(_key(col), C.PRIORITY_WORDS, F.lit(C.PRIORITY_DEFAULT))


def state(col: Column) -> Column:
    return _choose(_key(col), C.STATE_WORDS, F.lit(C.STATE_DEFAULT))


def sla_flag(col: Column) -> Column:
    """``true``, ``false`` or blank; spreadsheet wrappers around the value are removed."""
    bare = F.replace(F.replace(_key(col), F.lit('="'), F.lit("")), F.lit('"'), F.lit(""))
    return _choose(F.ltrim(bare, F.lit("'")), C.SLA_WORDS, F.lit(""))


# --- staging ------------------------------------------------------------------------------
def staging_channel(col: Column) -> Column:
    name = F.trim(col)
    words = {label: [code] for code, label in C.STAGING_CHANNELS.items()}
    return _choose(F.upper(name), words, name)


def staging_priority(col: Column) -> Column:
    name = F.trim(col)
    return F.when(F.lower(name).isin(C.STAGING_URGENT), F.lit("Urgente")).otherwise(name)


def staging_state(col: Column) -> Column:
    name = F.trim(col)
    return F.when(F.upper(name) == "ABIERTO", F.lit("Pendiente")).otherwise(name)


def staging_sla(col: Column) -> Column:
    return _choose(F.lower(F.trim(col)), C.STAGING_SLA, F.lit(None).cast("string"))
