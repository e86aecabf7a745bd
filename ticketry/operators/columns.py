"""Headers and columns: aliases, merged duplicates, required and optional columns."""

from __future__ import annotations

import re
import unicodedata

from pyspark.sql import Column, DataFrame, functions as F

from .. import catalogs as C
from ..functions.text import strip_blank


def normal_header(name: str | None) -> str:
    """Header without byte-order mark and accents; other signs become one underscore."""
    decomposed = unicodedata.normalize("NFD", (name or "").replace("﻿", ""))
    plain = "".join(c for c in decomposed if unicodedata.category(c) != "Mn")
    return re.sub(r"[^A-Za-z0-9]+", "_", plain).strip("_").lower()


def canonical_name(header: str) -> str:
    """The canonical column a header stands for, or the header itself."""
    key = normal_header(header)
    for name in C.TICKET_COLUMNS:
        if key == name or key in C.HEADER_ALIASES.get(name, ()):
            return name
    return header


def first_filled(columns: list[Column]) -> Column:
    """The first cell of a row that is not blank; blank when all are."""
    return F.coalesce(*[F.when(strip_blank(c) != "", c) for c in columns], F.lit(""))


def canonical_columns(df: DataFrame) -> DataFrame:
    """Rename by alias; columns that end up with one name are merged, first filled cell wins.

    Columns are addressed by position, so a header may repeat.
    """
    numbered = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    groups: dict[str, list[Column]] = {}
    for i, header in enumerate(df.columns):
        groups.setdefault(canonical_name(header), []).append(F.col(f"c{i}"))
    return numbered.select(
        *[
            (cells[0] if len(cells) == 1 else first_filled(cells)).alias(name)
            for name, cells in groups.items()
        ]
    )


def with_ticket_columns(df: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """All canonical columns in order; absent ones blank, nulls blank."""
    return df.select(
        *(keep or []),
        *[
            F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
            if c in df.columns else F.lit("").alias(c)
            for c in C.TICKET_COLUMNS
        ]
    )


def require_columns(df: DataFrame, names: list[str]) -> DataFrame:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}; present: {df.columns}")
    return df


def first_available(df: DataFrame, names: list[str]) -> str:
    for name in names:
        if name in df.columns:
            return name
    raise ValueError(f"none of {names} among {df.columns}")


TRAINING_COLUMNS = ["id_ticket", "texto", "real_cat", "canal", "prioridad"]


def training_columns(df: DataFrame) -> DataFrame:
    """Bring an exported training file to the five columns the models need."""
    df = df.toDF(*[c.strip().lower() for c in df.columns])
    wanted = {"id_canal": "canal", "id_prioridad": "prioridad", "categoria": "real_cat"}
    renames = {
        old: new for old, new in wanted.items() if old in df.columns and new not in df.columns
    }
    df = require_columns(df.withColumnsRenamed(renames), TRAINING_COLUMNS)
    return df.select(
        "id_ticket",
        *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in TRAINING_COLUMNS[1:]],
    )
