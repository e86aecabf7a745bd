"""Validators: each returns the offending rows or the counts, never an exception."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from .. import catalogs as C
from ..functions.dates import minutes_between, moment
from ..functions.text import match_key, quoted, strip_blank


def violated(df: DataFrame, rules: dict[str, Column], keep: list[str]) -> DataFrame:
    """Rows breaking at least one rule, with the names of all rules they break.

    A rule is the condition that must not hold; null counts as not broken.
    """
    broken = F.array_compact(F.array(*[F.when(test, F.lit(name)) for name, test in rules.items()]))
    return df.select(*keep, broken.alias("reglas")).where(F.size("reglas") > 0)


def violation_counts(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """(rule, rows breaking it) for all rules in one pass."""
    counts = df.agg(*[F.count_if(test).alias(name) for name, test in rules.items()])
    return counts.unpivot([], list(rules), "regla", "n")


def fact_rules() -> dict[str, Column]:
    return {
        "resolucion_antes_de_creacion": F.col("fecha_resolucion") < F.col("fecha_creacion"),
        "ttr_negativo": F.col("time_to_resolution_min") < 0,
        "frt_negativo": F.col("first_response_time_min") < 0,
        "sla_met_no_booleano": ~F.col("sla_met").isin(0, 1),
    }


def prediction_rules() -> dict[str, Column]:
    return {"score_fuera_de_rango": ~F.col("score_predicho").between(0, 1)}


# Longest text each staging column may hold.
STAGING_LENGTHS = {
    "id_ticket": 64, "canal": 30, "fecha_creacion": 40, "first_reply_at": 40,
    "fecha_cierre": 40, "estado": 30, "prioridad": 20, "predicted": 10, "categoria": 10,
    "agente_id": 100, "sla_target_horas": 10, "sla_met": 10, "resumen": 255, "origen": 20,
    "id_origen": 64,
}
SUMMARY_LEAST, DESCRIPTION_LEAST = 5, 10


def length_rules(columns: list[str]) -> dict[str, Column]:
    """Over-long cells, too short texts, and tickets without any text."""
    rules = {
        f"{name}_largo": F.char_length(name) > limit
        for name, limit in STAGING_LENGTHS.items() if name in columns
    }
    summary = strip_blank(F.coalesce(F.col("resumen"), F.lit("")))
    description = strip_blank(F.coalesce(F.col("descripcion"), F.lit("")))
    rules["resumen_corto"] = F.char_length(summary) < SUMMARY_LEAST
    rules["descripcion_corta"] = F.char_length(description) < DESCRIPTION_LEAST
    rules["sin_texto"] = (summary == "") & (description == "")
    return rules


def missing_rules(columns: list[str]) -> dict[str, Column]:
    return {f"{name}_nulo": F.col(name).isNull() for name in columns}


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys held by more than one row. Counting reduces copies before they travel."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def orphans(df: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Rows whose non-null reference has no parent."""
    keys = parent.select(F.col(parent_column).alias("_key"))
    return df.where(F.col(column).isNotNull()).join(keys, F.col(column) == F.col("_key"), "left_anti")


def orphan_counts(df: DataFrame, references: dict[str, DataFrame]) -> DataFrame:
    """(reference, rows without parent) for several dimensions in one scan.

    ``references`` maps a column to a dimension whose first column is its key.
    """
    for column, dim in references.items():
        keys = dim.select(F.col(dim.columns[0]).alias(f"_k_{column}"))
        df = df.join(keys, F.col(column) == F.col(f"_k_{column}"), "left")
    return violation_counts(
        df,
        {
            column: F.col(column).isNotNull() & F.col(f"_k_{column}").isNull()
            for column in references
        },
    )


CATALOGUE = {
    "estado": [*C.STATE_WORDS],
    "prioridad": [*C.PRIORITY_WORDS],
    "canal": ["EMAIL", "PORTAL_SOPORTE", "PORTAL_INTERNO", "PORTAL_DOCUMENTAL"],
    "categoria": [*C.LABELS],
    "sla_met": ["true", "false", ""],
}


def catalogue_strays(df: DataFrame, catalogue: dict[str, list[str]] | None = None) -> DataFrame:
    """(column, value, rows) for values outside the closed lists, compared without case and
    accents. All columns are checked in one scan."""
    catalogue = CATALOGUE if catalogue is None else catalogue
    cells = df.select(
        F.explode(
            F.array(
                *[
                    F.when(
                        ~match_key(F.coalesce(F.col(name), F.lit(""))).isin(
                            [_folded(v) for v in allowed]
                        ),
                        F.struct(F.lit(name).alias("columna"), F.col(name).alias("valor")),
                    )
                    for name, allowed in catalogue.items()
                ]
            )
        ).alias("c")
    )
    return cells.where("c IS NOT NULL").groupBy("c.columna", "c.valor").agg(
        F.count("*").alias("n")
    )


def _folded(value: str) -> str:
    import unicodedata

    marks = unicodedata.normalize("NFD", value)
    return "".join(c for c in marks if unicodedata.category(c) != "Mn").lower()


def reconciliation(staging: DataFrame, facts: DataFrame, lineage: DataFrame,
                   origin: str = "manual") -> DataFrame:
    """Rows staged, facts of those codes, and lineage entries of those codes."""
    codes = staging.select(F.col("id_ticket").alias("_code")).distinct()
    staged = staging.agg(F.count("*").alias("stg"))
    fact = facts.join(codes, F.col("ticket_code") == F.col("_code"), "left_semi").agg(
        F.count("*").alias("fact")
    )
    lin = (
        lineage.where(F.col("origen") == origin)
        .join(codes, F.col("id_origen") == F.col("_code"), "left_semi")
        .agg(F.count("*").alias("lin"))
    )
    return staged.join(F.broadcast(fact)).join(F.broadcast(lin))  # three one-row results


def state_date_rules(as_of=None) -> dict[str, Column]:
    """Coherence of states and dates; dates are timestamps, states the closed list."""
    opened, replied, closed = (
        F.col("fecha_creacion"), F.col("first_reply_at"), F.col("fecha_cierre")
    )
    early = F.lit("2000-01-01").cast("timestamp_ntz")
    now = moment(as_of)
    dates = [opened, replied, closed]
    return {
        "abierto_con_cierre": F.col("estado").isin(C.OPEN_STATES) & closed.isNotNull(),
        "cerrado_sin_cierre": F.col("estado").isin(C.CLOSED_STATES) & closed.isNull(),
        "cierre_antes_de_apertura_o_respuesta": F.col("estado").isin(C.CLOSED_STATES)
        & (closed < F.greatest(opened, replied)),
        "respuesta_antes_de_apertura": replied < opened,
        "fecha_anterior_a_2000": reduce(
            lambda a, b: a | b, [F.coalesce(d < early, F.lit(False)) for d in dates]
        ),
        "fecha_futura": reduce(
            lambda a, b: a | b, [F.coalesce(d > now, F.lit(False)) for d in dates]
        ),
    }


def sla_rules() -> dict[str, Column]:
    """The flag against the time taken; only closed tickets with a flag and a target count."""
    target = F.col("sla_target_horas").try_cast("long") * 60
    kept = minutes_between(F.col("fecha_creacion"), F.col("fecha_cierre")) <= target
    flag = F.when(F.col("sla_met") == "true", F.lit(True)).when(
        F.col("sla_met") == "false", F.lit(False)
    )
    return {"sla_incoherente": flag != kept}


def _repeated(rows: DataFrame, text: str, count: str) -> DataFrame:
    """(text, rows) of the texts that more than one row holds.

    Texts are counted by a 128-bit hash, so that only hashes travel; the text of a repeated one
    is fetched by its hash, one copy of it.
    """
    hashed = rows.select(F.md5(text).alias("_h"), F.col(text))
    several = hashed.groupBy("_h").agg(F.count("*").alias(count)).where(F.col(count) > 1)
    # A copy of each is reduced where it is read; texts that occur once never travel.
    found = hashed.join(several, "_h", "left_semi").groupBy("_h").agg(F.min(text).alias(text))
    return found.join(several, "_h").select(text, count)


def repeated_texts(df: DataFrame, column: str) -> DataFrame:
    return _repeated(df.where(strip_blank(F.col(column)) != ""), column, "n")


def repeated_sentences(df: DataFrame, text: str) -> DataFrame:
    """(sentence, rows) for sentences found in more than one row.

    Repetitions inside a row are removed in place, and counted by hash.
    """
    sentences = df.select(
        F.explode_outer(  # the plain form would split each text twice, to test for emptiness
            F.array_distinct(
                F.transform(F.split(F.col(text), r"[.!?]+"), lambda s: strip_blank(s))
            )
        ).alias("oracion")
    ).where("oracion != ''")
    return _repeated(sentences, "oracion", "filas")


# Expected share of each category, lowest and highest per cent.
CATEGORY_SHARES = [
    ("SW", 20.0, 25.0), ("MAIL", 15.0, 20.0), ("NET", 12.0, 18.0), ("SRV", 10.0, 15.0),
    ("APP", 10.0, 15.0), ("ACC", 8.0, 12.0), ("HW", 6.0, 10.0), ("POL", 3.0, 6.0),
]


def shares(df: DataFrame, column: str = "categoria", bounds=None) -> DataFrame:
    """Share of each listed value, and whether it lies within its bounds. One aggregation."""
    bounds = bounds or CATEGORY_SHARES
    counted = df.agg(
        F.count("*").alias("_total"),
        *[F.count_if(F.col(column) == value).alias(f"_n{i}") for i, (value, _, _) in enumerate(bounds)],
    )
    listed = ", ".join(
        f"struct({quoted(value)} AS {column}, _n{i} AS n, {low}D AS _low, {high}D AS _high)"
        for i, (value, low, high) in enumerate(bounds)
    )
    share = F.coalesce(F.round(F.try_divide(F.lit(100.0) * F.col("n"), F.col("_total")), 2), F.lit(0.0))
    return (
        counted.selectExpr("_total", f"inline(array({listed}))")
        .withColumn("pct", share)
        .select(column, "n", "pct", F.expr("pct BETWEEN _low AND _high").alias("dentro"))
    )


def value_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, value, rows) for several columns in one scan; null is a value."""
    return (
        df.select(
            F.explode(
                F.array(
                    *[
                        F.struct(F.lit(c).alias("columna"), F.col(c).cast("string").alias("valor"))
                        for c in columns
                    ]
                )
            ).alias("c")
        )
        .groupBy("c.columna", "c.valor")
        .agg(F.count("*").alias("n"))
    )
