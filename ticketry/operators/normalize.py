"""One source of raw tickets to the canonical, classified ticket."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .. import catalogs as C
from ..functions import values
from ..functions.dates import flexible_datetime, minute_text
from ..functions.ids import source_id
from .classify import classify
from .columns import canonical_columns, require_columns, with_ticket_columns

IMPACT_FLAGS = ["boosted", "penalised", "context_changed"]


def clean_values(df: DataFrame, source: Column, position: Column) -> DataFrame:
    """Ids, channels, priorities, states, dates and SLA flags of canonical string tickets."""
    named = F.when(source == C.MAPPED_CHANNEL_SOURCE, values.channel(F.col("canal"))).otherwise(
        F.col("canal")
    )
    return df.withColumns(
        {
            "id_ticket": source_id(source, F.col("id_ticket"), position),
            "canal": values.document_channel(named, F.col("resumen"), F.col("descripcion")),
            "fecha_creacion": minute_text(flexible_datetime(F.col("fecha_creacion"))),
            "first_reply_at": minute_text(flexible_datetime(F.col("first_reply_at"))),
            "fecha_cierre": minute_text(flexible_datetime(F.col("fecha_cierre"))),
            "estado": values.state(F.col("estado")),
            "prioridad": values.priority(F.col("prioridad")),
            "sla_met": values.sla_flag(F.col("sla_met")),
        }
    )


def normalize_tickets(df: DataFrame, source: str, position: str) -> DataFrame:
    """Clean and classify canonical tickets; ``source`` and ``position`` are column names.

    Keeps ``source`` as ``fuente`` and adds the impact flags. Narrow from end to end.
    """
    kept = df.select(
        F.col(source).alias("fuente"), F.col(position).alias("_position"),
        *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in C.TICKET_COLUMNS],
    )
    clean = clean_values(kept, F.col("fuente"), F.col("_position"))
    return classify(clean.drop("categoria")).select(
        "fuente",
        *C.TICKET_COLUMNS,
        (F.col("boost_hits") > 0).alias("boosted"),
        (F.col("penalty_hits") > 0).alias("penalised"),
        "context_changed",
    )


def normalize_source(df: DataFrame, source: str, position: str = "_position") -> DataFrame:
    """One raw source, any header: canonical columns, then clean and classify."""
    numbered = canonical_columns(require_columns(df, [position]))
    body = with_ticket_columns(numbered, keep=[position])
    return normalize_tickets(body.withColumn("_source", F.lit(source)), "_source", position)


def rule_impact(df: DataFrame) -> DataFrame:
    """Per source: rows with a boost term, with a penalty term, changed by context rules."""
    return df.groupBy("fuente").agg(
        F.count_if("boosted").alias("filas_con_add"),
        F.count_if("penalised").alias("filas_con_neg"),
        F.count_if("context_changed").alias("filas_ajustadas_por_reglas"),
    )
