"""Operational figures over the ticket facts. Dimensions have a handful of fixed rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .. import catalogs as C
from ..functions.dates import hours_between, moment


def _sla_percent(digits: int) -> Column:
    """Share of kept targets among the tickets whose outcome is known."""
    met = F.count_if(F.col("sla_met") == 1)
    known = F.count_if(F.col("sla_met").isin(0, 1))
    return F.round(F.try_divide(F.lit(100.0) * met, known), digits)


def _open_tickets() -> Column:
    return F.count_if(F.col("fecha_resolucion").isNull())


def _mean(name: str, digits: int | None = None) -> Column:
    mean = F.avg(name)
    return mean if digits is None else F.round(mean, digits)


def overview(facts: DataFrame) -> DataFrame:
    return facts.agg(
        F.count("*").alias("total_tickets"),
        F.count("fecha_resolucion").alias("cerrados"),
        _open_tickets().alias("abiertos"),
        _sla_percent(1).alias("sla_ok_pct"),
        _mean("first_response_time_min").alias("avg_frt_min"),
        _mean("time_to_resolution_min").alias("avg_ttr_min"),
    )


def by_channel(facts: DataFrame) -> DataFrame:
    """Aggregated on the small key first; the label joins only the few result rows."""
    measured = facts.groupBy("id_canal").agg(
        F.count("*").alias("n"),
        _open_tickets().alias("abiertos"),
        _sla_percent(1).alias("sla_ok_pct"),
        _mean("first_response_time_min").alias("avg_frt_min"),
        _mean("time_to_resolution_min").alias("avg_ttr_min"),
    )
    return measured.join(F.broadcast(C.d_canal(facts.sparkSession)), "id_canal").select(
        "canal", "n", "abiertos", "sla_ok_pct", "avg_frt_min", "avg_ttr_min"
    )


def by_priority(facts: DataFrame) -> DataFrame:
    measured = facts.groupBy("id_prioridad").agg(
        F.count("*").alias("n"),
        _open_tickets().alias("abiertos"),
        F.round(F.lit(100) * F.avg("sla_met"), 2).alias("sla_ok_pct"),
        _mean("first_response_time_min", 1).alias("avg_frt_min"),
        _mean("time_to_resolution_min", 1).alias("avg_ttr_min"),
    )
    labels = F.broadcast(C.d_prioridad(facts.sparkSession))
    return (
        measured.join(labels, "id_prioridad")
        .select("prioridad", "n", "abiertos", "sla_ok_pct", "avg_frt_min", "avg_ttr_min")
        .orderBy(F.desc("n"), "prioridad")
    )


def daily_flow(facts: DataFrame, opened: str = "fecha_creacion",
               closed: str = "fecha_resolucion") -> DataFrame:
    """Tickets created and closed per day: one scan, each ticket giving up to two marks."""
    marks = facts.select(
        F.explode(
            F.array(
                F.struct(F.to_date(opened).alias("fecha"), F.lit(1).alias("i"), F.lit(0).alias("o")),
                F.struct(F.to_date(closed).alias("fecha"), F.lit(0).alias("i"), F.lit(1).alias("o")),
            )
        ).alias("m")
    ).select("m.*")
    return (
        marks.where("fecha IS NOT NULL")
        .groupBy("fecha")
        .agg(F.sum("i").alias("tickets_creados"), F.sum("o").alias("tickets_cerrados"))
        .orderBy("fecha")
    )


def backlog(facts: DataFrame, as_of=None) -> DataFrame:
    return facts.where("fecha_resolucion IS NULL").agg(
        F.count("*").alias("backlog_abierto"),
        F.round(F.avg(hours_between(F.col("fecha_creacion"), moment(as_of))), 1).alias(
            "edad_media_horas"
        ),
    )


def monthly(facts: DataFrame) -> DataFrame:
    # The month is cut from the text form: no formatter, no zone.
    month = F.left(F.col("fecha_creacion").cast("string"), F.lit(7))
    return (
        facts.groupBy(month.alias("ym"))
        .agg(
            F.count("*").alias("creados"),
            _mean("first_response_time_min", 1).alias("avg_frt_min"),
            _mean("time_to_resolution_min", 1).alias("avg_ttr_min"),
        )
        .orderBy("ym")
    )


def by_type(facts: DataFrame) -> DataFrame:
    """Tickets per real type with their share; tickets without a type are a group."""
    counted = facts.groupBy("id_tipo_real").agg(F.count("*").alias("n"))
    total = counted.agg(F.sum("n").alias("total"))  # over the groups: no second scan of facts
    types = F.broadcast(C.d_tipo(facts.sparkSession))
    return (
        counted.join(types, counted.id_tipo_real == types.id_tipo, "left")
        .join(F.broadcast(total))
        .select(
            F.col("codigo").alias("tipo"), "n",
            F.round(F.lit(100.0) * F.col("n") / F.col("total"), 2).alias("pct"),
        )
        .orderBy(F.desc("n"), "tipo")
    )


def incoherences(facts: DataFrame) -> DataFrame:
    return facts.where("fecha_resolucion < fecha_creacion")


def accuracy_by_channel(
    facts: DataFrame, predictions: DataFrame, modelo_version: str | None = None
) -> DataFrame:
    """Share of right predictions per channel; unlabelled tickets count in ``n_eval`` only."""
    chosen = predictions
    if modelo_version is not None:
        chosen = chosen.where(F.col("modelo_version") == modelo_version)
    right = F.when(
        F.col("id_tipo_real").isNotNull(),
        (F.col("id_tipo_predicho") == F.col("id_tipo_real")).cast("int"),
    )
    measured = (
        chosen.select("id_ticket", "id_tipo_predicho")
        .join(facts.select("id_ticket", "id_canal", "id_tipo_real"), "id_ticket")
        .groupBy("id_canal")
        .agg(
            # A missing prediction is a miss, as in the CASE the figure comes from.
            F.round(
                F.lit(100)
                * F.avg(F.when(F.col("id_tipo_real").isNotNull(), F.coalesce(right, F.lit(0)))),
                2,
            ).alias("accuracy_pct"),
            F.count("*").alias("n_eval"),
        )
    )
    return (
        measured.join(F.broadcast(C.d_canal(facts.sparkSession)), "id_canal")
        .select("canal", "accuracy_pct", "n_eval")
        .orderBy(F.desc("n_eval"), "canal")
    )
