"""Staging to gold: cleaned staging, facts with rejects, lineage, reloads and views."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .. import catalogs as C
from ..functions import values
from ..functions.dates import minutes_between, moment, staging_datetime
from ..functions.ids import spread_row_number
from ..functions.text import match_key, model_text, ticket_label
from ..session import written

FACT_COLUMNS = [
    "id_ticket", "ticket_code", "id_canal", "id_prioridad", "id_estado", "id_tipo_real",
    "asunto", "descripcion", "fecha_creacion", "fecha_resolucion", "first_response_time_min",
    "time_to_resolution_min", "sla_met",
]
FACT_SCHEMA = (
    "id_ticket long, ticket_code string, id_canal int, id_prioridad int, id_estado int, id_tipo_real int,"
    " asunto string, descripcion string, fecha_creacion timestamp_ntz, fecha_resolucion timestamp_ntz,"
    " first_response_time_min long, time_to_resolution_min long, sla_met int"
)


def clean_staging(staging: DataFrame, default_origin: str = "manual") -> DataFrame:
    """Staging cells in the dimensions' spelling; lineage filled where it is incomplete."""
    blank_origin = (F.coalesce(F.col("origen"), F.lit("")) == "") | (
        F.coalesce(F.col("id_origen"), F.lit("")) == ""
    )
    return staging.withColumns(
        {
            "canal": values.staging_channel(F.col("canal")),
            "prioridad": values.staging_priority(F.col("prioridad")),
            "estado": values.staging_state(F.col("estado")),
            "categoria": F.trim("categoria"),
            "sla_met": values.staging_sla(F.col("sla_met")),
            "origen": F.when(blank_origin, F.lit(default_origin)).otherwise(F.col("origen")),
            "id_origen": F.when(blank_origin, F.col("id_ticket")).otherwise(F.col("id_origen")),
        }
    )


def _keyed(dim: DataFrame, label: str, key: str) -> DataFrame:
    return F.broadcast(dim.select(match_key(F.col(label)).alias(key), dim.columns[0]))


def resolve_dimensions(clean: DataFrame) -> DataFrame:
    """Dates parsed and labels looked up; ids stay null where a label is unknown.

    Labels compare without case and accents. The four dimensions hold 4 to 8 fixed rows.
    """
    spark = clean.sparkSession
    keyed = clean.withColumns(
        {
            "_canal": match_key(F.col("canal")),
            "_prioridad": match_key(F.col("prioridad")),
            "_estado": match_key(F.col("estado")),
            "_tipo": match_key(F.col("categoria")),
            "fc": staging_datetime(F.col("fecha_creacion")),
            "fr": staging_datetime(F.col("first_reply_at")),
            "fz": staging_datetime(F.col("fecha_cierre")),
        }
    )
    types = C.d_tipo(spark).select("id_tipo", "codigo")
    return (
        keyed.join(_keyed(C.d_canal(spark), "canal", "_canal"), "_canal", "left")
        .join(_keyed(C.d_prioridad(spark), "prioridad", "_prioridad"), "_prioridad", "left")
        .join(_keyed(C.d_estado(spark), "estado", "_estado"), "_estado", "left")
        .join(_keyed(types, "codigo", "_tipo"), "_tipo", "left")
    )


def _refusals() -> dict[str, Column]:
    return {
        "fecha_creacion": F.col("fc").isNull(),
        "canal": F.col("id_canal").isNull(),
        "prioridad": F.col("id_prioridad").isNull(),
        "estado": F.col("id_estado").isNull(),
    }


def promote(resolved: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Facts without surrogate key: only dated tickets with known channel, priority, state.

    ``keep`` names further columns to carry along.
    """
    wanted = F.lit(True)
    for refused in _refusals().values():
        wanted = wanted & ~refused
    return resolved.where(wanted).select(
        *(keep or []),
        F.col("id_ticket").alias("ticket_code"),
        "id_canal", "id_prioridad", "id_estado", F.col("id_tipo").alias("id_tipo_real"),
        F.col("resumen").alias("asunto"), "descripcion",
        F.col("fc").alias("fecha_creacion"), F.col("fz").alias("fecha_resolucion"),
        minutes_between(F.col("fc"), F.col("fr")).alias("first_response_time_min"),
        minutes_between(F.col("fc"), F.col("fz")).alias("time_to_resolution_min"),
        F.nullif(F.col("sla_met"), F.lit("")).try_cast("int").alias("sla_met"),
    )


def promotion_rejects(resolved: DataFrame) -> DataFrame:
    """Tickets the promotion leaves out, with every column that made it refuse them."""
    reasons = F.array_compact(
        F.array(*[F.when(test, F.lit(name)) for name, test in _refusals().items()])
    )
    return resolved.select("id_ticket", reasons.alias("motivos")).where(F.size("motivos") > 0)


def first_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of each key in ``order``, as an aggregate: copies of a key are reduced
    where they are read, so a key with very many rows never meets in one task."""
    rest = [c for c in df.columns if c not in keys and c not in order]
    row = F.struct(*order, *rest)
    return (
        df.groupBy(*keys).agg(F.min(row).alias("_first"))
        .select(*[F.col(c) if c in keys else F.col(f"_first.{c}").alias(c) for c in df.columns])
    )


def lineage(facts: DataFrame, staging: DataFrame, origin: str = "manual") -> DataFrame:
    """(ticket, origin, origin id), each once."""
    codes = staging.select(F.col("id_ticket").alias("ticket_code")).distinct()
    return (
        facts.select("id_ticket", "ticket_code")
        .join(codes, "ticket_code")
        .select("id_ticket", F.lit(origin).alias("origen"), F.col("ticket_code").alias("id_origen"))
    )


def append_lineage(existing: DataFrame, new: DataFrame) -> DataFrame:
    keys = ["id_ticket", "origen", "id_origen"]
    return existing.unionByName(new.distinct().join(existing.select(*keys), keys, "left_anti"))


def _without(existing: DataFrame, column: str, codes: DataFrame) -> DataFrame:
    return existing.join(codes, existing[column] == codes["_code"], "left_anti")


def staged_codes(staging: DataFrame) -> DataFrame:
    """Distinct codes of a load: repeated codes are reduced before they travel."""
    return staging.select(F.col("id_ticket").alias("_code")).where("_code IS NOT NULL").distinct()


def reload_facts(existing: DataFrame, staging: DataFrame, promoted: DataFrame) -> DataFrame:
    """The fact table after a load: rows of the staged codes are replaced, others stay.

    Known codes keep their number, so splits and predictions that hang on it survive; new
    tickets count on from the highest number. A code is unique: of a repeated one the earliest
    row is loaded, ``repeated_codes`` tells of the others. Tickets without a code are all
    loaded, and as a null code never meets an earlier load, each gets a new number.

    The load is reduced and meets the known codes once, and is written with what it met; the rows to
    number are read from there, so that their row keys stand still.
    """
    load = [c for c in FACT_COLUMNS if c != "id_ticket"]
    order = ["fecha_creacion", *[c for c in load if c not in ("ticket_code", "fecha_creacion")]]
    promoted = promoted.select(*load)
    coded = first_per_key(promoted.where("ticket_code IS NOT NULL"), ["ticket_code"], order)
    known = existing.where("ticket_code IS NOT NULL").select("ticket_code", "id_ticket", F.lit(True).alias("_known"))
    last = existing.agg(F.coalesce(F.max("id_ticket"), F.lit(C.FIRST_TICKET_ID - 1)).alias("_last"))
    met = written(
        coded.join(known, "ticket_code", "left")
        .unionByName(promoted.where("ticket_code IS NULL"), allowMissingColumns=True)
        .withColumn("_key", F.monotonically_increasing_id())
    )
    matched, fresh = met.where("_known"), met.where("_known IS NULL").drop("id_ticket", "_known")
    numbered = spread_row_number(fresh, "_key").join(F.broadcast(last)).withColumn(  # one row
        "id_ticket", (F.col("_last") + F.col("row_number")).cast("long")
    )
    kept = _without(existing, "ticket_code", staged_codes(staging))
    return (
        kept.select(*FACT_COLUMNS).unionByName(matched.select(*FACT_COLUMNS))
        .unionByName(numbered.select(*FACT_COLUMNS))
    )


def repeated_codes(promoted: DataFrame) -> DataFrame:
    """Rejects (id_ticket, motivos) of the rows whose code an earlier row of the load has."""
    counted = promoted.where("ticket_code IS NOT NULL").groupBy("ticket_code").agg(
        F.count("*").alias("_n")
    )
    return counted.where("_n > 1").select(
        F.col("ticket_code").alias("id_ticket"), F.array(F.lit("ticket_code")).alias("motivos"),
        F.explode(F.sequence(F.lit(2), F.col("_n"))).alias("_row"),
    ).drop("_row")


def reload_lineage(
    existing: DataFrame, facts_before: DataFrame, staging: DataFrame, renewed: DataFrame,
    origin: str = "manual",
) -> DataFrame:
    """Lineage after a load: entries of the replaced facts go, those of the new ones come."""
    replaced = facts_before.join(
        staged_codes(staging), F.col("ticket_code") == F.col("_code"), "left_semi"
    ).select("id_ticket")
    kept = existing.join(replaced, "id_ticket", "left_anti")
    return append_lineage(kept, lineage(renewed, staging, origin))


# --- views --------------------------------------------------------------------------------
def _labelled(facts: DataFrame) -> DataFrame:
    spark = facts.sparkSession
    return (
        facts.join(F.broadcast(C.d_canal(spark)), "id_canal")
        .join(F.broadcast(C.d_prioridad(spark)), "id_prioridad")
        .join(F.broadcast(C.d_estado(spark)), "id_estado")
    )


def ticket_view(facts: DataFrame) -> DataFrame:
    """Facts with their labels; tickets without a real type are kept."""
    types = F.broadcast(
        C.d_tipo(facts.sparkSession).select(
            F.col("id_tipo").alias("id_tipo_real"), F.col("nombre").alias("tipo_real")
        )
    )
    return _labelled(facts).join(types, "id_tipo_real", "left").select(
        "id_ticket", "ticket_code", "canal", "prioridad", "estado", "tipo_real", "asunto",
        "descripcion", "fecha_creacion", "fecha_resolucion", "first_response_time_min",
        "time_to_resolution_min", "sla_met",
    )


def model_view(facts: DataFrame) -> DataFrame:
    """Tickets as shown to a model user, each with a code to show."""
    return _labelled(facts).select(
        "id_ticket", ticket_label(F.col("ticket_code"), F.col("id_ticket")).alias("ticket_code"),
        "asunto", "descripcion", "canal", "prioridad", "estado", "sla_met",
    )


def text_view(facts: DataFrame) -> DataFrame:
    """Text, metadata and label of every ticket."""
    return facts.select(
        "id_ticket",
        model_text(F.col("asunto"), F.col("descripcion")).alias("texto"),
        "id_canal", "id_prioridad", "id_estado", "sla_met", "id_tipo_real",
    )


def training_view(facts: DataFrame) -> DataFrame:
    """Text, metadata and label of the labelled tickets."""
    return text_view(facts).where("id_tipo_real IS NOT NULL")


def pending_view(
    facts: DataFrame, predictions: DataFrame, modelo_version: str | None = None
) -> DataFrame:
    """Tickets without a prediction by any model, or by the given one."""
    done = predictions
    if modelo_version is not None:
        done = done.where(F.col("modelo_version") == modelo_version)
    return text_view(facts).drop("id_tipo_real").join(
        done.select("id_ticket"), "id_ticket", "left_anti"
    )


# --- predictions --------------------------------------------------------------------------
def load_predictions(
    staged: DataFrame, facts: DataFrame, modelo_version: str, as_of=None
) -> DataFrame:
    """Predicted codes (id_ticket, pred_cat) to rows of the prediction table."""
    types = F.broadcast(C.d_tipo(facts.sparkSession).select("id_tipo", "codigo"))
    staged = staged.select(F.col("id_ticket").alias("ticket_code"), "pred_cat")
    return (
        staged.join(facts.select("id_ticket", "ticket_code"), "ticket_code")
        .join(types, F.col("pred_cat") == F.col("codigo"))
        .select(
            "id_ticket", F.col("id_tipo").alias("id_tipo_predicho"),
            F.lit(None).cast("decimal(5,4)").alias("score_predicho"),
            F.lit(modelo_version).alias("modelo_version"),
            moment(as_of).alias("fecha_inferencia"),
        )
    )


def replace_version(existing: DataFrame, new: DataFrame, modelo_version: str) -> DataFrame:
    """The prediction table with one model version exchanged."""
    others = existing.where(~F.col("modelo_version").eqNullSafe(F.lit(modelo_version)))
    return others.unionByName(new)


def evaluation_view(
    facts: DataFrame, predictions: DataFrame, modelo_version: str | None = None
) -> DataFrame:
    """Real against predicted type per labelled ticket; the hit flag is null when unscored."""
    if modelo_version is not None:
        predictions = predictions.where(F.col("modelo_version") == modelo_version)
    spark = facts.sparkSession
    real = F.broadcast(
        C.d_tipo(spark).select(F.col("id_tipo").alias("id_tipo_real"), F.col("codigo").alias("real_cat"))
    )
    predicted = F.broadcast(
        C.d_tipo(spark).select(
            F.col("id_tipo").alias("id_tipo_predicho"), F.col("codigo").alias("pred_cat")
        )
    )
    scored = predictions.select("id_ticket", "id_tipo_predicho", "score_predicho", "modelo_version")
    hit = F.when(F.col("id_tipo_predicho").isNull(), F.lit(None)).otherwise(
        (F.col("id_tipo_real") == F.col("id_tipo_predicho")).cast("int")
    )
    return (
        facts.select("id_ticket", "ticket_code", "id_tipo_real")
        .join(real, "id_tipo_real")
        .join(scored, "id_ticket", "left")
        .join(predicted, "id_tipo_predicho", "left")
        .select(
            "id_ticket", "ticket_code", "id_tipo_real", "real_cat", "id_tipo_predicho",
            "pred_cat", "score_predicho", "modelo_version", hit.alias("es_acierto"),
        )
    )
