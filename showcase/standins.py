"""Ticket tables derived from the test tables, so that every query grows with them.

Orders play the tickets: customers give the channel, line items the closing date.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ticketry import catalogs as C
from ticketry.functions.text import quoted
from ticketry.operators.normalize import clean_values
from ticketry.operators.repair import repair_closing_dates
from ticketry.operators.warehouse import (
    FACT_COLUMNS, clean_staging, promote, resolve_dimensions,
)

AS_OF = "2000-06-30 00:00:00"

SUMMARIES = [
    "No puedo iniciar sesion en el portal",
    "VPN drops every hour",
    "Outlook rejects my password",
    "Instalación del driver de la impresora",
    "Necesito acceso al informe",
    "Printer: paper jam again",
    "Consulta del manual de compras",
    "Jira project board is empty",
    "Pérdida de paquetes en la oficina",
    "Quarantined file reported",
    "Power BI dataset does not refresh",
    "Solicitud de alta, usuario nuevo",
    "Teclado y ratón sin respuesta",
    "knowledge base article outdated",
    "Nada urgente que contar",
    "Buzón lleno desde ayer",
]
DESCRIPTIONS = [
    "Restablecer contraseña y autenticación MFA, gracias.",
    "The switched port shows packet loss and high latency.",
    "Shared mailbox over IMAP gives delivery failed.",
    "La actualización termina con runtime error.\nAdjunto captura.",
    "Please grant access to the sharepoint site.",
    "Battery not charging since Monday; the dock is fine.",
    "Busco la documentación del procedimiento.",
    "Oracle database login hangs, oracle client updated.",
    "Wifi con 802.1x y dns server caido.",
    "Microsoft Defender shows threat detected.",
    "The intranet   corporativa is slow for everyone.",
    "Dar de alta con permiso de acceso, nueva peticion.",
    "El portátil no enciende tras la reunion.",
    "See the KB entry about the proxy.",
    "Sin mas datos por ahora.",
    "La firma del correo sale mal en e-mail externo.",
]
CHANNELS_RAW = {
    "BUILDING": ("email", "EMAIL"),
    "AUTOMOBILE": ("chat", "PORTAL_SOPORTE"),
    "MACHINERY": ("Self-Service", "portal_documental"),
    "HOUSEHOLD": ("phone", "Portal Interno"),
    "FURNITURE": ("fax", "fax"),
}
PRIORITIES_RAW = {
    "1-URGENT": "critical", "2-HIGH": "High", "3-MEDIUM": "media", "4-NOT SPECIFIED": "",
    "5-LOW": "p4",
}
STATES_RAW = {"F": "closed", "O": "open", "P": "in progress"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(*columns)


def orders_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders, dealt by their key: the join with the line items needs them so."""
    return table(spark, sf_dir, "orders").repartition("o_orderkey")


def _pick(values: list[str], position: str) -> str:
    return f"element_at(array({', '.join(map(quoted, values))}), cast({position} AS int) + 1)"


def _cases(subject: str, pairs: dict) -> str:
    branches = " ".join(
        f"WHEN {k if isinstance(k, int) else quoted(k)} THEN {quoted(v)}" for k, v in pairs.items()
    )
    return f"CASE {subject} {branches} END"


def tickets_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw tickets of three sources with mixed spellings. ``k`` is the row's position."""
    closes = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(
        F.max("l_shipdate").alias("closed")
    )
    orders = (
        orders_table(spark, sf_dir)
        .join(closes, F.col("o_orderkey") == F.col("l_orderkey"), "left")
        .join(
            table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment"),
            F.col("o_custkey") == F.col("c_custkey"), "left",
        )
    )
    mapped = _cases("c_mktsegment", {s: a for s, (a, _) in CHANNELS_RAW.items()})
    direct = _cases("c_mktsegment", {s: b for s, (_, b) in CHANNELS_RAW.items()})
    return orders.withColumns(
        {
            "k": F.col("o_orderkey"),
            "opened": F.expr("o_orderdate + make_dt_interval(0, 0, cast(o_orderkey % 1440 AS int), 0)"),
            "replied": F.expr(
                "o_orderdate + make_dt_interval(0, 0, cast(o_orderkey % 1440 + o_orderkey % 481 AS int), 0)"
            ),
        }
    ).selectExpr(
        "k",
        "o_custkey",
        f"{_cases('k % 3', {0: 'kaggle_1', 1: 'sintetico_2', 2: 'sintetico'})} AS fuente",
        "if(k % 97 = 0, '', concat('INC', lpad(cast(k AS string), 10, '0'))) AS id_ticket",
        f"if(k % 3 = 0, {mapped}, {direct}) AS canal",
        "if(k % 211 = 0, 'n/a', CASE k % 6 WHEN 0 THEN date_format(opened, 'yyyy-MM-dd HH:mm:ss')"
        " WHEN 1 THEN date_format(opened, 'yyyy-MM-dd HH:mm')"
        " WHEN 2 THEN date_format(opened, 'yyyy-MM-dd')"
        " WHEN 3 THEN date_format(opened, 'dd/MM/yyyy HH:mm')"
        " WHEN 4 THEN date_format(opened, 'dd-MM-yyyy')"
        " ELSE date_format(opened, \"yyyy-MM-dd'T'HH:mm:ss\") END) AS fecha_creacion",
        "if(k % 53 = 0, '', date_format(replied, 'yyyy-MM-dd HH:mm')) AS first_reply_at",
        "coalesce(date_format(closed, 'yyyy-MM-dd HH:mm'), '') AS fecha_cierre",
        f"if(k % 41 = 0, 'RESUELTO', {_cases('o_orderstatus', STATES_RAW)}) AS estado",
        f"{_cases('o_orderpriority', PRIORITIES_RAW)} AS prioridad",
        f"if(k % 13 = 0, '', {_pick(C.LABELS, 'k % 8')}) AS categoria",
        "concat('Agent-', cast(k % 5 + 1 AS string)) AS agente_id",
        f"{_cases('k % 4', {0: '8', 1: '24', 2: '72', 3: '120'})} AS sla_target_horas",
        f"""{_cases('k % 5', {0: 'true', 1: '="FALSE"', 2: "'1", 3: 'no', 4: ''})} AS sla_met""",
        f"{_pick(SUMMARIES, 'k % 16')} AS resumen",
        f"{_pick(DESCRIPTIONS, 'o_custkey % 16')} AS descripcion",
    )


def tickets_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned, not classified; keeps ``k``, ``fuente`` and the planted ``categoria``."""
    raw = tickets_raw(spark, sf_dir)
    return clean_values(raw, F.col("fuente"), F.col("k")).drop("o_custkey")


def tickets_repaired(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair_closing_dates(tickets_clean(spark, sf_dir), AS_OF)


def staging(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The labelled staging table; lineage is missing in part."""
    k = F.col("k")
    return (
        tickets_repaired(spark, sf_dir)
        .drop("cambios")
        .withColumns(
            {
                "predicted": F.lit(None).cast("string"),
                "origen": F.when(k % 7 == 0, F.lit("")).otherwise(F.lit("synt")),
                "id_origen": F.when(k % 11 == 0, F.lit(None)).otherwise(F.col("id_ticket")),
            }
        )
    )


def resolved(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resolve_dimensions(clean_staging(staging(spark, sf_dir)))


def facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """f_tickets; the number is the order's key."""
    return facts_of(resolved(spark, sf_dir))


def staged_facts(staged: DataFrame) -> DataFrame:
    """f_tickets of a staging table."""
    return facts_of(resolve_dimensions(clean_staging(staged)))


def facts_of(load: DataFrame) -> DataFrame:
    return promote(load, keep=["k"]).withColumnRenamed("k", "id_ticket").select(*FACT_COLUMNS)


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two model versions over the same tickets; every ninth ticket is unscored."""
    ids = {codigo: i for i, codigo, _ in C.TYPES}
    listed = ", ".join(str(ids[c]) for c in C.LABELS)
    return (
        table(spark, sf_dir, "orders")
        .where("o_orderkey % 9 != 0")
        .selectExpr(
            "o_orderkey AS id_ticket", "o_custkey",
            "inline(array(struct('v1.0' AS modelo_version, 4 AS every),"
            " struct('v1.1' AS modelo_version, 6 AS every)))",
        )
        .selectExpr(
            "id_ticket",
            f"element_at(array({listed}), cast((id_ticket + if(o_custkey % every = 0, 1, 0)) % 8 AS int) + 1)"
            " AS id_tipo_predicho",
            "cast(0.5 + (id_ticket % 50) / 100 AS decimal(5,4)) AS score_predicho",
            "modelo_version",
        )
    )


def predicted_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predictions as files hold them: real and predicted codes of three experiments."""
    names = "experimento", "id_experimento", "modelo_version", "dataset", "every"
    runs = [
        ("E1", 1, "E1_NB", "VALID", 4), ("E1", 1, "E1_SVM", "VALID", 6),
        ("L4", 3, "SVM_v1.1", "L4_manual", 5),
    ]
    structs = ", ".join(
        "struct("
        + ", ".join(f"{quoted(v) if isinstance(v, str) else v} AS {n}" for n, v in zip(names, run))
        + ")"
        for run in runs
    )
    shift = "if(o_custkey % every = 0, 1 + id_ticket % 3, 0)"
    return (
        table(spark, sf_dir, "orders")
        .selectExpr("o_orderkey AS id_ticket", "o_custkey", f"inline(array({structs}))")
        .selectExpr(
            "id_ticket", f"{_pick(C.LABELS, 'id_ticket % 8')} AS real_cat",
            f"{_pick(C.LABELS, f'(id_ticket + {shift}) % 8')} AS pred_cat", *names[:4],
        )
        .withColumn("ok", F.expr("cast(real_cat = pred_cat AS int)"))
    )


def labelled_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as a training set: the language is the class, quality the priority."""
    docs = documents(spark, sf_dir, "doc_id", "text", "lang", "source")
    marks = table(spark, sf_dir, "labels").select("doc_id", "quality")
    return docs.join(marks, "doc_id", "left").select(
        F.col("doc_id").alias("id_ticket"), F.col("text").alias("texto"),
        F.col("lang").alias("real_cat"), F.col("source").alias("canal"),
        F.coalesce(F.col("quality").cast("string"), F.lit("")).alias("prioridad"),
    )
