"""Closed lists of the ticket model. They must read exactly like this."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .functions.text import quoted

# --- canonical ticket -------------------------------------------------------------------
TICKET_COLUMNS = [
    "id_ticket", "canal", "fecha_creacion", "first_reply_at", "fecha_cierre", "estado",
    "prioridad", "categoria", "agente_id", "sla_target_horas", "sla_met", "resumen",
    "descripcion",
]
STAGING_COLUMNS = [*TICKET_COLUMNS, "predicted", "origen", "id_origen"]

# Accepted spellings of each canonical header, after header normalisation.
HEADER_ALIASES = {
    "id_ticket": ["ticket_id", "number"],
    "canal": ["channel", "contact_type", "ticket_channel"],
    "fecha_creacion": ["date", "created_at", "creation_date", "open_date", "created"],
    "first_reply_at": [
        "first_response_time", "first_response", "response_time", "first_contact_date",
    ],
    "fecha_cierre": [
        "resolved_at", "time_to_resolution", "closed_at", "resolution_date", "close_date",
        "resolved",
    ],
    "estado": ["status", "ticket_status", "state"],
    "prioridad": ["priority", "ticket_priority"],
    "agente_id": ["agent", "agent_id", "assignee", "owner"],
    "sla_target_horas": ["sla_target_hours", "sla_target"],
    "resumen": ["subject", "short_description", "ticket_subject"],
    "descripcion": ["content", "description", "ticket_description", "body"],
}

# --- value maps (lower-cased input -> catalogue value) ------------------------------------
CHANNEL_WORDS = {
    "PORTAL_SOPORTE": ["chat", "self-service", "self service"],
    "EMAIL": ["mail", "email"],
    "PORTAL_INTERNO": ["phone"],
}
CHANNEL_DEFAULT = "PORTAL_SOPORTE"
DOCUMENT_CHANNEL = "PORTAL_DOCUMENTAL"
DOCUMENT_WORDS = r"documentation|manual|knowledge\s*base|kb|documentaci[oó]n"
PRIORITY_WORDS = {
    "Urgente": ["critical", "critica", "crítica", "p1"],
    "Alta": ["high", "alta", "urgent", "p2"],
    "Media": ["medium", "media", "normal", "p3"],
    "Baja": ["low", "baja", "minor", "p4"],
}
PRIORITY_DEFAULT = "Media"
STATE_WORDS = {
    "Abierto": ["open", "abierto", "pendiente", "new"],
    "En curso": ["in progress", "en progreso", "en curso", "working"],
    "Resuelto": ["resolved", "resuelto"],
    "Cerrado": ["closed", "cerrado", "done"],
    "Reabierto": ["reopened", "reabierto"],
}
STATE_DEFAULT = "Abierto"
OPEN_STATES = ["Abierto", "En curso", "Reabierto"]
CLOSED_STATES = ["Cerrado", "Resuelto"]
SLA_WORDS = {
    "true": ["true", "verdadero", "v", "1", "yes", "y"],
    "false": ["false", "falso", "f", "0", "no", "n"],
}

# Staging spellings of the dimension labels.
STAGING_CHANNELS = {
    "PORTAL_SOPORTE": "Portal Soporte General",
    "PORTAL_INTERNO": "Portal Interno",
    "PORTAL_DOCUMENTAL": "Portal Documental",
    "EMAIL": "Email",
}
STAGING_URGENT = ["crítica", "critica", "p1", "critical"]
STAGING_SLA = {"1": ["true", "verdadero", "1"], "0": ["false", "falso", "0"]}

# --- sources ------------------------------------------------------------------------------
# prefix given to an id, and the prefixes that are already good
SOURCE_PREFIXES = {
    "kaggle_1": ("kaggle1_", ["kaggle1_", "k1_"]),
    "sintetico_2": ("synt2_", ["synt2_", "synt3_", "synt_"]),
    "sintetico": ("synt_", ["synt_", "synt2_", "synt3_"]),
}
MAPPED_CHANNEL_SOURCE = "kaggle_1"

# --- dimensions ---------------------------------------------------------------------------
CHANNELS = [
    (1, "Email"), (2, "Portal Soporte General"), (3, "Portal Documental"), (4, "Portal Interno"),
]
PRIORITIES = [(1, "Baja"), (2, "Media"), (3, "Alta"), (4, "Urgente")]
STATES = [(1, "Pendiente"), (2, "En curso"), (3, "Resuelto"), (4, "Cerrado"), (5, "Reabierto")]
TYPES = [
    (1, "ACC", "Acceso y credenciales"),
    (2, "SW", "Software"),
    (3, "HW", "Hardware"),
    (4, "NET", "Red y conectividad"),
    (5, "MAIL", "Correo electrónico"),
    (6, "APP", "Aplicaciones internas"),
    (7, "SRV", "Servidores/infraestructura"),
    (8, "POL", "Políticas y procedimientos"),
]
LABELS = ["ACC", "APP", "HW", "MAIL", "NET", "POL", "SRV", "SW"]
FIRST_TICKET_ID = 401

# --- experiments and models ---------------------------------------------------------------
EXPERIMENTS = [
    (1, "E1", "Baselines solo texto (NB, RL, SVM) sobre VALID", "VALID"),
    (2, "E2", "Baselines texto + metadatos (NB, RL, SVM) sobre VALID", "VALID"),
    (3, "L4", "Evaluación manual 50 tickets etiquetados (SVM_v1.1)", "L4_manual"),
]
MODELS = [
    ("E1_NB", "Naive Bayes Multinomial (E1, solo texto)", "MultinomialNB",
     "TF-IDF texto; alpha=1.0"),
    ("E1_RL", "Regresión Logística (E1, solo texto)", "LogisticRegression",
     "TF-IDF texto; solver=lbfgs"),
    ("E1_SVM", "SVM lineal (E1, solo texto)", "LinearSVC", "TF-IDF texto; C=2.0"),
    ("E2_SVM", "SVM lineal (E2, texto + canal/prioridad)", "LinearSVC", "TF-IDF + metadatos"),
    ("SVM_v1.1", "SVM lineal reentrenado", "LinearSVC",
     "TF-IDF texto; C=1.0; TRAIN + errores de L1"),
]
WEAK_LABELS = ["NET", "SRV", "POL"]
REAL_COLUMNS = ["real_cat", "categoria", "y_true", "label", "real"]
PREDICTED_COLUMNS = ["pred_cat", "prediccion", "y_pred", "label_pred", "pred"]


def _literal(value) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, str):
        return quoted(value)
    return repr(value)


def inline_table(spark: SparkSession, rows, columns: list[str]) -> DataFrame:
    """A handful of fixed rows as a local relation, whose size Spark knows at plan time."""
    body = ", ".join("(" + ", ".join(_literal(v) for v in row) + ")" for row in rows)
    return spark.sql(f"SELECT * FROM VALUES {body} AS t({', '.join(columns)})")


def d_canal(spark: SparkSession) -> DataFrame:
    return inline_table(spark, CHANNELS, ["id_canal", "canal"])


def d_prioridad(spark: SparkSession) -> DataFrame:
    return inline_table(spark, PRIORITIES, ["id_prioridad", "prioridad"])


def d_estado(spark: SparkSession) -> DataFrame:
    return inline_table(spark, STATES, ["id_estado", "estado"])


def d_tipo(spark: SparkSession) -> DataFrame:
    return inline_table(spark, TYPES, ["id_tipo", "codigo", "nombre"])


def d_modelo(spark: SparkSession) -> DataFrame:
    return inline_table(
        spark, MODELS, ["modelo_version", "descripcion", "algoritmo", "params_resumen"]
    )


def ml_experimento(spark: SparkSession) -> DataFrame:
    return inline_table(
        spark, EXPERIMENTS, ["id_experimento", "codigo", "descripcion", "dataset_origen"]
    )


def add_missing(existing: DataFrame, seeds: DataFrame, key: str) -> DataFrame:
    """Seed a dimension without touching rows whose key is already there."""
    return existing.unionByName(seeds.join(existing.select(key), key, "left_anti"))
