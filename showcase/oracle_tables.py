"""The stand-in tables once more, as SQL common table expressions for DuckDB."""

from __future__ import annotations

from ticketry import catalogs as C

from .standins import (
    AS_OF, CHANNELS_RAW, DESCRIPTIONS, PRIORITIES_RAW, STATES_RAW, SUMMARIES,
)


def q(value) -> str:
    if value is None:
        return "NULL"
    return "'" + str(value).replace("'", "''") + "'" if isinstance(value, str) else str(value)


def listed(values) -> str:
    return "[" + ", ".join(q(v) for v in values) + "]"


def members(values) -> str:
    return "(" + ", ".join(q(v) for v in values) + ")"


def cases(col: str, pairs: dict, default: str = "NULL") -> str:
    body = " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in pairs.items())
    return f"CASE {col} {body} ELSE {default} END"


def chosen(key: str, words: dict[str, list[str]], default: str) -> str:
    body = " ".join(f"WHEN {key} IN {members(w)} THEN {q(v)}" for v, w in words.items())
    return f"CASE {body} ELSE {default} END"


def rows(values, name: str, columns: str) -> str:
    body = ", ".join("(" + ", ".join(q(v) for v in row) + ")" for row in values)
    return f"{name}({columns}) AS (VALUES {body})"


RAW = f"""
closes AS (SELECT l_orderkey, max(l_shipdate) AS closed FROM lineitem GROUP BY 1),
base AS (
  SELECT o_orderkey AS k, o_custkey, o_orderstatus, o_orderpriority, c_mktsegment, closed,
         o_orderdate + to_minutes(o_orderkey % 1440) AS opened
  FROM orders LEFT JOIN closes ON l_orderkey = o_orderkey
  LEFT JOIN customer ON c_custkey = o_custkey),
raw AS (
  SELECT k, o_custkey, CASE k % 3 WHEN 0 THEN 'kaggle_1' WHEN 1 THEN 'sintetico_2' ELSE 'sintetico' END AS fuente,
    CASE WHEN k % 97 = 0 THEN '' ELSE 'INC' || lpad(k::VARCHAR, 10, '0') END AS id_ticket,
    CASE WHEN k % 3 = 0 THEN {cases('c_mktsegment', {s: a for s, (a, _) in CHANNELS_RAW.items()})}
         ELSE {cases('c_mktsegment', {s: b for s, (_, b) in CHANNELS_RAW.items()})} END AS canal,
    CASE WHEN k % 211 = 0 THEN 'n/a' ELSE CASE k % 6
      WHEN 0 THEN strftime(opened, '%Y-%m-%d %H:%M:%S') WHEN 1 THEN strftime(opened, '%Y-%m-%d %H:%M')
      WHEN 2 THEN strftime(opened, '%Y-%m-%d') WHEN 3 THEN strftime(opened, '%d/%m/%Y %H:%M')
      WHEN 4 THEN strftime(opened, '%d-%m-%Y') ELSE strftime(opened, '%Y-%m-%dT%H:%M:%S') END END AS fecha_creacion,
    CASE WHEN k % 53 = 0 THEN '' ELSE strftime(opened + to_minutes(k % 481), '%Y-%m-%d %H:%M') END AS first_reply_at,
    coalesce(strftime(closed, '%Y-%m-%d %H:%M'), '') AS fecha_cierre,
    CASE WHEN k % 41 = 0 THEN 'RESUELTO' ELSE {cases('o_orderstatus', STATES_RAW)} END AS estado,
    {cases('o_orderpriority', PRIORITIES_RAW)} AS prioridad,
    CASE WHEN k % 13 = 0 THEN '' ELSE {listed(C.LABELS)}[k % 8 + 1] END AS categoria,
    'Agent-' || (k % 5 + 1) AS agente_id,
    CASE k % 4 WHEN 0 THEN '8' WHEN 1 THEN '24' WHEN 2 THEN '72' ELSE '120' END AS sla_target_horas,
    CASE k % 5 WHEN 0 THEN 'true' WHEN 1 THEN '="FALSE"' WHEN 2 THEN '''1' WHEN 3 THEN 'no' ELSE '' END AS sla_met,
    {listed(SUMMARIES)}[k % 16 + 1] AS resumen,
    {listed(DESCRIPTIONS)}[o_custkey % 16 + 1] AS descripcion
  FROM base)"""

FLEX_FORMATS = [
    "%Y-%m-%dT%H:%M:%S", "%Y-%m-%d %H:%M:%S", "%Y-%m-%d %H:%M", "%Y-%m-%d",
    "%d/%m/%Y %H:%M", "%d/%m/%Y", "%d-%m-%Y", "%m/%d/%Y",
]


def flex(col: str) -> str:
    return f"try_strptime(trim({col}), {listed(FLEX_FORMATS)})"


def minute(col: str) -> str:
    return f"coalesce(strftime({col}, '%Y-%m-%d %H:%M'), '')"


DOCS = r"\b(documentation|manual|knowledge\s*base|kb|documentaci[oó]n)\b"


def new_id() -> str:
    branches = []
    for source, (prefix, accepted) in C.SOURCE_PREFIXES.items():
        ready = " OR ".join(f"starts_with(lower(trim(id_ticket)), {q(a)})" for a in accepted)
        branches.append(
            f"WHEN fuente = {q(source)} THEN CASE WHEN trim(id_ticket) = '' THEN '{prefix}GEN' || (k + 1) "
            f"WHEN {ready} THEN trim(id_ticket) ELSE '{prefix}' || trim(id_ticket) END"
        )
    return "CASE " + " ".join(branches) + " END"


CHANNEL = (
    f"CASE WHEN regexp_matches(resumen || ' ' || descripcion, '{DOCS}', 'i') THEN 'PORTAL_DOCUMENTAL' "
    f"WHEN fuente = 'kaggle_1' THEN {chosen('lower(trim(canal))', C.CHANNEL_WORDS, q(C.CHANNEL_DEFAULT))} "
    "ELSE canal END"
)
PRIORITY = chosen("lower(trim(prioridad))", C.PRIORITY_WORDS, q(C.PRIORITY_DEFAULT))
STATE = chosen("lower(trim(estado))", C.STATE_WORDS, q(C.STATE_DEFAULT))
SLA = chosen(
    "ltrim(replace(replace(lower(trim(sla_met)), '=\"', ''), '\"', ''), '''')", C.SLA_WORDS, "''"
)

CLEAN = f"""{RAW},
clean AS (
  SELECT k, fuente, {new_id()} AS id_ticket, {CHANNEL} AS canal,
    {minute(flex('fecha_creacion'))} AS fecha_creacion, {minute(flex('first_reply_at'))} AS first_reply_at,
    {minute(flex('fecha_cierre'))} AS fecha_cierre, {STATE} AS estado, {PRIORITY} AS prioridad,
    categoria, agente_id, sla_target_horas, {SLA} AS sla_met, resumen, descripcion
  FROM raw)"""

# One column per state of the closing date; each rule reads the one before.
REPAIRED = f"""{CLEAN},
r0 AS (
  SELECT *, try_cast(nullif(fecha_creacion, '') AS TIMESTAMP) AS o, try_cast(nullif(first_reply_at, '') AS TIMESTAMP) AS f,
    try_cast(nullif(fecha_cierre, '') AS TIMESTAMP) AS c0 FROM clean),
r1 AS (SELECT *, CASE WHEN c0 > TIMESTAMP '{AS_OF}' THEN NULL ELSE c0 END AS c1 FROM r0),
r2 AS (SELECT *, CASE WHEN estado IN {members(C.OPEN_STATES)} THEN NULL ELSE c1 END AS c2 FROM r1),
r3 AS (SELECT *, CASE WHEN c2 < o THEN NULL ELSE c2 END AS c3 FROM r2),
r4 AS (SELECT *, CASE WHEN c3 < f AND estado IN {members(C.CLOSED_STATES)} THEN greatest(f, o)
                      WHEN c3 < f THEN NULL ELSE c3 END AS c4 FROM r3),
r5 AS (SELECT *, CASE WHEN c4 IS NULL AND estado IN {members(C.CLOSED_STATES)} THEN greatest(f, o) ELSE c4 END AS c5 FROM r4),
repaired AS (
  SELECT k, fuente, id_ticket, canal, fecha_creacion, first_reply_at, {minute('c5')} AS fecha_cierre, estado,
    prioridad, categoria, agente_id, sla_target_horas, sla_met, resumen, descripcion FROM r5)"""

STAGING = f"""{REPAIRED},
staging AS (
  SELECT *, CAST(NULL AS VARCHAR) AS predicted, CASE WHEN k % 7 = 0 THEN '' ELSE 'synt' END AS origen,
    CASE WHEN k % 11 = 0 THEN NULL ELSE id_ticket END AS id_origen FROM repaired)"""

STG_SLA = chosen("lower(trim(sla_met))", C.STAGING_SLA, "NULL")
CLEAN_STAGING = f"""{STAGING},
cleaned AS (
  SELECT k, id_ticket,
    CASE upper(trim(canal)) {' '.join(f"WHEN {q(a)} THEN {q(b)}" for a, b in C.STAGING_CHANNELS.items())} ELSE trim(canal) END AS canal,
    CASE WHEN lower(trim(prioridad)) IN {members(C.STAGING_URGENT)} THEN 'Urgente' ELSE trim(prioridad) END AS prioridad,
    CASE WHEN upper(trim(estado)) = 'ABIERTO' THEN 'Pendiente' ELSE trim(estado) END AS estado,
    trim(categoria) AS categoria, {STG_SLA} AS sla_met, fecha_creacion, first_reply_at, fecha_cierre,
    resumen, descripcion,
    CASE WHEN coalesce(origen, '') = '' OR coalesce(id_origen, '') = '' THEN 'manual' ELSE origen END AS origen,
    CASE WHEN coalesce(origen, '') = '' OR coalesce(id_origen, '') = '' THEN id_ticket ELSE id_origen END AS id_origen
  FROM staging)"""

DIMS = ",\n".join(
    [
        rows(C.CHANNELS, "d_canal", "id_canal, canal"),
        rows(C.PRIORITIES, "d_prioridad", "id_prioridad, prioridad"),
        rows(C.STATES, "d_estado", "id_estado, estado"),
        rows(C.TYPES, "d_tipo", "id_tipo, codigo, nombre"),
    ]
)
STG_FORMATS = ["%Y-%m-%d %H:%M:%S", "%Y-%m-%d %H:%M", "%Y-%m-%d"]


def stg_date(col: str) -> str:
    return f"try_strptime({col}, {listed(STG_FORMATS)})"


def folded(col: str) -> str:
    return f"lower(strip_accents({col}))"


FACTS = f"""{CLEAN_STAGING},
{DIMS},
dated AS (
  SELECT s.*, {stg_date('fecha_creacion')} AS fc, {stg_date('first_reply_at')} AS fr, {stg_date('fecha_cierre')} AS fz,
    dc.id_canal, dp.id_prioridad, de.id_estado, dt.id_tipo
  FROM cleaned s
  LEFT JOIN d_canal dc ON {folded('dc.canal')} = {folded('s.canal')}
  LEFT JOIN d_prioridad dp ON {folded('dp.prioridad')} = {folded('s.prioridad')}
  LEFT JOIN d_estado de ON {folded('de.estado')} = {folded('s.estado')}
  LEFT JOIN d_tipo dt ON {folded('dt.codigo')} = {folded('s.categoria')}),
f_tickets AS (
  SELECT k AS id_ticket, id_ticket AS ticket_code, id_canal, id_prioridad, id_estado, id_tipo AS id_tipo_real,
    resumen AS asunto, descripcion, fc AS fecha_creacion, fz AS fecha_resolucion,
    datesub('minute', fc, fr) AS first_response_time_min, datesub('minute', fc, fz) AS time_to_resolution_min,
    try_cast(sla_met AS INTEGER) AS sla_met
  FROM dated
  WHERE fc IS NOT NULL AND id_canal IS NOT NULL AND id_prioridad IS NOT NULL AND id_estado IS NOT NULL)"""

TYPE_IDS = {codigo: i for i, codigo, _ in C.TYPES}
PREDICTIONS = f"""
predictions AS (
  SELECT o_orderkey AS id_ticket, {listed([TYPE_IDS[c] for c in C.LABELS])}[(o_orderkey + (o_custkey % every = 0)::INT) % 8 + 1] AS id_tipo_predicho,
    CAST(0.5 + (o_orderkey % 50) / 100 AS DECIMAL(5,4)) AS score_predicho, modelo_version
  FROM orders, (VALUES ('v1.0', 4), ('v1.1', 6)) v(modelo_version, every) WHERE o_orderkey % 9 <> 0)"""
PREDICTED_CODES = f"""
predicted_codes AS (
  SELECT *, (real_cat = pred_cat)::INT AS ok FROM (
  SELECT o_orderkey AS id_ticket, {listed(C.LABELS)}[o_orderkey % 8 + 1] AS real_cat,
    {listed(C.LABELS)}[(o_orderkey + (CASE WHEN o_custkey % every = 0 THEN 1 + o_orderkey % 3 ELSE 0 END)) % 8 + 1] AS pred_cat,
    experimento, id_experimento, modelo_version, dataset
  FROM orders, (VALUES ('E1', 1, 'E1_NB', 'VALID', 4), ('E1', 1, 'E1_SVM', 'VALID', 6), ('L4', 3, 'SVM_v1.1', 'L4_manual', 5))
    v(experimento, id_experimento, modelo_version, dataset, every)))"""


def with_tables(tables: str, select: str) -> str:
    return f"WITH {tables.strip()}\n{select.strip()}"
