"""SQL twins of the registered queries, for DuckDB over the same tables."""

from __future__ import annotations

import re

from ticketry import catalogs as C
from ticketry.operators.quality import CATALOGUE, CATEGORY_SHARES, STAGING_LENGTHS
from ticketry.vocabulary import (
    CATEGORIES, CONTEXT_RULES, TIE_ORDER, WILDCARD_TERMS, default_terms,
)

from . import oracle_tables as T
from .oracle_tables import folded, members, q, rows, with_tables
from .standins import AS_OF

ORACLES: dict[str, str] = {}

SLA1 = "round(100.0 * count(*) FILTER (sla_met = 1) / nullif(count(*) FILTER (sla_met IN (0, 1)), 0), 1)"
OPEN = "count(*) FILTER (fecha_resolucion IS NULL)"


def facts(select: str) -> str:
    return with_tables(T.FACTS, select)


def raw(select: str) -> str:
    return with_tables(T.RAW, select)


def stamp(col: str) -> str:
    return f"strftime({col}, '%Y-%m-%d %H:%M:%S')"


# --- KPIs ---------------------------------------------------------------------------------
ORACLES["kpi_overview"] = facts(f"""
SELECT count(*) AS total_tickets, count(fecha_resolucion) AS cerrados, {OPEN} AS abiertos, {SLA1} AS sla_ok_pct,
  round(avg(first_response_time_min), 4) AS avg_frt_min, round(avg(time_to_resolution_min), 4) AS avg_ttr_min FROM f_tickets""")
ORACLES["kpi_by_channel"] = facts(f"""
SELECT c.canal, count(*) AS n, {OPEN} AS abiertos, {SLA1} AS sla_ok_pct,
  round(avg(first_response_time_min), 4) AS avg_frt_min, round(avg(time_to_resolution_min), 4) AS avg_ttr_min
FROM f_tickets f JOIN d_canal c USING (id_canal) GROUP BY c.canal""")
ORACLES["kpi_by_priority"] = facts(f"""
SELECT p.prioridad, count(*) AS n, {OPEN} AS abiertos, round(100 * avg(sla_met), 2) AS sla_ok_pct,
  round(avg(first_response_time_min), 1) AS avg_frt_min, round(avg(time_to_resolution_min), 1) AS avg_ttr_min
FROM f_tickets f JOIN d_prioridad p USING (id_prioridad) GROUP BY p.prioridad""")


def flow(opened: str, closed: str, source: str) -> str:
    return f"""
SELECT CAST(fecha AS VARCHAR) AS fecha, CAST(sum(i) AS BIGINT) AS tickets_creados, CAST(sum(o) AS BIGINT) AS tickets_cerrados FROM (
  SELECT {opened}::DATE AS fecha, count(*) AS i, 0 AS o FROM {source} GROUP BY 1
  UNION ALL
  SELECT {closed}::DATE, 0, count(*) FROM {source} WHERE {closed} IS NOT NULL GROUP BY 1) GROUP BY fecha"""


ORACLES["kpi_daily_flow"] = facts(flow("fecha_creacion", "fecha_resolucion", "f_tickets"))
ORACLES["kpi_daily_flow_events"] = (
    "WITH e AS (SELECT ts, CASE WHEN event_type <> 'error' THEN ts END AS done FROM events)"
    + flow("ts", "done", "e")
)
ORACLES["kpi_backlog"] = facts(f"""
SELECT count(*) AS backlog_abierto, round(avg(datesub('hour', fecha_creacion, TIMESTAMP '{AS_OF}')), 1) AS edad_media_horas
FROM f_tickets WHERE fecha_resolucion IS NULL""")
ORACLES["kpi_monthly"] = facts("""
SELECT strftime(fecha_creacion, '%Y-%m') AS ym, count(*) AS creados, round(avg(first_response_time_min), 1) AS avg_frt_min,
  round(avg(time_to_resolution_min), 1) AS avg_ttr_min FROM f_tickets GROUP BY 1""")
ORACLES["kpi_by_type"] = facts("""
SELECT t.codigo AS tipo, count(*) AS n, round(100.0 * count(*) / (SELECT count(*) FROM f_tickets), 2) AS pct
FROM f_tickets f LEFT JOIN d_tipo t ON t.id_tipo = f.id_tipo_real GROUP BY 1""")
ORACLES["kpi_incoherences"] = with_tables(T.CLEAN, f"""
SELECT id_ticket, {stamp('o')} AS fecha_creacion, {stamp('c')} AS fecha_resolucion FROM (
  SELECT k AS id_ticket, try_cast(nullif(fecha_creacion, '') AS TIMESTAMP) AS o,
         try_cast(nullif(fecha_cierre, '') AS TIMESTAMP) AS c FROM clean) WHERE c < o""")
ORACLES["kpi_incoherences_repaired"] = facts(
    "SELECT count(*) AS n FROM f_tickets WHERE fecha_resolucion < fecha_creacion"
)
ORACLES["kpi_accuracy_by_channel"] = with_tables(T.FACTS + "," + T.PREDICTIONS, """
SELECT c.canal, round(100 * avg(CASE WHEN f.id_tipo_real IS NULL THEN NULL WHEN p.id_tipo_predicho = f.id_tipo_real THEN 1 ELSE 0 END), 2) AS accuracy_pct,
  count(*) AS n_eval FROM predictions p JOIN f_tickets f USING (id_ticket) JOIN d_canal c USING (id_canal) GROUP BY c.canal""")

# --- cleaning -----------------------------------------------------------------------------
MAPPED = T.chosen("lower(trim(canal))", C.CHANNEL_WORDS, q(C.CHANNEL_DEFAULT))
ABOUT_DOCS = f"regexp_matches(resumen || ' ' || descripcion, '{T.DOCS}', 'i')"
ORACLES["clean_channel"] = raw(f"""
SELECT k, {MAPPED} AS canal, CASE WHEN {ABOUT_DOCS} THEN 'PORTAL_DOCUMENTAL' ELSE {MAPPED} END AS canal_final FROM raw""")
ORACLES["clean_priority"] = raw(f"SELECT k, {T.PRIORITY} AS prioridad FROM raw")
ORACLES["clean_state"] = raw(f"SELECT k, {T.STATE} AS estado FROM raw")
ORACLES["clean_sla"] = raw(f"SELECT k, {T.SLA} AS sla_met FROM raw")
ORACLES["channel_from_text"] = raw(rf"""
SELECT k, CASE WHEN contains(t, '@') OR regexp_matches(t, '\b(e-?mail|mail|correo)\b') THEN 'EMAIL'
  WHEN {ABOUT_DOCS} THEN 'PORTAL_DOCUMENTAL'
  WHEN regexp_matches(t, '\b(phone|call|legal|agent|internal)\b') THEN 'PORTAL_INTERNO' ELSE 'PORTAL_SOPORTE' END AS canal
FROM (SELECT *, lower(resumen || ' | ' || descripcion) AS t FROM raw)""")
ORACLES["clean_staging"] = with_tables(
    T.CLEAN_STAGING,
    "SELECT k, canal, prioridad, estado, categoria, sla_met, origen, id_origen FROM cleaned",
)
ORACLES["build_ids"] = with_tables(T.CLEAN, "SELECT k, fuente, id_ticket FROM clean")
ORACLES["row_positions"] = (
    "SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS posicion FROM orders"
)
ORACLES["surrogate_keys"] = with_tables(T.CLEAN, f"""
SELECT id_ticket AS ticket_code, row_number() OVER (ORDER BY md5(id_ticket), id_ticket) + {C.FIRST_TICKET_ID - 1} AS id_ticket
FROM (SELECT DISTINCT id_ticket FROM clean)""")
ORACLES["parse_dates_flex"] = raw(f"""
SELECT k, {stamp(T.flex('fecha_creacion'))} AS creacion, {stamp(T.flex('first_reply_at'))} AS respuesta,
  {stamp(T.flex('fecha_cierre'))} AS cierre FROM raw""")
LADDER = T.listed([
    "%Y-%m-%d %H:%M:%S", "%Y-%m-%d %H:%M", "%Y-%m-%d", "%d/%m/%Y %H:%M:%S", "%d/%m/%Y %H:%M",
    "%d/%m/%Y", "%d-%m-%Y %H:%M:%S", "%d-%m-%Y %H:%M", "%d-%m-%Y",
])


def ladder(col: str) -> str:
    return stamp(f"try_strptime(replace({col}, 'T', ' '), {LADDER})")


ORACLES["parse_dates_sql"] = raw(f"""
SELECT k, {ladder('fecha_creacion')} AS creacion, {ladder('first_reply_at')} AS respuesta,
  {ladder('fecha_cierre')} AS cierre FROM raw""")
ORACLES["merge_alias_columns"] = raw(
    "SELECT k AS numero, CASE WHEN k % 2 = 0 THEN descripcion ELSE resumen END AS resumen, prioridad FROM raw"
)


# --- classification -----------------------------------------------------------------------
def term_regex(term: str) -> str:
    body = term if term in WILDCARD_TERMS else re.escape(term).replace("\\ ", r"\s+")
    return rf"(^|[^\pL\pN_]){body}($|[^\pL\pN_])"


def has(term: str) -> str:
    return f"regexp_matches(t, {q(term_regex(term))})"


def score(category: str, kinds=("base", "boost", "penalty")) -> str:
    parts = [
        f"CASE WHEN {has(t.term)} THEN {t.weight} ELSE 0 END"
        for t in default_terms() if t.category == category and t.kind in kinds
    ]
    return "(" + " + ".join(parts) + ")::DOUBLE" if parts else "0::DOUBLE"


def hits(kind: str) -> str:
    return "(" + " + ".join(
        f"{has(t.term)}::INT" for t in default_terms() if t.kind == kind
    ) + ")"


SCORE_COLUMNS = ", ".join(f"{score(c)} AS {c}" for c in CATEGORIES)


def adjusted(category: str) -> str:
    out = category
    for i, rule in enumerate(CONTEXT_RULES):
        if rule.prefer == category:
            out += f" + CASE WHEN rule{i} THEN {rule.boost}::DOUBLE ELSE 0 END"
        if category in rule.demote:
            out += f" - CASE WHEN rule{i} THEN {rule.boost / 2}::DOUBLE ELSE 0 END"
    return out


RULE_COLUMNS = ", ".join(
    "(" + " OR ".join(f"contains(t, {q(trigger)})" for trigger in rule.triggers) + f") AS rule{i}"
    for i, rule in enumerate(CONTEXT_RULES)
)
TOP = "greatest(" + ", ".join(f"a_{c}" for c in CATEGORIES) + ")"
DECISION = (
    f"CASE WHEN {TOP} <= 0 THEN 'SRV' "
    + " ".join(f"WHEN abs(a_{c} - {TOP}) < 1e-12 THEN '{c}'" for c in TIE_ORDER)
    + " END"
)


def scored(texts: str) -> str:
    """From a table ``texts`` of distinct t: scores before and after the rules."""
    return f"""{texts},
scored AS (SELECT t0, {SCORE_COLUMNS}, {hits('boost')} AS boost_hits, {hits('penalty')} AS penalty_hits, {RULE_COLUMNS}
  FROM (SELECT t0, {folded('t0')} AS t FROM texts)),
judged AS (SELECT *, {', '.join(f'{adjusted(c)} AS a_{c}' for c in CATEGORIES)} FROM scored)"""


TICKET_TEXTS = f"""{T.RAW},
told AS (SELECT *, resumen || ' | ' || descripcion AS t0 FROM raw),
texts AS (SELECT DISTINCT t0 FROM told)"""
TICKET_SCORES = scored(TICKET_TEXTS)
ORACLES["keyword_scores"] = with_tables(TICKET_SCORES, f"""
SELECT k, {', '.join(f'round({c}, 4) AS {c.lower()}' for c in CATEGORIES)}, boost_hits, penalty_hits
FROM told JOIN judged USING (t0)""")
CHANGED = " OR ".join(f"{c} <> a_{c}" for c in CATEGORIES)
ORACLES["context_scores"] = with_tables(TICKET_SCORES, f"""
SELECT k, {', '.join(f'round(a_{c}, 4) AS {c.lower()}' for c in CATEGORIES)}, ({CHANGED}) AS context_changed
FROM told JOIN judged USING (t0)""")
ORACLES["categorize"] = with_tables(
    TICKET_SCORES, f"SELECT k, {DECISION} AS categoria FROM told JOIN judged USING (t0)"
)
ORACLES["categorize_documents"] = with_tables(
    scored("told AS (SELECT doc_id, ' | ' || text AS t0 FROM documents), texts AS (SELECT DISTINCT t0 FROM told)"),
    f"""
SELECT doc_id, {', '.join(f'round(a_{c}, 4) AS {c.lower()}' for c in CATEGORIES)}, {DECISION} AS categoria
FROM told JOIN judged USING (t0)""",
)
WORDS_ONLY = {}
for _t in default_terms():
    if _t.term not in WILDCARD_TERMS:
        WORDS_ONLY[_t.category, _t.term] = WORDS_ONLY.get((_t.category, _t.term), 0.0) + _t.weight
ORACLES["keyword_scores_joined"] = with_tables(
    f"""{TICKET_TEXTS},
flat AS (SELECT t0, ' ' || array_to_string(regexp_extract_all({folded('t0')}, '[\\pL\\pN_]+'), ' ') || ' ' AS t FROM texts),
{rows([(c, t, w) for (c, t), w in WORDS_ONLY.items()], 'voc', 'category, term, weight')}""",
    """
SELECT k, category, sum(weight)::DOUBLE AS score, count(*) AS terms
FROM told JOIN flat USING (t0) JOIN voc ON contains(t, ' ' || term || ' ') GROUP BY 1, 2""",
)
CATEGORISED = f"""{T.REPAIRED},
told AS (SELECT *, resumen || ' | ' || descripcion AS t0 FROM repaired),
texts AS (SELECT DISTINCT t0 FROM told)"""
ORACLES["unify_sources"] = with_tables(scored(CATEGORISED), f"""
SELECT id_ticket, canal, fecha_creacion, first_reply_at, fecha_cierre, estado, prioridad, {DECISION} AS categoria, agente_id,
  sla_target_horas, sla_met, resumen, descripcion FROM told JOIN judged USING (t0)""")
ORACLES["rule_impact"] = with_tables(TICKET_SCORES, f"""
SELECT fuente, count(*) FILTER (boost_hits > 0) AS filas_con_add, count(*) FILTER (penalty_hits > 0) AS filas_con_neg,
  count(*) FILTER ({CHANGED}) AS filas_ajustadas_por_reglas FROM told JOIN judged USING (t0) GROUP BY fuente""")
CLASSED = f"""{T.CLEAN},
told AS (SELECT *, resumen || ' | ' || descripcion AS t0 FROM clean),
texts AS (SELECT DISTINCT t0 FROM told)"""
ORACLES["value_counts"] = with_tables(scored(CLASSED), f"""
SELECT 'canal' AS columna, canal AS valor, count(*) AS n FROM told GROUP BY 2
UNION ALL SELECT 'categoria', {DECISION}, count(*) FROM told JOIN judged USING (t0) GROUP BY 2""")

# --- repair -------------------------------------------------------------------------------
ORACLES["repair_dates"] = with_tables(T.REPAIRED, "SELECT k, id_ticket, estado, fecha_cierre FROM repaired")
CLOSED = members(C.CLOSED_STATES)
AUDIT = f"""
SELECT id_ticket, 'A_future_close_cleared' AS regla, {T.minute('c0')} AS antes_fecha_cierre, '' AS despues_fecha_cierre FROM r5 WHERE c0 > TIMESTAMP '{AS_OF}'
UNION ALL SELECT id_ticket, '1_open_with_close_cleared', {T.minute('c1')}, '' FROM r5 WHERE c1 IS NOT NULL AND estado IN {members(C.OPEN_STATES)}
UNION ALL SELECT id_ticket, '3_close_before_creation_cleared', {T.minute('c2')}, '' FROM r5 WHERE c2 < o
UNION ALL SELECT id_ticket, '4_close_before_first_fixed_to_max', {T.minute('c3')}, {T.minute('c4')} FROM r5 WHERE c3 < f AND estado IN {CLOSED}
UNION ALL SELECT id_ticket, '4_close_before_first_cleared_open_state', {T.minute('c3')}, '' FROM r5 WHERE c3 < f AND estado NOT IN {CLOSED}
UNION ALL SELECT id_ticket, '2_closed_without_close_imputed', '', {T.minute('c5')} FROM r5 WHERE c4 IS NULL AND estado IN {CLOSED} AND c5 IS NOT NULL"""
ORACLES["repair_audit"] = with_tables(T.REPAIRED, AUDIT)
ORACLES["repair_counts"] = with_tables(
    T.REPAIRED, f"SELECT regla, count(*) AS n FROM ({AUDIT}) GROUP BY regla"
)

# --- warehouse ----------------------------------------------------------------------------
FACT_LIST = (
    "id_ticket, ticket_code, id_canal, id_prioridad, id_estado, id_tipo_real, asunto, descripcion, "
    f"{stamp('fecha_creacion')} AS fecha_creacion, {stamp('fecha_resolucion')} AS fecha_resolucion, "
    "first_response_time_min, time_to_resolution_min, sla_met"
)
ORACLES["promote_gold"] = facts(f"SELECT {FACT_LIST} FROM f_tickets")
ORACLES["promotion_rejects"] = facts("""
SELECT id_ticket, concat_ws(',', CASE WHEN fc IS NULL THEN 'fecha_creacion' END, CASE WHEN id_canal IS NULL THEN 'canal' END,
  CASE WHEN id_prioridad IS NULL THEN 'prioridad' END, CASE WHEN id_estado IS NULL THEN 'estado' END) AS motivos
FROM dated WHERE fc IS NULL OR id_canal IS NULL OR id_prioridad IS NULL OR id_estado IS NULL""")
ORACLES["lineage"] = facts("""
SELECT DISTINCT f.id_ticket, 'manual' AS origen, s.id_ticket AS id_origen FROM f_tickets f JOIN staging s ON s.id_ticket = f.ticket_code""")
ORACLES["reload_facts"] = facts("""
SELECT id_ticket, 'V-' || ticket_code AS ticket_code, 'antiguo' AS asunto, id_canal, sla_met, true AS densos FROM f_tickets
  WHERE id_ticket % 10 <> 0
UNION ALL
SELECT CASE WHEN id_ticket % 10 = 0 THEN id_ticket END, ticket_code, asunto, id_canal, sla_met, true FROM f_tickets""")
ORACLES["reload_lineage"] = facts("""
SELECT id_ticket, 'synt' AS origen, 'V-' || ticket_code AS id_origen FROM f_tickets WHERE id_ticket % 10 <> 0
UNION ALL SELECT id_ticket, 'manual', ticket_code FROM f_tickets""")
ORACLES["reload_snapshot"] = facts("""
SELECT 'V-' || ticket_code AS ticket_code, 'antiguo' AS asunto, 'synt' AS origen, 'V-' || ticket_code AS id_origen, sla_met, 2 AS version
FROM f_tickets WHERE id_ticket % 10 <> 0
UNION ALL SELECT ticket_code, asunto, 'manual', ticket_code, sla_met, 2 FROM f_tickets""")
ORACLES["first_per_key"] = """
SELECT l_partkey, l_orderkey, l_linenumber, l_quantity FROM (
  SELECT *, row_number() OVER (PARTITION BY l_partkey ORDER BY l_orderkey, l_linenumber, l_quantity) AS rn FROM lineitem) WHERE rn = 1"""
ORACLES["ticket_view"] = facts(f"""
SELECT f.id_ticket, ticket_code, canal, prioridad, estado, nombre AS tipo_real, asunto, descripcion,
  {stamp('fecha_creacion')} AS fecha_creacion, {stamp('fecha_resolucion')} AS fecha_resolucion,
  first_response_time_min, time_to_resolution_min, sla_met
FROM f_tickets f JOIN d_canal USING (id_canal) JOIN d_prioridad USING (id_prioridad) JOIN d_estado USING (id_estado)
LEFT JOIN d_tipo ON id_tipo = id_tipo_real""")
ORACLES["ticket_code"] = facts("""
SELECT id_ticket, CASE WHEN id_ticket % 3 <> 0 THEN ticket_code ELSE 'SOPORTE-' || lpad(id_ticket::VARCHAR, 4, '0') END AS ticket_code,
  asunto, descripcion, canal, prioridad, estado, sla_met
FROM f_tickets JOIN d_canal USING (id_canal) JOIN d_prioridad USING (id_prioridad) JOIN d_estado USING (id_estado)""")
TEXT = "concat_ws(' ', nullif(asunto, ''), nullif(descripcion, ''))"
ORACLES["training_view"] = facts(f"""
SELECT id_ticket, {TEXT} AS texto, id_canal, id_prioridad, id_estado, sla_met, id_tipo_real FROM f_tickets WHERE id_tipo_real IS NOT NULL""")
ORACLES["pending"] = with_tables(T.FACTS + "," + T.PREDICTIONS, f"""
SELECT f.id_ticket, {TEXT} AS texto, id_canal, id_prioridad, id_estado, sla_met
FROM f_tickets f LEFT JOIN predictions p ON p.id_ticket = f.id_ticket WHERE p.id_ticket IS NULL""")
ORACLES["pending_by_model"] = with_tables(T.FACTS + "," + T.PREDICTIONS, """
SELECT id_ticket FROM f_tickets WHERE id_ticket NOT IN (
  SELECT id_ticket FROM predictions WHERE modelo_version = 'v1.1')""")
ORACLES["load_predictions"] = with_tables(T.FACTS + "," + T.PREDICTIONS + "," + T.PREDICTED_CODES, """
SELECT id_ticket, id_tipo_predicho, score_predicho::DOUBLE AS score_predicho, modelo_version FROM predictions WHERE modelo_version <> 'v1.1'
UNION ALL
SELECT f.id_ticket, t.id_tipo, NULL, 'v1.1' FROM predicted_codes p JOIN f_tickets f USING (id_ticket) JOIN d_tipo t ON t.codigo = p.pred_cat
WHERE p.modelo_version = 'SVM_v1.1'""")
EVAL = """
SELECT f.id_ticket, f.ticket_code, f.id_tipo_real, r.codigo AS real_cat, p.id_tipo_predicho, d.codigo AS pred_cat,
  p.score_predicho::DOUBLE AS score_predicho, p.modelo_version,
  CASE WHEN p.id_tipo_predicho IS NULL THEN NULL WHEN f.id_tipo_real = p.id_tipo_predicho THEN 1 ELSE 0 END AS es_acierto
FROM f_tickets f JOIN d_tipo r ON r.id_tipo = f.id_tipo_real LEFT JOIN predictions p ON p.id_ticket = f.id_ticket
LEFT JOIN d_tipo d ON d.id_tipo = p.id_tipo_predicho"""
ORACLES["eval_gold"] = with_tables(T.FACTS + "," + T.PREDICTIONS, EVAL)

# --- quality ------------------------------------------------------------------------------
DATED_CLEAN = f"""{T.CLEAN},
dated_clean AS (SELECT * REPLACE (
  try_cast(nullif(fecha_creacion, '') AS TIMESTAMP) AS fecha_creacion, try_cast(nullif(first_reply_at, '') AS TIMESTAMP) AS first_reply_at,
  try_cast(nullif(fecha_cierre, '') AS TIMESTAMP) AS fecha_cierre) FROM clean)"""
# The facts as they would be without the repair: the same tickets, other closing dates.
ORACLES["dq_checks"] = with_tables(f"{T.FACTS}", """
SELECT id_ticket, concat_ws(',', CASE WHEN fz < fc THEN 'resolucion_antes_de_creacion' END,
  CASE WHEN datesub('minute', fc, fz) < 0 THEN 'ttr_negativo' END, CASE WHEN frt < 0 THEN 'frt_negativo' END) AS reglas
FROM (SELECT f.id_ticket, f.fecha_creacion AS fc, f.first_response_time_min AS frt, try_cast(nullif(c.fecha_cierre, '') AS TIMESTAMP) AS fz
      FROM f_tickets f JOIN clean c ON c.k = f.id_ticket)
WHERE fz < fc OR datesub('minute', fc, fz) < 0 OR frt < 0""")
ORACLES["dq_score_range"] = with_tables(T.PREDICTIONS, """
SELECT 'score_fuera_de_rango' AS regla, count(*) FILTER (score_predicho < 0 OR score_predicho > 1) AS n FROM predictions""")
ORACLES["dq_keys"] = "SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1 HAVING count(*) > 1"
ORACLES["dq_keys_facts"] = facts(
    "SELECT count(*) AS n FROM (SELECT ticket_code FROM f_tickets GROUP BY 1 HAVING count(*) > 1)"
)
ORACLES["dq_fk"] = with_tables(T.FACTS + "," + T.PREDICTIONS, """
SELECT modelo_version, count(*) AS n FROM predictions WHERE id_ticket NOT IN (SELECT id_ticket FROM f_tickets) GROUP BY 1""")
ORACLES["dq_fk_dimensions"] = facts("""
SELECT 'id_canal' AS regla, count(*) FILTER (id_canal >= 4) AS n FROM f_tickets
UNION ALL SELECT 'id_prioridad', count(*) FILTER (id_prioridad >= 4) FROM f_tickets
UNION ALL SELECT 'id_estado', 0 FROM (SELECT 1)
UNION ALL SELECT 'id_tipo_real', count(*) FILTER (id_tipo_real >= 7) FROM f_tickets""")


def stray(column: str) -> str:
    allowed = ", ".join(folded(q(v)) for v in CATALOGUE[column])
    return (
        f"SELECT {q(column)} AS columna, {column} AS valor, count(*) AS n FROM clean "
        f"WHERE coalesce({folded(column)}, '') NOT IN ({allowed}) GROUP BY 2"
    )


ORACLES["dq_catalog"] = with_tables(T.CLEAN, " UNION ALL ".join(map(stray, CATALOGUE)))


def rule_count(name: str, test: str, table: str = "staging") -> str:
    return f"SELECT {q(name)} AS regla, count(*) FILTER ({test}) AS n FROM {table}"


ORACLES["dq_lengths"] = with_tables(T.STAGING, " UNION ALL ".join([
    *[rule_count(f"{c}_largo", f"length({c}) > {STAGING_LENGTHS[c]}") for c in STAGING_LENGTHS],
    rule_count("resumen_corto", "length(trim(resumen)) < 5"),
    rule_count("descripcion_corta", "length(trim(descripcion)) < 10"),
    rule_count("sin_texto", "trim(resumen) = '' AND trim(descripcion) = ''"),
    *[rule_count(f"{c}_nulo", f"{c} IS NULL") for c in STAGING_LENGTHS],
]))
ORACLES["dq_reconcile"] = facts("""
SELECT (SELECT count(*) FROM staging) AS stg, (SELECT count(*) FROM f_tickets WHERE ticket_code IN (SELECT id_ticket FROM staging)) AS fact,
  (SELECT count(*) FROM (SELECT DISTINCT f.id_ticket, f.ticket_code FROM f_tickets f JOIN staging s ON s.id_ticket = f.ticket_code)) AS lin""")
MOMENT = f"TIMESTAMP '{AS_OF}'"
ORACLES["dq_state_dates"] = with_tables(DATED_CLEAN, " UNION ALL ".join(
    rule_count(name, test, "dated_clean") for name, test in {
        "abierto_con_cierre": f"estado IN {members(C.OPEN_STATES)} AND fecha_cierre IS NOT NULL",
        "cerrado_sin_cierre": f"estado IN {CLOSED} AND fecha_cierre IS NULL",
        "cierre_antes_de_apertura_o_respuesta": f"estado IN {CLOSED} AND (fecha_cierre < fecha_creacion OR fecha_cierre < first_reply_at)",
        "respuesta_antes_de_apertura": "first_reply_at < fecha_creacion",
        "fecha_anterior_a_2000": "least(fecha_creacion, first_reply_at, fecha_cierre) < TIMESTAMP '2000-01-01'",
        "fecha_futura": f"greatest(fecha_creacion, first_reply_at, fecha_cierre) > {MOMENT}",
    }.items()
))
ORACLES["dq_sla"] = with_tables(T.REPAIRED, """
SELECT k, sla_met FROM (SELECT *, try_cast(nullif(fecha_creacion, '') AS TIMESTAMP) AS o, try_cast(nullif(fecha_cierre, '') AS TIMESTAMP) AS c FROM repaired)
WHERE sla_met IN ('true', 'false') AND (sla_met = 'true') <> (datesub('minute', o, c) <= sla_target_horas::INT * 60)""")
ORACLES["dq_repeated_sentences"] = r"""
SELECT oracion, count(DISTINCT doc_id) AS filas FROM (
  SELECT doc_id, regexp_replace(unnest(regexp_split_to_array(text, '[.!?]+')), '^[\s\pZ\x{85}]+|[\s\pZ\x{85}]+$', '', 'g') AS oracion FROM documents)
WHERE oracion <> '' GROUP BY 1 HAVING count(DISTINCT doc_id) > 1"""
ORACLES["dq_repeated_texts"] = (
    "SELECT text, count(*) AS n FROM documents WHERE trim(text) <> '' GROUP BY 1 HAVING count(*) > 1"
)
ORACLES["dq_shares"] = with_tables(scored(TICKET_TEXTS) + f""",
n AS (SELECT {DECISION} AS categoria, count(*) AS n FROM told JOIN judged USING (t0) GROUP BY 1),
{rows(CATEGORY_SHARES, 'bounds', 'categoria, lo, hi')}""", """
SELECT categoria, coalesce(n, 0) AS n, pct, pct BETWEEN lo::DOUBLE AND hi::DOUBLE AS dentro FROM (
  SELECT b.categoria, n.n, lo, hi, round(100.0 * coalesce(n.n, 0) / (SELECT count(*) FROM told), 2) AS pct
  FROM bounds b LEFT JOIN n ON n.categoria = b.categoria)""")

# --- training data ------------------------------------------------------------------------
# The checksum bit by bit: DuckDB has none of its own.
CRC = """xor(4294967295::BIGINT, list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, length(s) + 1), lambda i: ascii(substr(s, i::INT, 1))::BIGINT)),
  lambda acc, b: list_reduce(list_prepend(xor(acc, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), lambda a, z: CASE WHEN a % 2 = 1 THEN xor(a // 2, 3988292384::BIGINT) ELSE a // 2 END)))"""
ORACLES["ml_split"] = facts(f"""
SELECT id_ticket, CASE WHEN {CRC} % 5 = 0 THEN 'valid' ELSE 'train' END AS split
FROM (SELECT id_ticket, id_ticket::VARCHAR AS s, {TEXT} AS texto FROM f_tickets) WHERE strlen(trim(texto)) >= 5""")
ORACLES["ml_split_documents"] = f"""
SELECT id_ticket, ({CRC} % 5)::INT AS part FROM (SELECT doc_id AS id_ticket, doc_id::VARCHAR AS s FROM documents)"""
ORACLES["text_quality"] = """
SELECT count(*) FILTER (texto IS NULL OR strlen(trim(texto)) < 5) AS textos_invalidos, count(*) AS total
FROM (SELECT text AS texto FROM documents UNION ALL SELECT ' ññ ' FROM documents WHERE doc_id % 7 = 0)"""


def distribution(test: str) -> str:
    return facts(f"""
SELECT t.codigo AS real_cat, count(*) AS n FROM (SELECT id_tipo_real, id_ticket::VARCHAR AS s, {TEXT} AS texto FROM f_tickets) f
JOIN d_tipo t ON t.id_tipo = f.id_tipo_real WHERE strlen(trim(texto)) >= 5 AND {CRC} % 5 {test} GROUP BY 1""")


ORACLES["class_dist_train"] = distribution("<> 0")
ORACLES["class_dist_valid"] = distribution("= 0")
ORACLES["stratified_folds"] = """
SELECT doc_id, lang, ((row_number() OVER (PARTITION BY lang ORDER BY md5('42:' || doc_id), '42:' || doc_id) - 1) % 5)::INT AS fold FROM documents"""

# --- evaluation ---------------------------------------------------------------------------
ORACLES["confusion"] = with_tables(T.FACTS + "," + T.PREDICTIONS, f"""
SELECT real_cat, pred_cat, count(*) AS n FROM ({EVAL}) WHERE pred_cat IS NOT NULL GROUP BY 1, 2""")
LABEL_ROWS = rows([(c,) for c in C.LABELS], "labels8", "label")
BY = "experimento, id_experimento, modelo_version, dataset"
CODES = f"{T.PREDICTED_CODES},\n{LABEL_ROWS}"
GRID = f"""
SELECT {BY}, real_cat, pred_cat, coalesce(n, 0) AS n FROM
 (SELECT e.*, a.label AS real_cat, b.label AS pred_cat FROM (SELECT DISTINCT {BY} FROM predicted_codes) e, labels8 a, labels8 b)
 LEFT JOIN (SELECT {BY}, real_cat, pred_cat, count(*) AS n FROM predicted_codes GROUP BY ALL) USING ({BY}, real_cat, pred_cat)"""
ORACLES["confusion_dense"] = with_tables(CODES, GRID)
ORACLES["confusion_norm"] = with_tables(CODES, """
SELECT a.label AS real_cat, b.label AS pred_cat, coalesce(n, 0) AS n,
  round(coalesce(n, 0) / greatest(sum(coalesce(n, 0)) OVER (PARTITION BY a.label), 1)::DOUBLE, 6) AS share
FROM labels8 a CROSS JOIN labels8 b LEFT JOIN (
  SELECT real_cat, pred_cat, count(*) AS n FROM predicted_codes GROUP BY 1, 2) c ON c.real_cat = a.label AND c.pred_cat = b.label""")


def report(source: str, labels: str, by: str = "") -> str:
    """Per-class figures straight from the predictions."""
    groups = f"{by}, " if by else ""
    keys = f" AND {' AND '.join(f'p.{c.strip()} = g.{c.strip()}' for c in by.split(','))}" if by else ""
    frame = f"(SELECT DISTINCT {by} FROM {source}) e, " if by else ""
    return f"""
SELECT {groups}label, coalesce(hits / nullif(predicted, 0)::DOUBLE, 0) AS "precision", coalesce(hits / nullif(support, 0)::DOUBLE, 0) AS recall,
  coalesce(2 * hits / nullif(support + predicted, 0)::DOUBLE, 0) AS f1, support, predicted, hits FROM (
  SELECT {', '.join(f'g.{c.strip()}' for c in by.split(',')) + ',' if by else ''} g.label,
    count(*) FILTER (p.real_cat = g.label) AS support, count(*) FILTER (p.pred_cat = g.label) AS predicted,
    count(*) FILTER (p.real_cat = g.label AND p.pred_cat = g.label) AS hits
  FROM (SELECT {'e.*, ' if by else ''}l.label FROM {frame}{labels} l) g LEFT JOIN {source} p ON (p.real_cat = g.label OR p.pred_cat = g.label){keys}
  GROUP BY ALL)"""


ROUNDED = 'label, round("precision", 6) AS "precision", round(recall, 6) AS recall, round(f1, 6) AS f1, support, predicted, hits'
ORACLES["class_report"] = with_tables(CODES, f"SELECT {ROUNDED} FROM ({report('predicted_codes', 'labels8')})")
ORACLES["class_report_fixed_labels"] = with_tables(
    f"""{CODES},
part AS (SELECT * FROM predicted_codes),
{rows([(c,) for c in ('ACC', 'APP', 'HW', 'MAIL', 'POL')], 'labels5', 'label')}""",
    f"SELECT {ROUNDED} FROM ({report('part', 'labels5')})",
)
CLASS_REPORT = report("predicted_codes", "labels8", BY)
GLOBAL = f"""
SELECT {BY}, round(accuracy * 100, 2) AS accuracy_pct, round(avg(f1) * 100, 2) AS f1_macro_pct,
  round(sum(f1 * support) / sum(support) * 100, 2) AS f1_weighted_pct, round(avg("precision") * 100, 2) AS precision_macro_pct,
  round(avg(recall) * 100, 2) AS recall_macro_pct, n_muestras
FROM ({CLASS_REPORT}) JOIN (SELECT {BY}, avg(ok) AS accuracy, count(*) AS n_muestras FROM predicted_codes GROUP BY ALL) USING ({BY})
GROUP BY {BY}, accuracy, n_muestras"""
ORACLES["global_metrics"] = with_tables(CODES, GLOBAL)
CLASSES = f"""
SELECT {BY}, label AS real_cat, round("precision" * 100, 2) AS precision_pct, round(recall * 100, 2) AS recall_pct,
  round(f1 * 100, 2) AS f1_pct, support AS soporte_n FROM ({CLASS_REPORT})"""
ORACLES["class_metrics"] = with_tables(CODES, CLASSES)
REGISTRY = ",\n".join([
    rows(C.EXPERIMENTS, "exps", "id_experimento, codigo, descripcion, dataset_origen"),
    rows(C.MODELS, "models", "modelo_version, descripcion, algoritmo, params_resumen"),
    rows(C.TYPES, "types", "id_tipo, codigo, nombre"),
])
ORACLES["results_bi"] = with_tables(f"{CODES},\n{REGISTRY}", f"""
SELECT e.codigo AS experimento, e.descripcion AS experimento_desc, g.dataset, m.modelo_version, m.algoritmo, m.params_resumen,
  g.n_muestras, g.accuracy_pct, g.f1_macro_pct, g.f1_weighted_pct, g.precision_macro_pct, g.recall_macro_pct
FROM ({GLOBAL}) g JOIN exps e ON e.id_experimento = g.id_experimento JOIN models m ON m.modelo_version = g.modelo_version""")
ORACLES["class_results_bi"] = with_tables(f"{CODES},\n{REGISTRY}", f"""
SELECT e.codigo AS experimento, g.dataset, m.modelo_version, m.algoritmo, t.codigo AS real_cat, t.nombre AS real_cat_nombre,
  g.precision_pct, g.recall_pct, g.f1_pct, g.soporte_n
FROM ({CLASSES}) g JOIN exps e ON e.id_experimento = g.id_experimento JOIN models m ON m.modelo_version = g.modelo_version
JOIN types t ON t.codigo = g.real_cat""")
ORACLES["confusion_keys"] = with_tables(f"{CODES},\n{REGISTRY}", f"""
SELECT id_experimento, modelo_version, dataset, a.id_tipo AS id_real, b.id_tipo AS id_pred, n
FROM ({GRID}) g JOIN types a ON a.codigo = g.real_cat JOIN types b ON b.codigo = g.pred_cat""")
ORACLES["dq_fk_family"] = with_tables(f"{T.FACTS},\n{T.PREDICTIONS},\n{CODES},\n{REGISTRY}", f"""
SELECT 'map_id_origen.id_ticket' AS referencia, 0::BIGINT AS filas
UNION ALL SELECT 'prediccion.id_ticket', (SELECT count(*) FROM predictions WHERE id_ticket NOT IN (SELECT id_ticket FROM f_tickets))
UNION ALL SELECT 'prediccion.id_tipo_predicho', (SELECT count(*) FROM predictions WHERE id_tipo_predicho NOT IN (SELECT id_tipo FROM types))
UNION ALL SELECT 'prediccion.modelo_version', (SELECT count(*) FROM predictions WHERE modelo_version NOT IN (SELECT modelo_version FROM models))
UNION ALL SELECT 'resultado.id_experimento', (SELECT count(*) FROM ({GLOBAL}) WHERE id_experimento NOT IN (SELECT id_experimento FROM exps))
UNION ALL SELECT 'resultado.modelo_version', (SELECT count(*) FROM ({GLOBAL}) WHERE modelo_version NOT IN (SELECT modelo_version FROM models))""")
MINED = f"""{T.FACTS},{T.PREDICTED_CODES},
manual AS (SELECT k AS id_ticket, trim(CASE WHEN k % 17 = 0 THEN ' NET ' ELSE categoria END) AS real_cat, resumen, descripcion FROM raw WHERE k % 19 <> 0),
mined AS (SELECT p.id_ticket, m.real_cat, p.pred_cat, resumen, descripcion, trim(resumen || ' ' || descripcion) AS texto
  FROM predicted_codes p JOIN manual m USING (id_ticket) WHERE p.modelo_version = 'SVM_v1.1' AND ok = 0 AND m.real_cat IN {members(C.WEAK_LABELS)})"""
ORACLES["hard_examples"] = with_tables(MINED, "SELECT * FROM mined")
ORACLES["augment"] = with_tables(MINED, f"""
SELECT real_cat, canal, count(*) AS n, sum(length(texto))::BIGINT AS letters FROM (
  SELECT codigo AS real_cat, id_canal::VARCHAR AS canal, texto FROM (SELECT *, id_ticket::VARCHAR AS s, {TEXT} AS texto FROM f_tickets) f
  JOIN d_tipo ON id_tipo = id_tipo_real WHERE strlen(trim(texto)) >= 5 AND {CRC} % 5 <> 0
  UNION ALL SELECT real_cat, 'lote_L1', texto FROM mined) GROUP BY 1, 2""")

# --- features -----------------------------------------------------------------------------
COUNTS = rf"""
words AS (SELECT doc_id, regexp_extract_all(lower(strip_accents(text)), '[\pL\pN_]{{2,}}') AS w FROM documents),
terms AS (
  SELECT doc_id, unnest(w) AS term FROM words
  UNION ALL SELECT doc_id, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) FROM words),
counts AS (SELECT doc_id, term, count(*) AS tf FROM terms GROUP BY 1, 2),
total AS (SELECT count(*) AS n FROM documents),
vocabulary AS (SELECT term, count(*) AS df, ln((1 + n) / (1 + count(*))::DOUBLE) + 1 AS idf FROM counts, total GROUP BY term, n
  HAVING count(*) >= 2 AND count(*) <= n * 0.9)"""


def weights(frequency: str) -> str:
    return with_tables(COUNTS, f"""
SELECT doc_id, term, tf, round(raw / sqrt(sum(raw * raw) OVER (PARTITION BY doc_id)), 6) AS weight
FROM (SELECT doc_id, term, tf, {frequency} * idf AS raw FROM counts JOIN vocabulary USING (term))""")


ORACLES["tfidf_terms"] = weights("tf")
ORACLES["tfidf_sublinear"] = weights("(1 + ln(tf))")
ORACLES["tfidf_vocabulary"] = with_tables(
    COUNTS, "SELECT term, df, round(idf, 6) AS idf FROM vocabulary"
)
ORACLES["onehot_meta"] = f"""
WITH docs AS (SELECT doc_id AS id_ticket, source AS canal, coalesce(quality::VARCHAR, '') AS prioridad, doc_id::VARCHAR AS s
  FROM documents LEFT JOIN labels USING (doc_id)),
parts AS (SELECT *, {CRC} % 5 AS part FROM docs),
pairs AS (SELECT id_ticket, part, 'canal=' || canal AS feature FROM parts UNION ALL SELECT id_ticket, part, 'prioridad=' || prioridad FROM parts)
SELECT id_ticket, feature, 1 AS value FROM pairs WHERE part = 0 AND feature IN (SELECT feature FROM pairs WHERE part <> 0)"""


# --- models -------------------------------------------------------------------------------
PARTS = f"""
docs AS (SELECT doc_id, text, lang, source, coalesce(quality::VARCHAR, '') AS quality,
  {CRC.replace("(s)", "(doc_id::VARCHAR)").replace("substr(s,", "substr(doc_id::VARCHAR,")} % 5 <> 0 AS train
  FROM documents LEFT JOIN labels USING (doc_id) WHERE strlen(trim(text)) >= 5)"""


def bayes(frequency: str, meta: bool) -> str:
    """Naive Bayes with smoothing one half, straight from the counts."""
    hot = """
hot AS (SELECT doc_id, train, chr(10) || 'canal=' || source AS f FROM docs
  UNION ALL SELECT doc_id, train, chr(10) || 'prioridad=' || quality FROM docs),
used AS (SELECT * FROM weighted UNION ALL SELECT doc_id, f, 1.0 FROM hot WHERE f IN (SELECT f FROM hot WHERE train)),"""
    return with_tables(PARTS + "," + rf"""
words AS (SELECT doc_id, train, regexp_extract_all(lower(strip_accents(text)), '[\pL\pN_]{{2,}}') AS w FROM docs),
terms AS (
  SELECT doc_id, train, unnest(w) AS term FROM words
  UNION ALL SELECT doc_id, train, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) FROM words),
counts AS (SELECT doc_id, train, term, count(*) AS tf FROM terms GROUP BY ALL),
total AS (SELECT count(*) AS n FROM docs WHERE train),
vocabulary AS (SELECT term, ln((1 + n) / (1 + count(*))::DOUBLE) + 1 AS idf FROM counts, total WHERE train GROUP BY term, n
  HAVING count(*) >= 2 AND count(*) <= n * 0.9),
raw AS (SELECT doc_id, term, {frequency} * idf AS raw FROM counts JOIN vocabulary USING (term)),
weighted AS (SELECT doc_id, term AS f, raw / sqrt(sum(raw * raw) OVER (PARTITION BY doc_id)) AS x FROM raw),
{hot if meta else "used AS (SELECT * FROM weighted),"}
sums AS (SELECT lang, f, sum(x) AS s FROM used JOIN docs USING (doc_id) WHERE train GROUP BY 1, 2),
size AS (SELECT count(DISTINCT f) AS v FROM sums),
classes AS (
  SELECT d.lang, ln(d.n / (SELECT n FROM total)) AS prior, ln(0.5 / (t + 0.5 * v)) AS base
  FROM (SELECT lang, count(*) AS n FROM docs WHERE train GROUP BY 1) d
  JOIN (SELECT lang, sum(s) AS t FROM sums GROUP BY 1) USING (lang), size),
found AS (
  SELECT doc_id, c.lang, sum(x) AS w, sum(x * coalesce(ln((s + 0.5) / 0.5), 0)) AS found
  FROM used JOIN docs USING (doc_id) CROSS JOIN classes c LEFT JOIN sums z ON z.f = used.f AND z.lang = c.lang
  WHERE NOT train GROUP BY 1, 2),
scored AS (
  SELECT d.doc_id, d.lang AS real_cat, c.lang AS pred_cat, prior + coalesce(w, 0) * base + coalesce(found, 0) AS score
  FROM docs d CROSS JOIN classes c LEFT JOIN found f ON f.doc_id = d.doc_id AND f.lang = c.lang WHERE NOT train),
best AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, pred_cat) AS place FROM scored)""", """
SELECT doc_id AS id_ticket, real_cat, pred_cat, CASE WHEN real_cat = pred_cat THEN 1 ELSE 0 END AS ok FROM best WHERE place = 1""")


ORACLES["score_lot_nb"] = bayes("tf", False)
ORACLES["score_lot_meta"] = bayes("(1 + ln(tf))", True)
ORACLES["grid_search"] = """
SELECT 'nb' AS kind, p::DOUBLE AS parameter, f::INT AS fold, true AS f1_alcanza FROM (VALUES (0.5), (1.0), (2.0)) t(p), range(5) r(f)"""


# --- linear models --------------------------------------------------------------------------
def fold_features(points: list[float], folded: bool) -> str:
    """Texts as weighted terms, by set: f learns from the rows outside fold f, and is asked for those
    inside it. Single fits have one set, and fold 0 are the rows to score."""
    fold = "((row_number() OVER (PARTITION BY lang ORDER BY md5('42:' || doc_id), '42:' || doc_id) - 1) % 5)::INT"
    rows = f"SELECT doc_id, text, lang, {fold} AS fold FROM docs WHERE train" if folded else (
        "SELECT doc_id, text, lang, CASE WHEN train THEN 1 ELSE 0 END AS fold FROM docs")
    values = ", ".join(f"({p}::DOUBLE)" for p in points)
    return rf"""{PARTS.strip()},
rows AS MATERIALIZED ({rows}),
sets AS (SELECT f::INT AS f FROM range({5 if folded else 1}) t(f)),
points AS (SELECT p FROM (VALUES {values}) t(p)),
words AS (SELECT doc_id, fold, regexp_extract_all(lower(strip_accents(text)), '[\pL\pN_]{{2,}}') AS w FROM rows),
terms AS (
  SELECT doc_id, fold, unnest(w) AS term FROM words
  UNION ALL SELECT doc_id, fold, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) FROM words),
counts AS MATERIALIZED (SELECT doc_id, fold, term, count(*) AS tf FROM terms GROUP BY ALL),
total AS (SELECT f, count(*) AS n FROM rows JOIN sets ON fold <> f GROUP BY f),
vocabulary AS (SELECT f, term, ln((1 + n) / (1 + count(*))::DOUBLE) + 1 AS idf FROM counts JOIN total ON fold <> f
  GROUP BY f, term, n HAVING count(*) >= 2 AND count(*) <= n * 0.9),
raw AS (SELECT f, doc_id, fold, term, tf * idf AS raw FROM counts JOIN vocabulary USING (term)),
weighted AS MATERIALIZED (
  SELECT f, doc_id, fold, term, raw / sqrt(sum(raw * raw) OVER (PARTITION BY f, doc_id)) AS x FROM raw)"""


def linear(kind: str, points: list[float], folded: bool, steps: int, select: str) -> str:
    """Linear models by accelerated gradient descent over the rows they learn from.

    ``gram`` holds the products of all rows with those learned from, in order; of the SVM with the
    intercept's feature of value one.
    """
    one = 1 if kind == "svm" else 0
    bend = "2 * max(p)" if kind == "svm" else "max(p) / 2"
    shared = f"""RECURSIVE {fold_features(points, folded)},
products AS (
  SELECT a.f, a.doc_id AS a, b.doc_id AS b, sum(a.x * b.x) AS k FROM weighted a JOIN weighted b USING (f, term)
  WHERE b.fold <> b.f GROUP BY ALL),
numbered AS (
  SELECT f, doc_id, lang, fold <> f AS learns, row_number() OVER (PARTITION BY f ORDER BY fold = f, doc_id) AS i
  FROM rows, sets),
gram AS MATERIALIZED (
  SELECT a.f, a.i, any_value(a.learns) AS learns, any_value(a.doc_id) AS doc_id, any_value(a.lang) AS lang,
    list(coalesce(k, 0) + {one} ORDER BY b.i) AS line, sum(coalesce(k, 0) + 1) AS total
  FROM numbered a JOIN numbered b ON a.f = b.f AND b.learns
  LEFT JOIN products z ON z.f = a.f AND z.a = a.doc_id AND z.b = b.doc_id GROUP BY a.f, a.i),
bends AS (SELECT f, 1 + {bend} * max(total) AS bend FROM gram, points WHERE learns GROUP BY f),
own AS MATERIALIZED (
  SELECT f, c.lang, list(CASE WHEN n.lang = c.lang THEN 1.0::DOUBLE ELSE {-1 if kind == 'svm' else 0}::DOUBLE END ORDER BY i) AS s
  FROM numbered n, (SELECT DISTINCT lang FROM rows) c WHERE learns GROUP BY f, c.lang),
"""
    start = "list_transform(s, lambda x: 0::DOUBLE)"
    ahead = "list_transform(list_zip(a, b), lambda z: z[1] + (sqrt(bend) - 1) / (sqrt(bend) + 1) * (z[1] - z[2]))"
    if kind == "svm":
        way = f"""
way AS (
  SELECT 0 AS step, f, p, lang, {start} AS a, {start} AS b, 0::DOUBLE AS c, 0::DOUBLE AS d FROM own, points
  UNION ALL
  SELECT step + 1, f, p, lang,
    list(v[i] - (v[i] - 2 * p * s[i] * greatest(0, 1 - s[i] * list_dot_product(line, v))) / bend ORDER BY i),
    any_value(a), 0, 0
  FROM (SELECT way.*, s, bend, {ahead} AS v FROM way JOIN own USING (f, lang) JOIN bends USING (f) WHERE step < {steps}) w
  JOIN (SELECT f, i, line FROM gram WHERE learns) g USING (f)
  GROUP BY step, f, p, lang),"""
    else:
        way = f"""
way AS (
  SELECT 0 AS step, f, p, lang, {start} AS a, {start} AS b, 0::DOUBLE AS c, 0::DOUBLE AS d FROM own, points
  UNION ALL
  SELECT step + 1, f, p, lang, list(vi - (vi + p * (share - si)) / bend ORDER BY i), list(ai ORDER BY i),
    any_value(e) - sum(p * (share - si)) / any_value(bend), any_value(c)
  FROM (
    SELECT *, exp(m - top) / sum(exp(m - top)) OVER (PARTITION BY step, f, p, i) AS share
    FROM (
      SELECT *, max(m) OVER (PARTITION BY step, f, p, i) AS top
      FROM (
        SELECT step, f, p, lang, i, c, e, bend, v[i] AS vi, s[i] AS si, a[i] AS ai, list_dot_product(line, v) + e AS m
        FROM (SELECT way.*, s, bend, {ahead} AS v, c + (sqrt(bend) - 1) / (sqrt(bend) + 1) * (c - d) AS e
          FROM way JOIN own USING (f, lang) JOIN bends USING (f) WHERE step < {steps}) w
        JOIN (SELECT f, i, line FROM gram WHERE learns) g USING (f))))
  GROUP BY step, f, p, lang),"""
    last = f"""
fitted AS (SELECT f, p, lang, a, c FROM way WHERE step = {steps}),
scored AS (
  SELECT g.f, p, g.doc_id, g.lang AS real_cat, w.lang AS pred_cat, list_dot_product(line, a) + c AS margin
  FROM gram g JOIN fitted w USING (f) WHERE NOT learns),
best AS (SELECT f, p, doc_id, real_cat, arg_max(pred_cat, margin) AS pred_cat FROM scored GROUP BY ALL)"""
    return f"WITH {shared}{way.strip()}{last}\n{select}"


PREDICTED = "SELECT doc_id AS id_ticket, real_cat, pred_cat, CASE WHEN real_cat = pred_cat THEN 1 ELSE 0 END AS ok FROM best"


def points_of(kind: str) -> str:
    """Macro F1 of each parameter and fold, over the classes that are real or found there."""
    return f"""
SELECT '{kind}' AS kind, p AS parameter, f AS fold, round(avg(2 * hits / (n_real + n_pred)), 6) AS f1_macro FROM (
  SELECT f, p, lang, count(*) FILTER (real_cat = lang AND pred_cat = lang) AS hits,
    count(*) FILTER (real_cat = lang) AS n_real, count(*) FILTER (pred_cat = lang) AS n_pred
  FROM best, (SELECT DISTINCT lang FROM rows) GROUP BY f, p, lang) WHERE n_real + n_pred > 0 GROUP BY f, p"""


def bayes_points(points: list[float]) -> str:
    """Naive Bayes for each smoothing and fold."""
    return f"""WITH {fold_features(points, True)},
langs AS (SELECT doc_id, lang FROM rows),
sums AS (SELECT f, lang, term, sum(x) AS s FROM weighted JOIN langs USING (doc_id) WHERE fold <> f GROUP BY ALL),
size AS (SELECT f, count(DISTINCT term) AS v FROM sums GROUP BY f),
classes AS (
  SELECT d.f, p, d.lang, ln(d.n / t.n) AS prior, ln(p / (s + p * v)) AS base
  FROM (SELECT f, lang, count(*) AS n FROM rows JOIN sets ON fold <> f GROUP BY ALL) d JOIN total t USING (f)
  JOIN (SELECT f, lang, sum(s) AS s FROM sums GROUP BY ALL) USING (f, lang) JOIN size USING (f), points),
found AS (
  SELECT w.f, c.p, w.doc_id, c.lang, sum(x) * any_value(base) + sum(x * coalesce(ln((s + p) / p), 0)) AS score
  FROM weighted w JOIN classes c USING (f) LEFT JOIN sums z ON z.f = w.f AND z.term = w.term AND z.lang = c.lang
  WHERE w.fold = w.f GROUP BY ALL),
best AS (
  SELECT r.fold AS f, c.p, r.doc_id, any_value(r.lang) AS real_cat, arg_max(c.lang, prior + coalesce(score, 0)) AS pred_cat
  FROM rows r JOIN classes c ON c.f = r.fold LEFT JOIN found z ON z.f = r.fold AND z.p = c.p AND z.doc_id = r.doc_id AND z.lang = c.lang
  GROUP BY r.fold, c.p, r.doc_id)
{points_of("nb")}"""


GRID_POINTS = [0.5, 1.0, 2.0]
ORACLES["score_lot_lr"] = linear("lr", [2.0], False, 500, PREDICTED)
ORACLES["score_lot_svm"] = linear("svm", [1.0], False, 600, PREDICTED)
ORACLES["grid_search_nb"] = bayes_points(GRID_POINTS)
ORACLES["grid_search_lr"] = linear("lr", GRID_POINTS, True, 300, points_of("lr"))
ORACLES["grid_search_svm"] = linear("svm", GRID_POINTS, True, 400, points_of("svm"))
ORACLES["best_grid_point"] = f"""
SELECT parameter, round(f1, 6) AS f1_macro FROM (
  SELECT parameter, avg(f1_macro) AS f1 FROM ({ORACLES["grid_search_nb"]}) GROUP BY parameter) ORDER BY f1 DESC, parameter LIMIT 1"""

# --- files ----------------------------------------------------------------------------------
ORACLES["scan_multiline"] = """
SELECT doc_id, lang, md5(coalesce(text, '')) AS huella, true AS denso, (SELECT count(*) FROM documents) AS filas, 0 AS refused FROM documents"""
ORACLES["scan_strict"] = """
SELECT CASE WHEN doc_id % 7 = 0 THEN 'rechazo' ELSE 'fila' END AS parte, doc_id::VARCHAR AS clave FROM documents"""
ORACLES["published_metrics"] = ORACLES["global_metrics"]
ORACLES["published_confusion"] = ORACLES["confusion_dense"]
ORACLES["tickets_by_channel"] = f"""
SELECT canal, count(*) AS n_canal, count(*) AS n_total FROM ({ORACLES["unify_sources"]})
WHERE canal IN {members(CATALOGUE["canal"])} GROUP BY canal"""
ORACLES["run_report"] = f"""
WITH counted AS ({ORACLES["value_counts"]}), impact AS ({ORACLES["rule_impact"]})
SELECT 'total' AS metrica, '' AS clave, sum(n)::BIGINT AS valor FROM counted WHERE columna = 'canal'
UNION ALL SELECT 'por_' || columna, valor, n FROM counted
UNION ALL SELECT 'impacto_diccionarios', fuente || '.' || medida, valor
FROM (UNPIVOT impact ON filas_con_add, filas_con_neg, filas_ajustadas_por_reglas INTO NAME medida VALUE valor)"""
ORACLES["lot_from_file"] = ORACLES["score_lot_nb"]
