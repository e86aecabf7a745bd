"""Registered queries: one per operator, each over whole tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from ticketry import catalogs as C
from ticketry.functions import dates, ids, text, values
from ticketry.operators import (
    bayes, classify as K, columns, features, kpi, metrics, models, normalize, quality, repair, training_sets, warehouse,
)
from ticketry.plans import lots, publish, warehouse_load
from ticketry.session import shared_folder, written
from ticketry.sources import files, sinks
from ticketry.sources.positions import parquet_positions
from ticketry.sources.snapshots import Snapshots
from ticketry.vocabulary import CATEGORIES, WILDCARD_TERMS, default_terms

from . import standins as S

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


def plain_times(df: DataFrame) -> DataFrame:
    """Dates and times as text, so results compare across engines."""
    return df.select(
        *[
            F.col(f.name).cast("string").alias(f.name)
            if f.dataType.typeName() in ("timestamp", "timestamp_ntz", "date") else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def rounded(df: DataFrame, *names: str, digits: int = 6) -> DataFrame:
    return df.withColumns({n: F.round(n, digits) for n in names})


# --- KPIs ---------------------------------------------------------------------------------
@query
def kpi_overview(spark, sf):
    return rounded(kpi.overview(S.facts(spark, sf)), "avg_frt_min", "avg_ttr_min", digits=4)


@query
def kpi_by_channel(spark, sf):
    return rounded(kpi.by_channel(S.facts(spark, sf)), "avg_frt_min", "avg_ttr_min", digits=4)


@query
def kpi_by_priority(spark, sf):
    return kpi.by_priority(S.facts(spark, sf))


@query
def kpi_daily_flow(spark, sf):
    return plain_times(kpi.daily_flow(S.facts(spark, sf)))


@query
def kpi_daily_flow_events(spark, sf):
    events = S.table(spark, sf, "events").select(
        "ts", F.when(F.col("event_type") != "error", F.col("ts")).alias("done")
    )
    return plain_times(kpi.daily_flow(events, "ts", "done"))


@query
def kpi_backlog(spark, sf):
    return kpi.backlog(S.facts(spark, sf), S.AS_OF)


@query
def kpi_monthly(spark, sf):
    return kpi.monthly(S.facts(spark, sf))


@query
def kpi_by_type(spark, sf):
    return kpi.by_type(S.facts(spark, sf))


@query
def kpi_incoherences(spark, sf):
    """Repaired facts hold none; the unrepaired ones show what the view finds."""
    raw = S.tickets_clean(spark, sf).select(
        F.col("k").alias("id_ticket"),
        dates.read_minute_text(F.col("fecha_creacion")).alias("fecha_creacion"),
        dates.read_minute_text(F.col("fecha_cierre")).alias("fecha_resolucion"),
    )
    return plain_times(kpi.incoherences(raw))


@query
def kpi_incoherences_repaired(spark, sf):
    return kpi.incoherences(S.facts(spark, sf)).agg(F.count("*").alias("n"))


@query
def kpi_accuracy_by_channel(spark, sf):
    return kpi.accuracy_by_channel(S.facts(spark, sf), S.predictions(spark, sf))


# --- cleaning -----------------------------------------------------------------------------
@query
def clean_channel(spark, sf):
    raw = S.tickets_raw(spark, sf)
    return raw.select(
        "k", values.channel(F.col("canal")).alias("canal"),
        values.document_channel(
            values.channel(F.col("canal")), F.col("resumen"), F.col("descripcion")
        ).alias("canal_final"),
    )


@query
def clean_priority(spark, sf):
    return S.tickets_raw(spark, sf).select("k", values.priority(F.col("prioridad")).alias("prioridad"))


@query
def clean_state(spark, sf):
    return S.tickets_raw(spark, sf).select("k", values.state(F.col("estado")).alias("estado"))


@query
def clean_sla(spark, sf):
    return S.tickets_raw(spark, sf).select("k", values.sla_flag(F.col("sla_met")).alias("sla_met"))


@query
def channel_from_text(spark, sf):
    return S.tickets_raw(spark, sf).select(
        "k", values.channel_from_text(F.col("resumen"), F.col("descripcion")).alias("canal")
    )


@query
def clean_staging(spark, sf):
    return warehouse.clean_staging(S.staging(spark, sf)).select(
        "k", "canal", "prioridad", "estado", "categoria", "sla_met", "origen", "id_origen"
    )


@query
def build_ids(spark, sf):
    return S.tickets_clean(spark, sf).select("k", "fuente", "id_ticket")


@query
def row_positions(spark, sf):
    return parquet_positions(S.table(spark, sf, "orders").select("o_orderkey"), "posicion")


@query
def surrogate_keys(spark, sf):
    codes = S.tickets_clean(spark, sf).select(F.col("id_ticket").alias("ticket_code"))
    return ids.ticket_numbers(codes)


@query
def parse_dates_flex(spark, sf):
    return plain_times(
        S.tickets_raw(spark, sf).select(
            "k", dates.flexible_datetime(F.col("fecha_creacion")).alias("creacion"),
            dates.flexible_datetime(F.col("first_reply_at")).alias("respuesta"),
            dates.flexible_datetime(F.col("fecha_cierre")).alias("cierre"),
        )
    )


@query
def parse_dates_sql(spark, sf):
    return plain_times(
        S.tickets_raw(spark, sf).select(
            "k", dates.staging_datetime(F.col("fecha_creacion")).alias("creacion"),
            dates.staging_datetime(F.col("first_reply_at")).alias("respuesta"),
            dates.staging_datetime(F.col("fecha_cierre")).alias("cierre"),
        )
    )


@query
def merge_alias_columns(spark, sf):
    """Two headers for one column: the first filled cell of each row wins."""
    k = F.col("k")
    raw = S.tickets_raw(spark, sf).select(
        F.col("k").alias("numero"),
        F.when(k % 2 == 0, F.lit("  ")).otherwise(F.col("resumen")).alias("Subject"),
        F.col("descripcion").alias("Short Description"),
        F.col("prioridad").alias("Ticket-Priority"),
    )
    merged = columns.canonical_columns(raw)
    return merged.select("numero", "resumen", "prioridad")


# --- classification -----------------------------------------------------------------------
def _score_columns():
    return [F.round(F.col(f"scores.{c}"), 4).alias(c.lower()) for c in CATEGORIES]


@query
def keyword_scores(spark, sf):
    raw = S.tickets_raw(spark, sf)
    scored = K.score_terms(raw, text.rule_text(F.col("resumen"), F.col("descripcion")))
    return scored.select("k", *_score_columns(), "boost_hits", "penalty_hits")


@query
def context_scores(spark, sf):
    return K.classify(S.tickets_raw(spark, sf).drop("categoria")).select(
        "k", *_score_columns(), "context_changed"
    )


@query
def categorize(spark, sf):
    return K.classify(S.tickets_raw(spark, sf).drop("categoria")).select("k", "categoria")


@query
def categorize_documents(spark, sf):
    """The rules over whole documents of any length."""
    docs = S.documents(spark, sf, "doc_id", "text").select(
        "doc_id", F.lit("").alias("resumen"), F.col("text").alias("descripcion")
    )
    return K.classify(docs).select("doc_id", *_score_columns(), "categoria")


@query
def keyword_scores_joined(spark, sf):
    """The vocabulary as a table, but for terms with wildcards, which are no words to join by; a term's
    weights in a category add up."""
    weights: dict[tuple[str, str], float] = {}
    for t in default_terms():
        if t.term not in WILDCARD_TERMS:
            weights[t.category, t.term] = weights.get((t.category, t.term), 0.0) + t.weight
    terms = [(c, t, w) for (c, t), w in weights.items()]
    vocabulary = C.inline_table(spark, terms, ["category", "term", "weight"]).withColumn(
        "weight", F.col("weight").cast("double")
    )
    raw = S.tickets_raw(spark, sf).select(
        "k", text.rule_text(F.col("resumen"), F.col("descripcion")).alias("t")
    )
    return K.score_terms_joined(raw, "k", F.col("t"), vocabulary, 4)


@query
def unify_sources(spark, sf):
    """The whole path: three inputs, each cleaned and classified, then united and repaired."""
    raw = S.tickets_raw(spark, sf)
    inputs = [
        raw.where(F.col("fuente") == name).drop("fuente") for name in ("kaggle_1", "sintetico_2", "sintetico")
    ]
    parts = [
        normalize.normalize_source(table, name, "k")
        for table, name in zip(inputs, ("kaggle_1", "sintetico_2", "sintetico"))
    ]
    tickets = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return repair.repair_closing_dates(tickets, S.AS_OF).select(*C.TICKET_COLUMNS)


@query
def rule_impact(spark, sf):
    return normalize.rule_impact(
        normalize.normalize_tickets(S.tickets_raw(spark, sf), "fuente", "k")
    )


@query
def value_counts(spark, sf):
    tickets = normalize.normalize_tickets(S.tickets_raw(spark, sf), "fuente", "k")
    return quality.value_counts(tickets, ["canal", "categoria"])


# --- repair -------------------------------------------------------------------------------
@query
def repair_dates(spark, sf):
    return S.tickets_repaired(spark, sf).select("k", "id_ticket", "estado", "fecha_cierre")


@query
def repair_audit(spark, sf):
    return repair.repair_audit(S.tickets_repaired(spark, sf))


@query
def repair_counts(spark, sf):
    return repair.repair_counts(repair.repair_audit(S.tickets_repaired(spark, sf)))


# --- warehouse ----------------------------------------------------------------------------
@query
def promote_gold(spark, sf):
    return plain_times(S.facts(spark, sf))


@query
def promotion_rejects(spark, sf):
    return warehouse.promotion_rejects(S.resolved(spark, sf)).select(
        "id_ticket", F.array_join("motivos", ",").alias("motivos")
    )


@query
def lineage(spark, sf):
    return warehouse.lineage(S.facts(spark, sf), S.staging(spark, sf))


def _earlier(facts):
    """Facts of an earlier load: every tenth ticket comes again, the others had other codes."""
    again = F.col("id_ticket") % 10 == 0
    code = F.when(again, F.col("ticket_code")).otherwise(F.concat(F.lit("V-"), "ticket_code"))
    return facts.withColumns({"ticket_code": code, "asunto": F.lit("antiguo")})


@query
def reload_facts(spark, sf):
    """Numbers of known tickets by value; those of new ones unique, dense, above the last."""
    load = written(S.resolved(spark, sf))
    existing = written(_earlier(S.facts_of(load)))
    after = written(warehouse.reload_facts(existing, load, warehouse.promote(load)))
    last = existing.agg(F.max("id_ticket").alias("_last"))
    checked = after.join(F.broadcast(last)).withColumn("_new", F.col("id_ticket") > F.col("_last"))
    dense = checked.where("_new").agg(
        (
            (F.count("*") == F.count_distinct("id_ticket"))
            & (F.max("id_ticket") - F.max("_last") == F.count("*"))
        ).alias("densos")
    )
    return checked.join(F.broadcast(dense)).select(
        F.when(~F.col("_new"), F.col("id_ticket")).alias("id_ticket"),
        "ticket_code", "asunto", "id_canal", "sla_met", "densos",
    )


@query
def reload_lineage(spark, sf):
    load = written(S.resolved(spark, sf))
    facts = written(S.facts_of(load).select("id_ticket", "ticket_code"))
    existing = _earlier(facts)
    old = existing.select("id_ticket", F.lit("synt").alias("origen"), F.col("ticket_code").alias("id_origen"))
    return warehouse.reload_lineage(old, existing, load, facts)


@query
def reload_snapshot(spark, sf):
    """Facts with their lineage as a reader finds them after a load on top of an earlier one."""
    root = f"{shared_folder(spark)}/gold-{uuid.uuid4().hex}"
    staging = written(S.staging(spark, sf))
    snapshots, existing = Snapshots(spark, root), _earlier(S.staged_facts(staging))
    origin = lambda fresh: fresh["f_tickets"].select(
        "id_ticket", F.lit("synt").alias("origen"), F.col("ticket_code").alias("id_origen")
    )
    snapshots.publish({"f_tickets": existing, "map_id_origen": origin}, 0, "earlier")
    version = warehouse_load.load(spark, root, staging, "again")
    tables = snapshots.read()
    return tables["f_tickets"].join(tables["map_id_origen"], "id_ticket", "full").select(
        "ticket_code", "asunto", "origen", "id_origen", "sla_met", F.lit(version).alias("version")
    )


@query
def first_per_key(spark, sf):
    """First line item of each part, of one with very many rows as of any other."""
    lines = S.table(spark, sf, "lineitem").select(
        "l_partkey", "l_orderkey", "l_linenumber", "l_quantity"
    )
    return warehouse.first_per_key(lines, ["l_partkey"], ["l_orderkey", "l_linenumber"])


@query
def ticket_view(spark, sf):
    return plain_times(warehouse.ticket_view(S.facts(spark, sf)))


@query
def ticket_code(spark, sf):
    some = S.facts(spark, sf).withColumn(
        "ticket_code", F.when(F.col("id_ticket") % 3 != 0, F.col("ticket_code"))
    )
    return warehouse.model_view(some)


@query
def training_view(spark, sf):
    return warehouse.training_view(S.facts(spark, sf))


@query
def pending(spark, sf):
    return warehouse.pending_view(S.facts(spark, sf), S.predictions(spark, sf))


@query
def pending_by_model(spark, sf):
    done = S.predictions(spark, sf)
    return warehouse.pending_view(S.facts(spark, sf), done, "v1.1").select("id_ticket")


@query
def load_predictions(spark, sf):
    facts = written(S.facts(spark, sf).select("id_ticket", "ticket_code"))
    codes = S.predicted_codes(spark, sf).where("modelo_version = 'SVM_v1.1'").select(
        F.col("id_ticket").alias("_id"), "pred_cat"
    )
    staged = facts.join(codes, F.col("id_ticket") == F.col("_id")).select(
        F.col("ticket_code").alias("id_ticket"), "pred_cat"
    )
    new = warehouse.load_predictions(staged, facts, "v1.1", S.AS_OF).drop("fecha_inferencia")
    table = warehouse.replace_version(S.predictions(spark, sf), new, "v1.1")
    return table.withColumn("score_predicho", F.col("score_predicho").cast("double"))


@query
def eval_gold(spark, sf):
    view = warehouse.evaluation_view(S.facts(spark, sf), S.predictions(spark, sf))
    return view.withColumn("score_predicho", F.col("score_predicho").cast("double"))


# --- quality ------------------------------------------------------------------------------
def _unrepaired_facts(spark, sf):
    """Facts as they would be without the repair, so that the checks have work to do."""
    clean = S.tickets_clean(spark, sf).withColumns(
        {"predicted": F.lit(None).cast("string"), "origen": F.lit(""), "id_origen": F.lit("")}
    )
    resolved = warehouse.resolve_dimensions(warehouse.clean_staging(clean))
    return warehouse.promote(resolved, keep=["k"]).withColumnRenamed("k", "id_ticket")


@query
def dq_checks(spark, sf):
    found = quality.violated(_unrepaired_facts(spark, sf), quality.fact_rules(), ["id_ticket"])
    return found.select("id_ticket", F.array_join("reglas", ",").alias("reglas"))


@query
def dq_score_range(spark, sf):
    return quality.violation_counts(S.predictions(spark, sf), quality.prediction_rules())


@query
def dq_keys(spark, sf):
    """Customers asking more than once: the uniqueness check on a key that repeats."""
    return quality.duplicate_keys(S.table(spark, sf, "orders"), ["o_custkey"])


@query
def dq_keys_facts(spark, sf):
    return quality.duplicate_keys(S.facts(spark, sf), ["ticket_code"]).agg(
        F.count("*").alias("n")
    )


@query
def dq_fk(spark, sf):
    """Predictions of tickets that never became facts."""
    return quality.orphans(
        S.predictions(spark, sf), "id_ticket", S.facts(spark, sf), "id_ticket"
    ).groupBy("modelo_version").agg(F.count("*").alias("n"))


@query
def dq_fk_dimensions(spark, sf):
    facts = S.facts(spark, sf)
    return quality.orphan_counts(
        facts,
        {
            "id_canal": C.d_canal(spark).where("id_canal < 4"),
            "id_prioridad": C.d_prioridad(spark).where("id_prioridad < 4"),
            "id_estado": C.d_estado(spark),
            "id_tipo_real": C.d_tipo(spark).where("id_tipo < 7"),
        },
    )


@query
def dq_fk_family(spark, sf):
    """Rows without parent for the references of lineage, predictions and results."""
    staging, scores = written(S.staging(spark, sf)), S.predictions(spark, sf)
    facts = written(S.staged_facts(staging).select("id_ticket", "ticket_code"))
    results = metrics.export_global(_counts(spark, sf, metrics.EXPERIMENT_COLUMNS))
    references = [
        ("map_id_origen.id_ticket", warehouse.lineage(facts, staging), "id_ticket", facts),
        ("prediccion.id_ticket", scores, "id_ticket", facts),
        ("prediccion.id_tipo_predicho", scores.withColumnRenamed("id_tipo_predicho", "id_tipo"), "id_tipo", C.d_tipo(spark)),
        ("prediccion.modelo_version", scores, "modelo_version", C.d_modelo(spark)),
        ("resultado.id_experimento", results, "id_experimento", C.ml_experimento(spark)),
        ("resultado.modelo_version", results, "modelo_version", C.d_modelo(spark)),
    ]
    counted = [
        quality.orphans(child, column, parent, column).agg(F.count("*").alias("filas"))
        .select(F.lit(name).alias("referencia"), "filas")
        for name, child, column, parent in references
    ]
    return reduce(DataFrame.unionByName, counted)


@query
def dq_catalog(spark, sf):
    return quality.catalogue_strays(S.tickets_clean(spark, sf))


@query
def dq_lengths(spark, sf):
    """Every column with a length, and every one that may not be missing."""
    rules = quality.length_rules(list(quality.STAGING_LENGTHS))
    rules |= quality.missing_rules(list(quality.STAGING_LENGTHS))
    return quality.violation_counts(S.staging(spark, sf), rules)


@query
def dq_reconcile(spark, sf):
    staging = written(S.staging(spark, sf))
    facts = written(S.staged_facts(staging))
    return quality.reconciliation(staging, facts, warehouse.lineage(facts, staging))


def _dated(tickets):
    return tickets.withColumns(
        {
            c: dates.read_minute_text(F.col(c))
            for c in ("fecha_creacion", "first_reply_at", "fecha_cierre")
        }
    )


@query
def dq_state_dates(spark, sf):
    return quality.violation_counts(
        _dated(S.tickets_clean(spark, sf)), quality.state_date_rules(S.AS_OF)
    )


@query
def dq_sla(spark, sf):
    return quality.violated(
        _dated(S.tickets_repaired(spark, sf)), quality.sla_rules(), ["k", "sla_met"]
    ).drop("reglas")


@query
def dq_repeated_sentences(spark, sf):
    return quality.repeated_sentences(S.documents(spark, sf, "text"), "text")


@query
def dq_repeated_texts(spark, sf):
    return quality.repeated_texts(S.documents(spark, sf, "text"), "text")


@query
def dq_shares(spark, sf):
    return quality.shares(K.classify(S.tickets_raw(spark, sf).drop("categoria")))


# --- training data and evaluation ---------------------------------------------------------
@query
def ml_split(spark, sf):
    return training_sets.split(warehouse.text_view(S.facts(spark, sf))).select("id_ticket", "split")


@query
def ml_split_documents(spark, sf):
    docs = S.labelled_documents(spark, sf)
    return docs.select("id_ticket", training_sets.split_part(F.col("id_ticket")).alias("part"))


@query
def text_quality(spark, sf):
    """Every text, and for each seventh document one more that is too short."""
    docs = S.documents(spark, sf, "doc_id", "text")
    short = docs.where("doc_id % 7 = 0").select(F.lit(" ññ ").alias("texto"))
    return training_sets.text_quality(docs.select(F.col("text").alias("texto")).unionByName(short))


@query
def class_dist_train(spark, sf):
    return training_sets.class_distribution(
        training_sets.train_split(warehouse.text_view(S.facts(spark, sf)))
    )


@query
def class_dist_valid(spark, sf):
    return training_sets.class_distribution(
        training_sets.valid_split(warehouse.text_view(S.facts(spark, sf)))
    )


@query
def stratified_folds(spark, sf):
    docs = S.documents(spark, sf, "doc_id", "lang")
    return training_sets.stratified_folds(docs, "lang", "doc_id")


@query
def confusion(spark, sf):
    view = warehouse.evaluation_view(S.facts(spark, sf), S.predictions(spark, sf))
    scored = view.where("pred_cat IS NOT NULL")
    return metrics.confusion(scored, "real_cat", "pred_cat")


def _counts(spark, sf, by=None):
    return metrics.confusion(S.predicted_codes(spark, sf), "real_cat", "pred_cat", by)


@query
def confusion_dense(spark, sf):
    return metrics.export_confusion(_counts(spark, sf, metrics.EXPERIMENT_COLUMNS))


@query
def confusion_norm(spark, sf):
    counts = _counts(spark, sf)
    dense = metrics.dense_confusion(counts, C.LABELS)
    return rounded(metrics.normalized_confusion(dense), "share")


@query
def class_report(spark, sf):
    return rounded(metrics.class_report(_counts(spark, sf)), "precision", "recall", "f1")


@query
def class_report_fixed_labels(spark, sf):
    """Labels without rows stay; rows with other labels weigh on the precision only."""
    counts = _counts(spark, sf)
    return rounded(
        metrics.class_report(counts, ["ACC", "APP", "HW", "MAIL", "POL"]),
        "precision", "recall", "f1",
    )


@query
def global_metrics(spark, sf):
    return metrics.export_global(_counts(spark, sf, metrics.EXPERIMENT_COLUMNS))


@query
def class_metrics(spark, sf):
    return metrics.export_classes(_counts(spark, sf, metrics.EXPERIMENT_COLUMNS))


@query
def results_bi(spark, sf):
    results = metrics.export_global(_counts(spark, sf, metrics.EXPERIMENT_COLUMNS))
    return metrics.global_results_view(
        results, C.ml_experimento(spark), C.d_modelo(spark)
    ).drop("tiempo_seg")


@query
def class_results_bi(spark, sf):
    staged = metrics.export_classes(_counts(spark, sf, metrics.EXPERIMENT_COLUMNS))
    return metrics.class_results_view(
        metrics.resolve_class_results(staged), C.ml_experimento(spark), C.d_modelo(spark)
    )


@query
def confusion_keys(spark, sf):
    return metrics.resolve_confusion(
        metrics.export_confusion(_counts(spark, sf, metrics.EXPERIMENT_COLUMNS))
    )


def _manual(spark, sf):
    """Manual labels: a different label for every seventeenth ticket, none for some."""
    k = F.col("k")
    label = F.when(k % 17 == 0, F.lit(" NET ")).otherwise(F.col("categoria"))
    return S.tickets_raw(spark, sf).where("k % 19 != 0").select(
        F.col("k").alias("id_ticket"), label.alias("categoria"), "resumen", "descripcion"
    )


@query
def hard_examples(spark, sf):
    scored = S.predicted_codes(spark, sf).where("modelo_version = 'SVM_v1.1'")
    return training_sets.mined_errors(scored, _manual(spark, sf))


@query
def augment(spark, sf):
    scored = S.predicted_codes(spark, sf).where("modelo_version = 'SVM_v1.1'")
    errors = training_sets.mined_errors(scored, _manual(spark, sf))
    train = (
        training_sets.train_split(warehouse.training_view(S.facts(spark, sf)))
        .join(F.broadcast(C.d_tipo(spark)), F.col("id_tipo_real") == F.col("id_tipo"))
        .select(
            "id_ticket", "texto", F.col("codigo").alias("real_cat"),
            F.col("id_canal").alias("canal"), F.col("id_prioridad").alias("prioridad"),
        )
    )
    return training_sets.augmented(train, errors).groupBy("real_cat", "canal").agg(
        F.count("*").alias("n"), F.sum(F.length("texto")).alias("letters")
    )


# --- features -----------------------------------------------------------------------------
@query
def tfidf_terms(spark, sf):
    docs = S.documents(spark, sf, "doc_id", "text")
    return rounded(features.tfidf(docs, "doc_id", "text"), "weight")


@query
def tfidf_sublinear(spark, sf):
    docs = S.documents(spark, sf, "doc_id", "text")
    return rounded(features.tfidf(docs, "doc_id", "text", sublinear=True), "weight")


@query
def tfidf_vocabulary(spark, sf):
    docs = S.documents(spark, sf, "doc_id", "text")
    counts = features.term_counts(docs, "doc_id", "text")
    return rounded(features.vocabulary(counts, docs), "idf")


@query
def onehot_meta(spark, sf):
    """Metadata of the validation documents, known from the training documents."""
    docs = S.labelled_documents(spark, sf)
    part = training_sets.split_part(F.col("id_ticket"))
    return features.one_hot(
        docs.where(part == 0), "id_ticket", ["canal", "prioridad"], docs.where(part != 0)
    )


# --- models -------------------------------------------------------------------------------
def _split_documents(spark, sf):
    docs = S.labelled_documents(spark, sf)
    return training_sets.train_split(docs), training_sets.valid_split(docs)


# Macro F1 that naive Bayes has to reach on the folds of a search.
GRID_FLOOR = 0.6


def _scored(spark, sf, spec):
    train, valid = _split_documents(spark, sf)
    return models.score_lot(models.train_model(train, spec), valid)


@query
def score_lot_nb(spark, sf):
    return bayes.score_lot(*_split_documents(spark, sf), 0.5)


@query
def score_lot_lr(spark, sf):
    return _scored(spark, sf, models.ModelSpec("lr", 2.0))


@query
def score_lot_svm(spark, sf):
    return _scored(spark, sf, models.ModelSpec("svm", 1.0))


@query
def score_lot_meta(spark, sf):
    """Text with damped counts and one-hot metadata."""
    return bayes.score_lot(
        *_split_documents(spark, sf), 0.5, sublinear=True, meta=models.META_COLUMNS
    )


@query
def grid_search(spark, sf):
    """Every point of the grid and every fold, and whether its macro F1 reaches a floor."""
    train, _ = _split_documents(spark, sf)
    found = models.grid_search(train, models.ModelSpec("nb"))
    return found.select("kind", "parameter", "fold", (F.col("f1_macro") >= GRID_FLOOR).alias("f1_alcanza"))


def _searched(spark, sf, kind):
    train, _ = _split_documents(spark, sf)
    return rounded(models.grid_search(train, models.ModelSpec(kind)), "f1_macro")


@query
def grid_search_nb(spark, sf):
    return _searched(spark, sf, "nb")


@query
def grid_search_lr(spark, sf):
    return _searched(spark, sf, "lr")


@query
def grid_search_svm(spark, sf):
    return _searched(spark, sf, "svm")


@query
def best_grid_point(spark, sf):
    train, _ = _split_documents(spark, sf)
    parameter, f1 = models.best_parameter(models.grid_search(train, models.ModelSpec("nb")))
    return spark.range(1).select(F.lit(parameter).alias("parameter"), F.round(F.lit(f1), 6).alias("f1_macro"))


# --- files ---------------------------------------------------------------------------------
def _folder(spark, name):
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def _exported(spark, table, name):
    """A table as text with header; cells keep their blanks and line ends."""
    path = _folder(spark, name)
    options = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False, "escapeQuotes": True}
    table.write.options(sep=";", header=True, escape='"', emptyValue="", nullValue="", **options).csv(path)
    return path


@query
def scan_multiline(spark, sf):
    """Texts with line ends in their cells, written as delimited files and found again by position."""
    docs = S.documents(spark, sf, "doc_id", "lang", "text")
    path = _exported(spark, docs, "multiline")
    rows, refused = files.read_numbered(spark, path, "position")
    dense = rows.agg(
        (F.count_distinct("position") == F.max("position") + 1).alias("denso"), F.count("*").alias("filas")
    )
    return rows.join(F.broadcast(dense)).join(F.broadcast(refused)).select(
        F.col("doc_id").cast("long").alias("doc_id"), "lang", F.md5("text").alias("huella"), "denso", "filas", "refused"
    )


# Bytes of text in a part of the strict scan's files, if there are more than eight.
STRICT_PART = 1 << 26


def _strict_parts(size: int | None) -> int:
    """Files to write a table of so many bytes to: a task writes a few of them at most."""
    return max(8, -(-(size or 0) // STRICT_PART))


@query
def scan_strict(spark, sf):
    """Good rows, and the lines that have a cell too many."""
    odd = F.when(F.col("doc_id") % 7 == 0, F.lit(";de mas")).otherwise(F.lit(""))
    text = F.regexp_replace(F.coalesce("text", F.lit("")), r'[\\"]', "'")
    docs = S.documents(spark, sf, "doc_id", "source", "text")
    parts = _strict_parts(docs.agg(F.sum(F.octet_length("text"))).first()[0])
    lines = docs.select(
        (F.col("doc_id") % parts).alias("part"), F.lit(1).alias("place"),
        F.concat(F.col("doc_id").cast("string"), F.lit(";"), "source", F.lit(';"'), text, F.lit('"'), odd).alias("value"),
    )
    heads = spark.range(parts).select(F.col("id").alias("part"), F.lit(0).alias("place"), F.lit("doc_id;source;text").alias("value"))
    path = _folder(spark, "strict")
    ordered = lines.unionByName(heads).repartition(parts, "part").sortWithinPartitions("part", "place")
    ordered.drop("place").write.partitionBy("part").text(path)
    good, bad = files.read_strict(spark, f"{path}/*")
    return good.select(F.lit("fila").alias("parte"), F.col("doc_id").alias("clave")).unionByName(
        bad.select(F.lit("rechazo").alias("parte"), F.split_part("linea", F.lit(";"), F.lit(1)).alias("clave"))
    )


def _prediction_files(spark, sf):
    """Each experiment's predictions in a folder of their own, under different headers."""
    scored, configs = S.predicted_codes(spark, sf), []
    for k, (experiment, number, version, dataset) in enumerate(
        (("E1", 1, "E1_NB", "VALID"), ("E1", 1, "E1_SVM", "VALID"), ("L4", 3, "SVM_v1.1", "L4_manual"))
    ):
        path = _folder(spark, "predictions")
        rows = scored.where(F.col("modelo_version") == version)
        if k == 1:
            rows = rows.withColumnsRenamed({"real_cat": "y_true", "pred_cat": "y_pred"})
            sinks.write_tickets(rows.select("id_ticket", "y_true", "y_pred", "ok"), path)
        else:
            sinks.write_predictions(rows, path)
        configs.append(
            {"path": path, "experimento": experiment, "id_experimento": number, "modelo_version": version, "dataset": dataset}
        )
    return configs


@query
def published_metrics(spark, sf):
    """From prediction files to the table of global figures."""
    out = _folder(spark, "results")
    publish.export_results(spark, _prediction_files(spark, sf), out)
    return spark.read.parquet(f"{out}/ml_resultado_global")


@query
def published_confusion(spark, sf):
    out = _folder(spark, "results")
    publish.export_results(spark, _prediction_files(spark, sf), out)
    return spark.read.parquet(f"{out}/ml_confusion")


@query
def tickets_by_channel(spark, sf):
    """Tickets written as one file set and as one per channel, counted in both."""
    tickets = written(unify_sources(spark, sf))
    one, each = _folder(spark, "tickets"), _folder(spark, "channels")
    sinks.write_tickets(tickets, one)
    sinks.write_by_channel(tickets, each)
    stated = files.Dialect(";", "UTF-8", True)
    counted = lambda path, n: files.read_tolerant(spark, path, stated).agg(F.count("*").alias(n))
    split = reduce(
        DataFrame.unionByName,
        [counted(f"{each}/canal={c}", "n_canal").withColumn("canal", F.lit(c)) for c in quality.CATALOGUE["canal"]],
    )
    whole = files.read_tolerant(spark, one, stated).groupBy("canal").agg(F.count("*").alias("n_total"))
    return split.join(whole, "canal")


@query
def run_report(spark, sf):
    tickets = normalize.normalize_tickets(S.tickets_raw(spark, sf), "fuente", "k")
    report, path = sinks.run_report(tickets, normalize.rule_impact(tickets)), _folder(spark, "report")
    sinks.write_report(report, path)
    return spark.read.schema("metrica string, clave string, valor long").json(path).select(
        "metrica", F.coalesce("clave", F.lit("")).alias("clave"), "valor"
    )


@query
def lot_from_file(spark, sf):
    """A lot from its file through a saved model to the file of predictions."""
    train, valid = _split_documents(spark, sf)
    model, out = _folder(spark, "model"), _folder(spark, "scored")
    models.train_model(train, models.ModelSpec("nb", 0.5)).save(model)
    lot = valid.select(
        "id_ticket", "canal", "prioridad", F.lit("").alias("resumen"), F.col("texto").alias("descripcion"),
        F.col("real_cat").alias("categoria"),
    )
    lots.run_lot(spark, model, _exported(spark, lot, "lot"), out, ["de", "en", "es", "fr"])
    return spark.read.schema("id_ticket long, real_cat string, pred_cat string, ok int").options(
        sep=";", header=True
    ).csv(f"{out}/predictions")
