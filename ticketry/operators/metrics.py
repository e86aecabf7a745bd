"""Evaluation of predictions. Everything after the confusion counts is at most a few hundred
rows per experiment, so one aggregation over the predictions feeds all figures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .. import catalogs as C

EXPERIMENT_COLUMNS = ["experimento", "id_experimento", "modelo_version", "dataset"]


def confusion(df: DataFrame, real: str, predicted: str, by: list[str] | None = None) -> DataFrame:
    """Counts of (real, predicted) pairs that occur; ``by`` keeps experiments apart."""
    return (
        df.groupBy(*(by or []), F.col(real).alias("real_cat"), F.col(predicted).alias("pred_cat"))
        .agg(F.count("*").alias("n"))
    )


def _label_table(df: DataFrame, labels: list[str], name: str) -> DataFrame:
    return C.inline_table(df.sparkSession, [(v,) for v in labels], [name])


def dense_confusion(
    counts: DataFrame, labels: list[str], by: list[str] | None = None
) -> DataFrame:
    """Every pair of listed labels, zero where it never occurs.

    The grid is labels x labels per experiment: sized by the label list, not by the data.
    """
    by = by or []
    grid = _label_table(counts, labels, "real_cat").crossJoin(
        _label_table(counts, labels, "pred_cat")
    )
    if by:
        grid = counts.select(*by).distinct().crossJoin(F.broadcast(grid))
    return grid.join(counts, [*by, "real_cat", "pred_cat"], "left").select(
        *by, "real_cat", "pred_cat", F.coalesce("n", F.lit(0)).alias("n")
    )


def normalized_confusion(dense: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Share of each prediction within its real class; classes without rows are zero."""
    row = Window.partitionBy(*(by or []), "real_cat")  # label-list sized
    share = F.coalesce(F.try_divide(F.col("n"), F.sum("n").over(row)), F.lit(0.0))
    return dense.withColumn("share", share)


def _ratio(top: Column, bottom: Column) -> Column:
    return F.coalesce(F.try_divide(top.cast("double"), bottom.cast("double")), F.lit(0.0))


def class_report(
    counts: DataFrame, labels: list[str] | None = None, by: list[str] | None = None
) -> DataFrame:
    """Precision, recall, F1 and support per class, zero where undefined.

    ``labels`` fixes the classes (those without rows stay, others only weigh on the
    precision of listed ones); without it every class that was seen is reported.
    """
    by = by or []
    n, same = F.col("n"), F.col("real_cat").eqNullSafe(F.col("pred_cat"))
    zero = F.lit(0).cast("long")
    sides = counts.select(
        *by,
        F.explode(
            F.array(
                F.struct(
                    F.col("real_cat").alias("label"), n.alias("support"), zero.alias("predicted"),
                    F.when(same, n).otherwise(zero).alias("hits"),
                ),
                F.struct(
                    F.col("pred_cat").alias("label"), zero.alias("support"),
                    n.alias("predicted"), zero.alias("hits"),
                ),
            )
        ).alias("s"),
    ).select(*by, "s.*")
    totals = sides.groupBy(*by, "label").agg(
        F.sum("support").alias("support"), F.sum("predicted").alias("predicted"),
        F.sum("hits").alias("hits"),
    )
    if labels is not None:
        listed = _label_table(counts, labels, "label")
        if by:
            listed = counts.select(*by).distinct().crossJoin(F.broadcast(listed))
        totals = listed.join(totals, [*by, "label"], "left").select(
            *by, "label",
            *[F.coalesce(c, zero).alias(c) for c in ("support", "predicted", "hits")],
        )
    precision = _ratio(F.col("hits"), F.col("predicted"))
    recall = _ratio(F.col("hits"), F.col("support"))
    # 2pr/(p+r) written with counts
    f1 = _ratio(2 * F.col("hits"), F.col("support") + F.col("predicted"))
    return totals.select(
        *by, "label", precision.alias("precision"), recall.alias("recall"), f1.alias("f1"),
        "support", "predicted", "hits",
    )


def global_report(
    counts: DataFrame, labels: list[str] | None = None, by: list[str] | None = None
) -> DataFrame:
    """Accuracy and macro and weighted averages, one row per experiment."""
    by = by or []
    report = class_report(counts, labels, by)
    averages = report.groupBy(*by).agg(
        *[F.avg(m).alias(f"{m}_macro") for m in ("precision", "recall", "f1")],
        *[
            _ratio(F.sum(F.col(m) * F.col("support")), F.sum("support")).alias(f"{m}_weighted")
            for m in ("precision", "recall", "f1")
        ],
    )
    right = F.sum(F.when(F.col("real_cat") == F.col("pred_cat"), F.col("n")).otherwise(0))
    accuracy = counts.groupBy(*by).agg(
        _ratio(right, F.sum("n")).alias("accuracy"), F.sum("n").alias("n")
    )
    if not by:
        return accuracy.join(F.broadcast(averages))
    return accuracy.join(averages, by)


def _percent(name: str) -> Column:
    return F.round(F.col(name) * 100, 2)


def export_global(counts: DataFrame, labels: list[str] | None = None) -> DataFrame:
    report = global_report(counts, labels or C.LABELS, EXPERIMENT_COLUMNS)
    return report.select(
        *EXPERIMENT_COLUMNS,
        _percent("accuracy").alias("accuracy_pct"),
        _percent("f1_macro").alias("f1_macro_pct"),
        _percent("f1_weighted").alias("f1_weighted_pct"),
        _percent("precision_macro").alias("precision_macro_pct"),
        _percent("recall_macro").alias("recall_macro_pct"),
        F.col("n").alias("n_muestras"),
    )


def export_classes(counts: DataFrame, labels: list[str] | None = None) -> DataFrame:
    report = class_report(counts, labels or C.LABELS, EXPERIMENT_COLUMNS)
    return report.select(
        *EXPERIMENT_COLUMNS, F.col("label").alias("real_cat"),
        _percent("precision").alias("precision_pct"), _percent("recall").alias("recall_pct"),
        _percent("f1").alias("f1_pct"), F.col("support").alias("soporte_n"),
    )


def export_confusion(counts: DataFrame, labels: list[str] | None = None) -> DataFrame:
    return dense_confusion(counts, labels or C.LABELS, EXPERIMENT_COLUMNS)


# --- results in the warehouse -------------------------------------------------------------
def resolve_class_results(staged: DataFrame) -> DataFrame:
    """Staged per-class results with the label exchanged for its key."""
    types = F.broadcast(C.d_tipo(staged.sparkSession).select("id_tipo", "codigo"))
    return staged.join(types, F.col("real_cat") == F.col("codigo")).select(
        "id_experimento", "modelo_version", "dataset", F.col("id_tipo").alias("id_tipo_real"),
        "precision_pct", "recall_pct", "f1_pct", "soporte_n",
    )


def resolve_confusion(staged: DataFrame) -> DataFrame:
    spark = staged.sparkSession
    real = F.broadcast(C.d_tipo(spark).select(F.col("id_tipo").alias("id_real"), F.col("codigo").alias("real_cat")))
    pred = F.broadcast(C.d_tipo(spark).select(F.col("id_tipo").alias("id_pred"), F.col("codigo").alias("pred_cat")))
    return staged.join(real, "real_cat").join(pred, "pred_cat").select(
        "id_experimento", "modelo_version", "dataset", "id_real", "id_pred", "n"
    )


def global_results_view(results: DataFrame, experiments: DataFrame, models: DataFrame) -> DataFrame:
    """Global results with the names of experiment and model. Registries are tiny."""
    exps = experiments.select(
        "id_experimento", F.col("codigo").alias("experimento"),
        F.col("descripcion").alias("experimento_desc"),
    )
    return (
        results.drop("experimento").join(exps, "id_experimento")
        .join(models.select("modelo_version", "algoritmo", "params_resumen"), "modelo_version")
        .select(
            "experimento", "experimento_desc", "dataset", "modelo_version", "algoritmo",
            "params_resumen", "n_muestras",
            *([F.col("tiempo_seg")] if "tiempo_seg" in results.columns
              else [F.lit(None).cast("decimal(8,2)").alias("tiempo_seg")]),
            "accuracy_pct", "f1_macro_pct", "f1_weighted_pct", "precision_macro_pct",
            "recall_macro_pct",
        )
    )


def class_results_view(results: DataFrame, experiments: DataFrame, models: DataFrame) -> DataFrame:
    """Per-class results with the names of experiment, model and type."""
    spark = results.sparkSession
    exps = experiments.select("id_experimento", F.col("codigo").alias("experimento"))
    types = C.d_tipo(spark).select(
        F.col("id_tipo").alias("id_tipo_real"), F.col("codigo").alias("real_cat"),
        F.col("nombre").alias("real_cat_nombre"),
    )
    return (
        results.join(exps, "id_experimento")
        .join(models.select("modelo_version", "algoritmo"), "modelo_version")
        .join(F.broadcast(types), "id_tipo_real")
        .select(
            "experimento", "dataset", "modelo_version", "algoritmo", "real_cat",
            "real_cat_nombre", "precision_pct", "recall_pct", "f1_pct", "soporte_n",
        )
    )
