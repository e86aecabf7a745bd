"""A lot of tickets from its file to predictions, figures and report."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from .. import catalogs as C
from ..functions.text import lot_text, strip_blank
from ..operators.columns import require_columns
from ..operators.metrics import class_report, confusion, global_report
from ..operators.models import load_model, score_lot
from ..sources import sinks
from ..sources.files import read_exported

LOT_COLUMNS = ["id_ticket", "canal", "prioridad", "resumen", "descripcion", "categoria"]


def read_lot(spark: SparkSession, path: str) -> DataFrame:
    """(id_ticket, canal, prioridad, texto, real_cat) of a lot file with manual labels."""
    lot = read_exported(spark, path)
    lot = require_columns(lot.toDF(*[c.strip().lower() for c in lot.columns]), LOT_COLUMNS)
    return lot.select(
        "id_ticket", "canal", "prioridad",
        lot_text(F.col("resumen"), F.col("descripcion")).alias("texto"),
        strip_blank(F.col("categoria")).alias("real_cat"),
    )


def publish_scores(
    scored: DataFrame, out: str, labels: list[str] | None = None
) -> DataFrame:
    """Predictions, figures (JSON) and report (table and text) under ``out``; the figures."""
    sinks.write_predictions(scored, f"{out}/predictions")
    kept = scored.sparkSession.read.options(sep=";", header=True).csv(f"{out}/predictions")
    counts = confusion(kept, "real_cat", "pred_cat")
    report, figures = class_report(counts, labels), global_report(counts, labels)
    sinks.write_table(report, f"{out}/report")
    sinks.write_text(sinks.report_text(report, figures), f"{out}/report_text")
    sinks.write_json(figures, f"{out}/metrics")
    return figures


def run_lot(
    spark: SparkSession, model: str, path: str, out: str, labels: list[str] | None = None
) -> DataFrame:
    """Score a lot file with a saved model, of whatever kind. The figures are over the fixed list of labels."""
    scored = score_lot(load_model(spark, model), read_lot(spark, path))
    return publish_scores(scored, out, C.LABELS if labels is None else labels)
