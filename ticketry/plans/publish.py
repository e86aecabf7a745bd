"""Predictions and their figures to the warehouse."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators import metrics, warehouse
from ..sources import sinks
from ..sources.files import read_predictions


def export_results(spark: SparkSession, configs: list[dict], out: str) -> None:
    """Global, per-class and confusion tables of all prediction files. The files are counted
    once; the counts, a few hundred rows per experiment, feed the three tables."""
    counts_path = f"{out}/counts"
    predictions = read_predictions(spark, configs)
    metrics.confusion(
        predictions, "real_cat", "pred_cat", metrics.EXPERIMENT_COLUMNS
    ).write.mode("overwrite").parquet(counts_path)
    counts = spark.read.parquet(counts_path)
    sinks.write_table(metrics.export_global(counts), f"{out}/ml_resultado_global")
    sinks.write_table(metrics.export_classes(counts), f"{out}/ml_resultado_por_clase")
    sinks.write_table(metrics.export_confusion(counts), f"{out}/ml_confusion")


def publish_version(
    staged: DataFrame, facts: DataFrame, modelo_version: str, path: str, as_of=None
) -> None:
    """Replace one model version in the prediction table; running it again changes nothing."""
    sinks.write_versions(
        warehouse.load_predictions(staged, facts, modelo_version, as_of), path
    )
