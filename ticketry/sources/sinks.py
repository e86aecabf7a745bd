"""Writers. Outputs are folders written by all tasks; nothing is gathered first."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..operators.quality import CATALOGUE, value_counts


def write_tickets(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """The unified data set as ``;`` separated text with header."""
    df.write.mode(mode).options(
        sep=";", header=True, encoding="UTF-8", escape='"', emptyValue="", nullValue=""
    ).csv(path)


def write_by_channel(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One folder per known channel. Tasks write their own rows to each folder, so a channel
    with most of the tickets is still written by many tasks. An overwrite replaces all
    channels, also those that have no rows any more."""
    df.where(F.col("canal").isin(CATALOGUE["canal"])).write.mode(mode).partitionBy("canal").options(
        partitionOverwriteMode="static", sep=";", header=True, encoding="UTF-8", escape='"', emptyValue="", nullValue=""
    ).csv(path)


def run_report(tickets: DataFrame, impact: DataFrame) -> DataFrame:
    """(metric, key, value): total, counts per channel and category, dictionary impact."""
    counts = value_counts(tickets, ["canal", "categoria"])
    per_value = counts.select(
        F.concat(F.lit("por_"), "columna").alias("metrica"), F.col("valor").alias("clave"),
        F.col("n").alias("valor"),
    )
    total = counts.where("columna = 'canal'").agg(F.sum("n").alias("valor")).select(
        F.lit("total").alias("metrica"), F.lit("").alias("clave"), "valor"
    )
    measures = [c for c in impact.columns if c != "fuente"]
    impacts = impact.unpivot(["fuente"], measures, "medida", "valor").select(
        F.lit("impacto_diccionarios").alias("metrica"),
        F.concat_ws(".", "fuente", "medida").alias("clave"), "valor",
    )
    return total.unionByName(per_value).unionByName(impacts)


def write_report(report: DataFrame, path: str) -> None:
    report.write.mode("overwrite").json(path)


def write_predictions(df: DataFrame, path: str) -> None:
    """Scored tickets (id_ticket, real_cat, pred_cat, ok) as ``;`` separated text."""
    write_tickets(df.select("id_ticket", "real_cat", "pred_cat", "ok"), path)


def write_versions(predictions: DataFrame, path: str) -> None:
    """Prediction table by model version: only the versions in ``predictions`` are replaced."""
    predictions.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
        "modelo_version"
    ).parquet(path)


def write_table(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Audit logs, metric tables and warehouse tables."""
    df.write.mode(mode).parquet(path)


def report_text(report: DataFrame, averages: DataFrame) -> DataFrame:
    """A class report as lines of text: a line per class, accuracy, macro and weighted means."""
    line = "%-14s %9.4f %9.4f %9.4f %9d"
    classes = report.select(
        F.lit(1).alias("part"), "label",
        F.format_string(line, "label", "precision", "recall", "f1", "support").alias("value"),
    )
    means = averages.select(
        F.explode(
            F.array(
                F.struct(
                    F.lit(2).alias("part"),
                    F.format_string("%-14s %29.4f %9d", F.lit("accuracy"), "accuracy", "n").alias("value"),
                ),
                *[
                    F.struct(
                        F.lit(part).alias("part"),
                        F.format_string(
                            line, F.lit(f"{kind} avg"), f"precision_{kind}", f"recall_{kind}",
                            f"f1_{kind}", "n",
                        ).alias("value"),
                    )
                    for part, kind in ((3, "macro"), (4, "weighted"))
                ],
            )
        ).alias("m")
    ).select("m.part", F.lit("").alias("label"), "m.value")
    # A line per class: one small file, in order.
    return classes.unionByName(means).coalesce(1).sortWithinPartitions("part", "label").select("value")


def write_text(lines: DataFrame, path: str) -> None:
    lines.write.mode("overwrite").text(path)


def write_json(figures: DataFrame, path: str) -> None:
    """Metrics and best parameters: one row, one file."""
    figures.coalesce(1).write.mode("overwrite").json(path)


def write_ranking(ranking: DataFrame, path: str) -> None:
    """Models by macro F1, best first, as one ``;`` separated file (a row per model)."""
    write_tickets(ranking.coalesce(1).sortWithinPartitions(F.desc("f1_macro"), "modelo"), path)
