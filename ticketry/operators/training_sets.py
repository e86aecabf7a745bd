"""Training data: splits, class distribution, folds, mined errors, augmented sets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .. import catalogs as C
from ..functions.ids import spread_row_number
from ..functions.text import lot_text, strip_blank, usable_text
from .columns import require_columns

SPLIT_PARTS = 5


def split_part(key: Column) -> Column:
    """Part 0 to 4 of a key, the same on every run and every machine."""
    return (F.crc32(key.cast("string").cast("binary")) % SPLIT_PARTS).cast("int")


def split(texts: DataFrame, key: str = "id_ticket", text: str = "texto") -> DataFrame:
    """Usable texts with their ``split``, train or valid, in one pass."""
    side = F.when(split_part(F.col(key)) == 0, F.lit("valid")).otherwise(F.lit("train"))
    return texts.where(usable_text(F.col(text))).withColumn("split", side)


def train_split(texts: DataFrame, key: str = "id_ticket", text: str = "texto") -> DataFrame:
    return texts.where(usable_text(F.col(text)) & (split_part(F.col(key)) != 0))


def valid_split(texts: DataFrame, key: str = "id_ticket", text: str = "texto") -> DataFrame:
    return texts.where(usable_text(F.col(text)) & (split_part(F.col(key)) == 0))


def text_quality(texts: DataFrame, text: str = "texto") -> DataFrame:
    bad = ~F.coalesce(usable_text(F.col(text)), F.lit(False))
    return texts.agg(F.count_if(bad).alias("textos_invalidos"), F.count("*").alias("total"))


def class_distribution(split: DataFrame) -> DataFrame:
    """Rows per class code, largest first; unlabelled rows have no class."""
    types = F.broadcast(C.d_tipo(split.sparkSession))
    counted = split.groupBy("id_tipo_real").agg(F.count("*").alias("n"))
    return (
        counted.join(types, F.col("id_tipo_real") == F.col("id_tipo"))
        .select(F.col("codigo").alias("real_cat"), "n")
        .orderBy(F.desc("n"), "real_cat")
    )


def stratified_folds(
    df: DataFrame, label: str, key: str, folds: int = 5, seed: int = 42, name: str = "fold"
) -> DataFrame:
    """Fold 0..folds-1 for each row, every class spread evenly over the folds.

    Classes are shuffled by a hash of seed and key, and numbered slice by slice, so a class
    with a third of the rows is still numbered by many tasks. ``key`` must be unique.
    """
    shuffled = df.withColumn("_drawn", F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))
    numbered = spread_row_number(shuffled, "_drawn", by=[label], name="_row")
    return numbered.select(
        *df.columns, ((F.col("_row") - 1) % folds).cast("int").alias(name)
    )


def mined_errors(
    predictions: DataFrame, manual: DataFrame, weak: list[str] | None = None
) -> DataFrame:
    """Wrong predictions whose manual label is a weak class, with the text to learn from.

    Only wrong rows travel to the join; the manual label wins over the one predicted with.
    """
    require_columns(manual, ["id_ticket", "categoria"])
    require_columns(predictions, ["id_ticket", "real_cat", "pred_cat", "ok"])
    truth = manual.select(
        "id_ticket", strip_blank(F.col("categoria")).alias("real_cat"), "resumen", "descripcion"
    )
    return (
        predictions.where(F.col("ok") == 0).select("id_ticket", "pred_cat")
        .join(truth, "id_ticket", "left")
        .where(F.col("real_cat").isin(weak or C.WEAK_LABELS))
        .select(
            "id_ticket", "real_cat", "pred_cat", "resumen", "descripcion",
            lot_text(F.col("resumen"), F.col("descripcion")).alias("texto"),
        )
    )


def augmented(train: DataFrame, errors: DataFrame, tag: str = "lote_L1") -> DataFrame:
    """Training rows plus mined errors; the errors carry a tag instead of metadata."""
    extra = errors.select(
        F.col("id_ticket").cast("string").alias("id_ticket"), "texto", "real_cat",
        F.lit(tag).alias("canal"), F.lit(tag).alias("prioridad"),
    )
    base = train.select(
        F.col("id_ticket").cast("string").alias("id_ticket"), "texto", "real_cat",
        F.col("canal").cast("string").alias("canal"),
        F.col("prioridad").cast("string").alias("prioridad"),
    )
    return base.unionByName(extra)
