"""Score lot files as they arrive: the batch scoring, file after file, stateless."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.text import lot_text, strip_blank
from ..operators.models import TextModel, score_lot

LOT_SCHEMA = (
    "id_ticket string, canal string, prioridad string, resumen string, descripcion string,"
    " categoria string"
)


def read_lots(spark: SparkSession, folder: str) -> DataFrame:
    """Lot files of one header (``;``, UTF-8) with text and real label."""
    lots = spark.readStream.schema(LOT_SCHEMA).options(sep=";", header=True, escape='"').csv(folder)
    return lots.select(
        "id_ticket", "canal", "prioridad",
        lot_text(F.col("resumen"), F.col("descripcion")).alias("texto"),
        strip_blank(F.col("categoria")).alias("real_cat"),
        F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1).alias("lote"),
    )


def score_arriving(
    spark: SparkSession, model: TextModel, folder: str, out: str, checkpoint: str
) -> StreamingQuery:
    """Start the stream for the files that are there now; each file is scored once.

    A batch writes its own files' folders anew, so one that runs again after a failure leaves the same
    rows. ``checkpoint`` must lie in a folder all executors share.
    """

    def score(batch: DataFrame, _: int) -> None:
        lots = batch.persist()
        try:
            scored = score_lot(model, lots).join(lots.select("id_ticket", "lote"), "id_ticket")
            scored.select("lote", "id_ticket", "real_cat", "pred_cat", "ok").write.mode("overwrite").option(
                "partitionOverwriteMode", "dynamic"
            ).partitionBy("lote").parquet(out)
        finally:
            lots.unpersist()

    return (
        read_lots(spark, folder).writeStream.foreachBatch(score)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
