"""Rows with whole texts on their way to Python."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import functions as F

from ticketry.llm.common import BATCH_BYTES, keyed


def test_texts_go_to_python_by_their_size(spark):
    """Only the pipeline's stages used to ask for that; other operators got 10,000 texts at a time."""
    limit = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(limit, None)
    spark.conf.unset(limit)

    def sizes(batches):
        for batch in batches:
            size = sum(len(t.as_py()) for t in batch.column("__text"))
            yield pa.RecordBatch.from_arrays([pa.array([size], pa.int64())], ["size"])

    try:
        texts = spark.range(0, 60, 1, 1).select(
            F.col("id").alias("doc_id"), F.repeat(F.lit("ab"), 100_000).alias("text")
        )
        found = [r.size for r in keyed(texts).mapInArrow(sizes, "size long").collect()]
    finally:
        spark.conf.set(limit, before) if before else spark.conf.unset(limit)
    assert sum(found) == 12_000_000
    assert max(found) <= BATCH_BYTES + 200_000
