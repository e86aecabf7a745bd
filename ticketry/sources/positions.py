"""Row positions of scanned files, counted from zero, without sorting or moving the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

_ROW_BITS = 33  # monotonically_increasing_id keeps the row within its task in the low bits


def _starts(sizes: DataFrame, order: list[str]) -> DataFrame:
    """Rows before each piece. One row per file or split: thousands of bytes per petabyte."""
    before = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return sizes.withColumn("_start", F.coalesce(F.sum("_n").over(before), F.lit(0)))


def parquet_positions(df: DataFrame, name: str = "_position") -> DataFrame:
    """Position of each row over all files of a Parquet scan, files in path order.

    ``df`` must be the scan itself. Parquet knows the row's index within its file.
    """
    located = df.select(
        *df.columns,
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.row_index").alias("_row"),
    )
    files = df.select(F.col("_metadata.file_path").alias("_file"))
    sizes = files.groupBy("_file").agg(F.count("*").alias("_n"))
    starts = _starts(sizes, ["_file"]).drop("_n")
    return located.join(starts, "_file").select(
        *df.columns, (F.col("_start") + F.col("_row")).alias(name)
    )


def mark_places(scan: DataFrame) -> DataFrame:
    """Adds file, split and row id to the rows of a CSV or text scan, for ``number_places``."""
    return scan.select(
        *scan.columns,
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_id"),
    )


def number_places(marked: DataFrame, name: str = "_position") -> DataFrame:
    """Position of each row over all files, in path and file order, counted among the rows given.

    ``marked`` is a written table, so that the ids stand still. Rows are numbered inside their
    split, and the splits' sizes give each split its start: one row per split, about 800 000
    of them in 100 TB, are ordered in one task.
    """
    sizes = marked.groupBy("_file", "_block").agg(F.count("*").alias("_n"))
    starts = _starts(sizes, ["_file", "_block"]).drop("_n")
    inside = Window.partitionBy("_file", "_block").orderBy("_id")
    numbered = marked.withColumn("_in", F.row_number().over(inside) - 1)
    return numbered.join(starts, ["_file", "_block"]).select(
        *[c for c in marked.columns if c not in ("_file", "_block", "_id")],
        (F.col("_start") + F.col("_in")).alias(name),
    )
