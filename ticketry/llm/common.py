"""Helpers the operators share: lineage cuts, row keys, words, stores of a worker."""

from __future__ import annotations

import functools
import sys
import tempfile
import types
import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: White space of the word rule: blank, tab, line feed, vertical tab, form feed, return.
SPACES = " \t\n\x0b\x0c\r"
SPACE_RUN = "[\\x20\\x09-\\x0D]+"


def shared_folder(df: DataFrame) -> str:
    """The cluster's ``spark.checkpoint.dir``; a folder of our own only where none is set."""
    spark = df.sparkSession
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        named = tempfile.mkdtemp(prefix="llm-tables-")
        spark.conf.set("spark.checkpoint.dir", named)
    return named.rstrip("/")


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` as a table in the shared folder and go on from there.

    The table outlives its executors, so a lost one costs no more than its own tasks.
    """
    path = f"{shared_folder(df)}/llm-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Bytes of a batch of rows on its way to or from a Python worker, if it has more than one row.
BATCH_BYTES = 4 << 20


def small_batches(spark) -> None:
    """Rows go to Python by their size too, not by their number alone: 10,000 whole texts at a time are held
    several times over by each task, in the JVM and in its worker, and what they took is not given back."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or one like it that no column of ``df`` has."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def own_names(*known: str):
    """For operators that give back the columns they got: those that are not ``known`` to them travel
    under other names, so that a column may be called as it likes."""

    def wrapped(operator):
        @functools.wraps(operator)
        def run(documents: DataFrame, *args, **kwargs) -> DataFrame:
            others = [c for c in documents.columns if c not in known]
            apart = {c: f"other column {i}" for i, c in enumerate(others)}
            back = {b: a for a, b in apart.items()}
            renamed = lambda df, names: df.select(
                *[F.col(f"`{c}`").alias(names.get(c, c)) for c in df.columns]
            )
            return renamed(operator(renamed(documents, apart), *args, **kwargs), back)

        return run

    return wrapped


def keyed(df: DataFrame, *columns: str) -> DataFrame:
    """``__id``, ``__th`` and ``__text`` of each row, and the named columns.

    (``__id``, ``__th``) tells rows apart by id and text: ``__th`` is a hash of the text whose last
    bit says that the id is null (``__id`` is 0 then). Null text is empty text. Rows equal in both
    are copies of one row and get the same results. Their texts go to Python by ``small_batches``.
    """
    small_batches(df.sparkSession)
    text = F.coalesce(df["text"], F.lit(""))
    unknown = df["doc_id"].isNull().cast("long")
    return df.select(
        *[df[c] for c in columns],
        F.coalesce(df["doc_id"].cast("long"), F.lit(0)).alias("__id"),
        F.shiftleft(F.xxhash64(text), 1).bitwiseOR(unknown).alias("__th"),
        text.alias("__text"),
    )


def unknown() -> Column:
    """True for ``keyed`` rows whose id is null."""
    return F.col("__th").bitwiseAND(1) == 1


def doc_id() -> Column:
    """The id of a ``keyed`` row."""
    return F.when(~unknown(), F.col("__id")).alias("doc_id")


def worker_store(name: str) -> dict:
    """A dictionary that outlives the task in its Python worker (functions travel by value)."""
    module = sys.modules.setdefault("_llm_worker_store", types.ModuleType("_llm_worker_store"))
    return module.__dict__.setdefault(name, {})


def documents(spark, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
