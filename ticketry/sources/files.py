"""CSV sources of unknown dialect. Every cell is text; blanks stay blank."""

from __future__ import annotations

import csv
import io
import re
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from .. import catalogs as C
from ..operators.columns import first_available
from ..session import written
from .records import decoded, parsed, quoted_text, read_records, readable

SEPARATORS = [";", ",", "\t", "|"]
# Lines a separator is judged by; the data are read in full.
PROBE_LINES = 200
CORRUPT = "_corrupt_record"
# Bytes windows-1252 leaves undefined.
_UNDEFINED_1252 = "[\u0081\u008d\u008f\u0090\u009d]"


@dataclass(frozen=True)
class Dialect:
    separator: str
    encoding: str
    multiline: bool


def probe(spark: SparkSession, path: str, sample_lines: int = PROBE_LINES) -> Dialect:
    """Advice on a file: separator from its first ``sample_lines`` lines; encoding and multi-line cells from the whole text.

    One distributed pass decides what a task-by-task reader could not: whether any byte
    sequence is invalid, and whether any quoted cell may run over a line end. Files of both kinds are
    read by many tasks; those without such cells once less (see ``records``).
    """
    lines = spark.read.text(path)
    raw = F.col("value").cast("binary")
    quotes = F.octet_length("value") - F.octet_length(F.replace("value", F.lit('"'), F.lit("")))
    facts = lines.agg(
        F.bool_and(F.is_valid_utf8("value")).alias("utf8"),
        F.bool_or(F.decode(raw, "ISO-8859-1").rlike(_UNDEFINED_1252)).alias("undefined"),
        F.bool_or(quotes % 2 == 1).alias("multiline"),
    ).first()
    if facts.utf8 is None:
        raise ValueError(f"{path} holds no lines")
    encoding = "UTF-8" if facts.utf8 else ("ISO-8859-1" if facts.undefined else "windows-1252")
    return Dialect(_separator(lines, sample_lines), encoding, bool(facts.multiline))


def _separator(lines: DataFrame, sample_lines: int) -> str:
    """The sign that cuts the header into most cells; earlier lines decide a draw."""
    sample = [r.value for r in lines.limit(sample_lines).collect() if r.value and r.value.strip()]
    for line in sample:
        counts = {s: len(_cells(line, s)) for s in SEPARATORS}
        best = max(counts.values())
        leaders = [s for s, n in counts.items() if n == best]
        if best > 1 and len(leaders) == 1:
            return leaders[0]
    return ","


def _cells(line: str, separator: str) -> list[str]:
    return next(csv.reader(io.StringIO(line), delimiter=separator), [])


def _header(spark: SparkSession, path: str, dialect: Dialect) -> list[str]:
    """Header cells; a repeated name gets a counter, so every column can be addressed."""
    first = (
        spark.read.option("sep", dialect.separator).option("encoding", readable(dialect.encoding))
        .option("multiLine", dialect.multiline).option("header", False)
        .option("escape", '"').csv(path).limit(1).first()
    )
    names: list[str] = []
    for i, cell in enumerate(first):
        if cell and dialect.encoding == "windows-1252":
            cell = cell.encode("latin-1").decode("cp1252", "replace")
        name = (cell or f"Unnamed: {i}").removeprefix("﻿")
        repeat = sum(1 for n in names if n == name or n.startswith(name + "."))
        names.append(f"{name}.{repeat}" if name in names else name)
    return names


def _scan(
    spark: SparkSession, path: str, dialect: Dialect, names: list[str], escape: str
) -> DataFrame:
    """Cells c0, c1, ... and the corrupt record; with places (see ``mark_places``), where cells run over
    line ends."""
    if dialect.multiline:
        records = read_records(spark, path, dialect.separator, dialect.encoding, escape)
        return parsed(records, len(names), dialect.separator, escape, CORRUPT)
    schema = T.StructType(
        [T.StructField(f"c{i}", T.StringType()) for i in range(len(names))]
        + [T.StructField(CORRUPT, T.StringType())]
    )
    rows = (
        spark.read.schema(schema)
        .option("sep", dialect.separator).option("encoding", readable(dialect.encoding))
        .option("header", True).option("enforceSchema", True)
        .option("quote", '"').option("escape", escape)
        .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
        # Whether a row is too long must not depend on the columns a query asks for.
        .option("columnPruning", False)
        .csv(path)
    )
    if dialect.encoding != "windows-1252":
        return rows
    return rows.withColumns({c: decoded(F.col(c), dialect.encoding) for c in rows.columns})


def _too_long(width: int, separator: str, escape: str = '"') -> "F.Column":
    """A flagged row with more cells than the header; shorter rows are padded and kept."""
    # A quote opens a cell at its first place only; elsewhere it is a sign like any other.
    cell = rf'(?s)(^|{re.escape(separator)})"{quoted_text(escape)}(?:"|$)'
    bare = F.regexp_replace(CORRUPT, cell, "$1q")
    cells = F.size(F.split(bare, re.escape(separator), -1))
    # Spark refuses a scan that asks for the flag alone. The first cell, a part of its line,
    # goes along with it and decides nothing.
    part = F.char_length(F.coalesce("c0", F.lit(""))) <= F.char_length(CORRUPT)
    return F.coalesce(F.col(CORRUPT).isNotNull() & (cells > width) & part, F.lit(False))


def _finish(rows: DataFrame, names: list[str], keep: list[str]) -> DataFrame:
    return rows.select(
        *keep,
        *[F.coalesce(F.col(f"c{i}"), F.lit("")).alias(n) for i, n in enumerate(names)],
    )


def read_tolerant(spark: SparkSession, path: str, dialect: Dialect | None = None) -> DataFrame:
    """Any delimited file as text columns; rows longer than the header are left out.

    A caller that knows the dialect states it; otherwise it is probed, which reads the file
    once more.
    """
    dialect = dialect or probe(spark, path)
    names = _header(spark, path, dialect)
    scan = _scan(spark, path, dialect, names, '"')
    return _finish(scan.where(~_too_long(len(names), dialect.separator)), names, [])


def read_numbered(
    spark: SparkSession, path: str, position: str, dialect: Dialect | None = None
) -> tuple[DataFrame, DataFrame]:
    """The rows of ``read_tolerant`` with their place among them, and (refused): how many rows
    were left out.

    The file is parsed once, into a table; places and counts come from there.
    """
    from .positions import mark_places, number_places

    dialect = dialect or probe(spark, path)
    names = _header(spark, path, dialect)
    scan = _scan(spark, path, dialect, names, '"')
    marked = scan.withColumn("_long", _too_long(len(names), dialect.separator))
    if not dialect.multiline:
        marked = mark_places(marked)
    table = written(marked.drop(CORRUPT), "zstd")
    kept = number_places(table.where("NOT _long"), position)
    return _finish(kept, names, [position]), table.agg(F.count_if("_long").alias("refused"))


def read_exported(spark: SparkSession, path: str) -> DataFrame:
    """An exported table: as ``read_tolerant``, but a one-column reading is an error."""
    table = read_tolerant(spark, path)
    if len(table.columns) < 2:
        raise ValueError(f"{path}: one column only, no separator among {SEPARATORS} fits")
    return table


def read_strict(
    spark: SparkSession, path: str, dialect: Dialect | None = None
) -> tuple[DataFrame, DataFrame]:
    """Good rows, and the refused lines as a table, so nothing is lost unseen.

    Quotes are escaped by a backslash in these files.
    """
    dialect = dialect or probe(spark, path)
    names = _header(spark, path, dialect)
    scan = _scan(spark, path, dialect, names, "\\")
    long = _too_long(len(names), dialect.separator, "\\")
    return _finish(scan.where(~long), names, []), scan.where(long).select(
        F.col(CORRUPT).alias("linea")
    )


def read_semicolon(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Files the engine itself writes: ``;``, UTF-8, header."""
    return spark.read.options(sep=";", header=True, encoding="UTF-8", escape='"').csv(path)


def _headers(spark: SparkSession, paths: list[str]) -> dict[str, str]:
    """First line of every file, by one scan of all."""
    lines = spark.read.text(paths).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("at"),
        "value",
    )
    first = lines.where("at = 0").withColumn("row", F.monotonically_increasing_id())
    heads = first.groupBy("path").agg(F.min_by("value", "row").alias("head"))
    return {r["path"]: r["head"].lstrip("\ufeff") for r in heads.collect()}


def read_predictions(spark: SparkSession, configs: list[dict]) -> DataFrame:
    """Several prediction files as one table tagged with their experiment.

    Each config names ``path`` (a file or a folder of files), ``experimento``,
    ``id_experimento``, ``modelo_version`` and ``dataset``. Label columns may be called
    differently in every file: files with one header are one scan, and each row finds its
    config by the path it was read from.
    """
    tags = ("experimento", "id_experimento", "modelo_version", "dataset")
    paths = [c["path"].rstrip("/") for c in configs]
    known = C.inline_table(
        spark, [(p, *[c[t] for t in tags]) for p, c in zip(paths, configs)], ["_path", *tags]
    )
    plain = lambda p: F.regexp_replace(p, "^file:/+", "/")
    layouts: dict[str, list[str]] = {}
    for path, head in _headers(spark, paths).items():
        layouts.setdefault(head, []).append(path)
    parts = []
    for files in layouts.values():
        table = read_semicolon(spark, files)
        place = plain(F.col("_metadata.file_path"))
        folder = F.regexp_replace(place, "/[^/]*$", "")
        parts.append(
            table.select(
                "id_ticket",
                F.col(first_available(table, C.REAL_COLUMNS)).alias("real_cat"),
                F.col(first_available(table, C.PREDICTED_COLUMNS)).alias("pred_cat"),
                F.when(place.isin(paths), place).otherwise(folder).alias("_path"),
            )
        )
    return reduce(DataFrame.unionByName, parts).join(known, "_path").drop("_path")
