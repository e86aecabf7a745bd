"""Records of delimited text whose quoted cells may run over line ends, read split by split.

Whether a line begins inside a quoted cell depends on all lines before it. But a line only ever begins
in one of two states, at the start of a record or inside a quoted cell, so a line, and a split as well,
is a function from state to state. Each split is read under both states; chaining the functions, a row
per split, tells which of the two was right; then each split puts its own records together. Only
what is cut by the edge of a split is brought together over the network.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.text import quoted
from ..session import written

PLACE = "_file string, _block long"


#: Signs that windows-1252 has where ISO-8859-1 has controls; Spark reads the latter only.
_WESTERN = {chr(b): bytes([b]).decode("cp1252", "ignore") for b in range(0x80, 0xA0)}


def readable(encoding: str) -> str:
    """The encoding that Spark is to read: windows-1252 is read as the one it extends."""
    return "ISO-8859-1" if encoding == "windows-1252" else encoding


def decoded(text: Column, encoding: str) -> Column:
    """Text as it is in its own encoding, after Spark has read it as ``readable`` says."""
    if encoding != "windows-1252":
        return text
    known = {a: b for a, b in _WESTERN.items() if b}
    return F.translate(text, "".join(known), "".join(known.values()))


def quoted_text(escape: str) -> str:
    """Pattern of what a quoted cell holds; possessive, so that a long one is no depth of calls."""
    return r'(?:[^"]|"")*+' if escape == '"' else r'(?:[^"\\]|\\.|\\$)*+'


def _patterns(separator: str, escape: str) -> tuple[str, str]:
    """Lines that end inside a quoted cell, if they begin (with a record, inside such a cell).

    A quote opens a cell at the cell's first place only. What follows the closing quote up to the
    separator belongs to the cell.
    """
    s, inner = re.escape(separator), quoted_text(escape)
    cell = rf'(?:"{inner}"[^{s}]*+|[^"{s}][^{s}]*+|)'
    unclosed = rf'(?:{cell}{s})*+"{inner}$'
    return rf"(?s)^{unclosed}", rf'(?s)^{inner}(?:$|"[^{s}]*+{s}{unclosed})'


def _lines(spark: SparkSession, path: str, encoding: str, separator: str, escape: str) -> DataFrame:
    """Lines with their place, and where each function leads: ``opens`` and ``stays``."""
    text = F.col("value")
    if encoding != "UTF-8":
        text = decoded(F.decode(text.cast("binary"), readable(encoding)), encoding)
    opens, stays = _patterns(separator, escape)
    plain = ~F.contains("value", F.lit('"'))
    return spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_id"), text.alias("value"),
    ).select(
        "*",
        F.when(plain, F.lit(False)).otherwise(F.expr(f"value rlike {quoted(opens)}")).alias("opens"),
        F.when(plain, F.lit(True)).otherwise(F.expr(f"value rlike {quoted(stays)}")).alias("stays"),
    )


def _splits(batch: pa.RecordBatch) -> Iterator[tuple[str, int, pa.RecordBatch]]:
    """(file, block, rows) of the neighbouring rows of one split."""
    files, blocks = batch.column("_file").to_pylist(), batch.column("_block").to_numpy()
    edges = [0, *[i for i in range(1, len(files)) if blocks[i] != blocks[i - 1] or files[i] != files[i - 1]], len(files)]
    for low, high in zip(edges, edges[1:]):
        if high > low:
            yield files[low], int(blocks[low]), batch.slice(low, high - low)


def _states(opens: np.ndarray, stays: np.ndarray, inside: bool) -> tuple[np.ndarray, bool]:
    """Whether each line begins inside a cell, and the state behind the last one."""
    out = np.empty(len(opens), bool)
    # Lines that change nothing are passed over.
    moving = np.flatnonzero(opens | ~stays)
    last = 0
    for at in moving.tolist():
        out[last : at + 1] = inside
        inside = bool(stays[at] if inside else opens[at])
        last = at + 1
    out[last:] = inside
    return out, inside


FUNCTION = f"{PLACE}, after boolean, after_inside boolean, starts_inside boolean"


def _functions(batches):
    """A row per split: where it leads from either state, and whether a record starts in it if it
    begins inside a cell."""
    key, ends, starts = None, [False, True], False

    def row():
        values = (*key, *ends, starts)
        kinds = (pa.string(), pa.int64(), pa.bool_(), pa.bool_(), pa.bool_())
        names = [c.split()[0] for c in FUNCTION.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds)], names)

    for batch in batches:
        for file, block, rows in _splits(batch):
            if key != (file, block):
                if key is not None:
                    yield row()
                key, ends, starts = (file, block), [False, True], False
            opens, stays = (rows.column(c).to_numpy(zero_copy_only=False) for c in ("opens", "stays"))
            within, ends[1] = _states(opens, stays, ends[1])
            starts = starts or not within.all()
            _, ends[0] = _states(opens, stays, ends[0])
    if key is not None:
        yield row()


START = f"{PLACE}, inside boolean, opened long"


def _chained(batches):
    """The state each split begins in, and the split in which the cell that runs into it was opened.
    Rows come file by file, in order."""
    file, inside, opened = None, False, None
    for batch in batches:
        out = [[] for _ in range(4)]
        columns = (batch.column(c).to_pylist() for c in batch.schema.names)
        for f, block, after, after_inside, starts_inside in zip(*columns):
            if f != file:
                file, inside, opened = f, False, None
            for column, value in zip(out, (f, block, inside, opened if inside else None)):
                column.append(value)
            if not inside or starts_inside:
                opened = block
            inside = after_inside if inside else after
        kinds = (pa.string(), pa.int64(), pa.bool_(), pa.int64())
        names = [c.split()[0] for c in START.split(", ")]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], names)


RECORD = f"{PLACE}, _id long, record string, opened long, ends boolean, head boolean"


def _assembled(batches):
    """Records of each split. What began before it is marked by the split that opened it, what goes on
    behind it has no end."""
    names = [c.split()[0] for c in RECORD.split(", ")]
    kinds = (pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.bool_(), pa.bool_())
    key, state, opened, held, number, first = None, False, None, [], None, True
    out: list[list] = [[] for _ in names]

    def record(ends: bool):
        nonlocal held, opened, first
        text = "\n".join(held)
        row = (*key, number, text.removesuffix("\r") if ends else text, opened, ends, first and key[1] == 0)
        for column, value in zip(out, row):
            column.append(value)
        held, opened, first = [], None, False

    def flush():
        batch = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], names)
        for column in out:
            column.clear()
        return batch

    for batch in batches:
        for file, block, rows in _splits(batch):
            if key != (file, block):
                if held:
                    record(False)
                key, first = (file, block), True
                state = rows.column("inside")[0].as_py()
                opened = rows.column("opened")[0].as_py()
            opens, stays = (rows.column(c).to_numpy(zero_copy_only=False) for c in ("opens", "stays"))
            within, state = _states(opens, stays, state)
            goes_on = np.append(within[1:], state)
            lines = zip(rows.column("_id").to_pylist(), rows.column("value").to_pylist(), goes_on.tolist())
            for line, text, more in lines:
                if not held:
                    number = line
                held.append(text)
                if not more:
                    record(True)
        if out[0]:
            yield flush()
    if held:
        record(False)
    if out[0]:
        yield flush()


def read_records(
    spark: SparkSession, path: str, separator: str, encoding: str = "UTF-8", escape: str = '"'
) -> DataFrame:
    """(_file, _block, _id, record, head): the records of all files, as texts with their line ends.

    A record's place is that of its first line; ``head`` marks the first record of a file. Lines end in a
    line feed, or a return and a line feed; inside a cell they stay as they are. Files are read by as many
    tasks as they have splits: once for the states, once for the records that a split holds whole, and
    once for the pieces of those that it doesn't.
    """
    lines = _lines(spark, path, encoding, separator, escape)
    functions = lines.select("_file", "_block", "opens", "stays").mapInArrow(_functions, FUNCTION)
    starts = written(
        functions.repartition("_file").sortWithinPartitions("_file", "_block").mapInArrow(_chained, START)
    )
    # A row per split, in a written table whose size Spark knows. However it joins them, the lines of a
    # split stay in one task; they are put in order again.
    marked = lines.join(
        starts.select(F.col("_file").alias("_f"), F.col("_block").alias("_b"), "inside", "opened"),
        (F.col("_file") == F.col("_f")) & (F.col("_block") == F.col("_b")),
    )
    ordered = marked.drop("_f", "_b").sortWithinPartitions("_file", "_block", "_id")
    parts = ordered.mapInArrow(_assembled, RECORD)
    whole = parts.where("ends AND opened IS NULL").select("_file", "_block", "_id", "record", "head")
    # Cut records are two pieces a split at most. Looking for them reads the lines once more, which takes
    # less room than a table of all records.
    cut = parts.where("NOT ends OR opened IS NOT NULL").withColumn("_from", F.coalesce("opened", "_block"))
    piece = F.sort_array(F.collect_list(F.struct("_block", "_id", "record", "head")))
    joined = cut.groupBy("_file", "_from").agg(piece.alias("pieces")).select(
        "_file", F.col("pieces")[0]["_block"].alias("_block"), F.col("pieces")[0]["_id"].alias("_id"),
        F.array_join(F.transform("pieces", lambda p: p["record"]), "\n").alias("record"),
        F.col("pieces")[0]["head"].alias("head"),
    )
    return whole.unionByName(joined)


def parsed(records: DataFrame, width: int, separator: str, escape: str, corrupt: str) -> DataFrame:
    """Cells c0, c1, ... of each record (null where it is too short) and ``corrupt``: the record, if
    it has not ``width`` cells."""
    fields = ", ".join([*[f"c{i} STRING" for i in range(width)], f"{corrupt} STRING"])
    options = {"sep": separator, "quote": '"', "escape": escape, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt}
    cells = F.from_csv(F.col("record"), fields, options)
    # Lines that hold nothing are no records.
    return records.where(~F.col("head") & (F.trim("record") != "")).withColumn("_c", cells).select(
        *[c for c in records.columns if c not in ("record", "head")], "_c.*"
    )

