"""Multi-line records read split by split, next to Spark's reader of whole files."""

from __future__ import annotations

import random

import pytest

from ticketry.sources.files import Dialect, read_numbered, read_strict, read_tolerant
from ticketry.sources.records import parsed, read_records

SMALL = {
    "spark.sql.files.maxPartitionBytes": "2000", "spark.sql.files.openCostInBytes": "0",
    "spark.sql.files.minPartitionNum": "40",
}
CORRUPT = "_corrupt_record"


@pytest.fixture(params=["10m", "-1"], ids=["sent", "sorted"])
def splits(spark, request):
    """Splits of 2000 bytes, with the table of states sent to the rows or joined by sorting."""
    settings = {**SMALL, "spark.sql.autoBroadcastJoinThreshold": request.param}
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def cell(chance, quote):
    kind = chance.random()
    if kind < 0.3:
        return "".join(chance.choices("abc é", k=chance.randint(0, 8)))
    if kind < 0.5:
        inner = chance.choices(["a", "b", quote, "\n", ";", " ", "x\r\ny", "\n\n"], k=chance.randint(0, 12))
        return '"' + "".join(inner) + '"'
    if kind < 0.6:
        return 'say "hi" 5" pipe'
    if kind < 0.65:
        return '"x" tail'
    if kind < 0.67:
        return '"' + "a long line; with signs\n" * chance.randint(1, 300) + '"'
    return str(chance.randint(0, 99))


def body(seed, rows=1500, quote='""'):
    chance = random.Random(seed)
    lines = ["a;b;c"]
    for i in range(rows):
        width = chance.choice([3] * 9 + [2, 4])
        lines.append(";".join([str(i), *[cell(chance, quote) for _ in range(width - 1)]]))
        if chance.random() < 0.02:
            lines.append("")
    return "\n".join(lines) + "\n"


def whole_file(spark, path, escape='"', width=3):
    """Cells of Spark's reader that gives each file to one task, and whether their number is another."""
    fields = ", ".join(f"c{i} string" for i in range(width))
    rows = (
        spark.read.schema(f"{fields}, {CORRUPT} string")
        .options(sep=";", multiLine=True, header=True, enforceSchema=True, quote='"', escape=escape,
                 columnNameOfCorruptRecord=CORRUPT, columnPruning=False).csv(path).collect()
    )
    return [(*r[:width], r[width] is not None) for r in rows]


@pytest.mark.parametrize("escape, quote", [('"', '""'), ("\\", '\\"')])
def test_records_of_many_splits_are_those_of_the_whole_file(spark, tmp_path, splits, escape, quote):
    path = tmp_path / "t.csv"
    path.write_bytes(body(5, quote=quote).encode())
    assert spark.read.text(str(path)).rdd.getNumPartitions() > 30
    table = parsed(read_records(spark, str(path), ";", escape=escape), 3, ";", escape, CORRUPT)
    found = [(*r[3:6], r[6] is not None) for r in table.orderBy("_file", "_block", "_id").collect()]
    assert found == whole_file(spark, str(path), escape)


def test_positions_and_refused_rows_as_before(spark, tmp_path, splits):
    folder = tmp_path / "in"
    folder.mkdir()
    wanted, refused = [], 0
    for name, seed in (("a.csv", 1), ("b.csv", 2)):
        (folder / name).write_bytes(body(seed, 400).encode())
        # No row has more than four cells; those that have four are refused, short ones are filled up.
        for *cells, short in whole_file(spark, str(folder / name), width=4):
            if short:
                wanted.append(tuple(c or "" for c in cells[:3]))
            else:
                refused += 1
    table, left_out = read_numbered(spark, str(folder), "_p")
    rows = table.orderBy("_p").collect()
    assert [r._p for r in rows] == list(range(len(wanted))) and left_out.first().refused == refused
    assert [tuple(r[1:]) for r in rows] == wanted
    assert read_tolerant(spark, str(folder)).count() == len(wanted)


def test_a_cell_of_many_splits_and_returns(spark, tmp_path, splits):
    text = "line\r\n" * 3000
    path = tmp_path / "long.csv"
    path.write_bytes(f'a;b\r\n1;"{text}"\r\n2;"x"\r\n3;y\r\n4;"open to the end\nof the file'.encode("cp1252"))
    table, _ = read_numbered(spark, str(path), "_p", Dialect(";", "windows-1252", True))
    rows = table.orderBy("_p").collect()
    assert [(r.a, r.b) for r in rows[:3]] == [("1", text), ("2", "x"), ("3", "y")]
    assert rows[3].a == "4" and len(rows) == 4


def test_strict_rows_over_line_ends(spark, tmp_path):
    path = tmp_path / "s.csv"
    path.write_text('a;b\n1;"two\nlines, \\"said\\""\n2;x;y\n3;z\n')
    good, bad = read_strict(spark, str(path))
    assert sorted(tuple(r) for r in good.collect()) == [("1", 'two\nlines, "said"'), ("3", "z")]
    assert [r.linea for r in bad.collect()] == ["2;x;y"]


def test_a_file_of_a_header_only(spark, tmp_path):
    path = tmp_path / "h.csv"
    path.write_text('a;"b\nc"\n')
    table = read_tolerant(spark, str(path))
    assert table.columns == ["a", "b\nc"] and table.count() == 0
