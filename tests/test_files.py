"""CSV dialects, row positions and the run from files to outputs."""

from ticketry.plans import etl
from ticketry.sources.files import Dialect, probe, read_numbered, read_strict, read_tolerant

HEADER = "number;short_description;Content;priority;date;state;resolved_at;contact_type\n"


def write(path, body, encoding="utf-8"):
    path.write_bytes(body.encode(encoding))
    return str(path)


def test_tolerant_rows(spark, tmp_path):
    body = (
        "﻿a;b;c\n1;\"x;y\";\"say \"\"hi\"\"\"\n2;short\n3;4;5;6\n;;\n7;8;9\n"
    )
    path = write(tmp_path / "t.csv", body)
    table, refused = read_numbered(spark, path, "_p")
    assert refused.first().refused == 1
    rows = sorted(tuple(r) for r in table.select("_p", "a", "b", "c").collect())
    assert rows == [(0, "1", "x;y", 'say "hi"'), (1, "2", "short", ""), (2, "", "", ""),
                    (3, "7", "8", "9")]
    # The skipped row does not depend on the columns asked for.
    assert table.select("a").count() == 4 and read_tolerant(spark, path).select("a").count() == 4
    stated = Dialect(";", "UTF-8", False)
    assert read_tolerant(spark, path, stated).count() == 4
    good, bad = read_strict(spark, path)
    assert good.count() == 4 and [r.linea for r in bad.collect()] == ["3;4;5;6"]


def test_dialects(spark, tmp_path):
    assert probe(spark, write(tmp_path / "a.csv", "a|b\n1|\"x\ny\"\n")).multiline
    old = probe(spark, write(tmp_path / "b.csv", "a,b\nñ,1\n", "cp1252"))
    assert (old.separator, old.encoding, old.multiline) == (",", "windows-1252", False)
    signs = write(tmp_path / "c.csv", "a,precio €\nñ,5 €\n“x”,œ,zu viel\n", "cp1252")
    table, refused = read_numbered(spark, signs, "_p")
    assert [tuple(r) for r in table.collect()] == [(0, "ñ", "5 €")] and refused.first().refused == 1
    assert table.columns == ["_p", "a", "precio €"]


def test_run(spark, tmp_path):
    one = HEADER + (
        "INC1;VPN cae;sin red;p1;13/02/2024 10:00;closed;2024-02-01;phone\n"
        ";Correo lleno;outlook;low;2024-03-01T08:00:00Z;open;2024-03-02;email\n"
        "INC3;a;b;p1;13/02/2024 10:00;closed;2024-02-01;phone;one too many\n"
    )
    two = "id_ticket;canal;resumen;descripcion\nsynt2_9;EMAIL;leer el manual;x\n"
    sources = {
        "kaggle_1": write(tmp_path / "k.csv", one),
        "sintetico_2": write(tmp_path / "s.csv", two),
    }
    out = str(tmp_path / "out")
    etl.run(spark, sources, out, "2025-01-01 00:00:00")
    rows = {r.id_ticket: r for r in
            spark.read.options(sep=";", header=True).csv(f"{out}/tickets").collect()}
    assert set(rows) == {"kaggle1_INC1", "kaggle1_GEN2", "synt2_9"}
    first = rows["kaggle1_INC1"]
    assert (first.canal, first.prioridad, first.categoria) == ("PORTAL_INTERNO", "Urgente", "NET")
    assert first.fecha_cierre == "2024-02-13 10:00" and rows["kaggle1_GEN2"].fecha_cierre is None
    assert rows["synt2_9"].canal == "PORTAL_DOCUMENTAL"
    audit = spark.read.parquet(f"{out}/repair_audit")
    assert sorted(r.regla for r in audit.collect()) == [
        "1_open_with_close_cleared", "2_closed_without_close_imputed",
        "3_close_before_creation_cleared"]
    report = {(r.metrica, r.clave): r.valor for r in spark.read.json(f"{out}/report").collect()}
    assert report[("total", "")] == 3 and report[("por_canal", "EMAIL")] == 1
    assert report[("filas_descartadas", "kaggle_1")] == 1 and report[("filas_descartadas", "sintetico_2")] == 0
