"""Edge cases of single operators, against values worked out by hand or by brute force."""

import datetime as dt
import itertools

import pytest
from pyspark.sql import functions as F

from ticketry import catalogs as C
from ticketry.functions import dates, ids, text, values
from ticketry.operators import classify, columns, metrics, repair, training_sets, warehouse
from ticketry.vocabulary import default_terms


def column(spark, cells, expression):
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cells)], "i int, x string")
    return [r.y for r in df.select("i", expression(F.col("x")).alias("y")).orderBy("i").collect()]


def test_flexible_dates(spark):
    cells = ["2024-01-01T10:00:00Z", "2024-01-01T23:30:00-05:00", "13/02/2024", "02/13/2024",
             "31/02/2024", "1-2-2024 9:05", "", "n/a", "2024-05", None]
    got = column(spark, cells, lambda c: dates.minute_text(dates.flexible_datetime(c)))
    assert got == ["2024-01-01 10:00", "2024-01-01 23:30", "2024-02-13 00:00",
                   "2024-02-13 00:00", "", "2024-02-01 09:05", "", "", "", ""]


def test_staging_dates(spark):
    cells = ["2024-01-01T10:00:00Z", "01/02/2024 9:05", "1-2-2024", "02/13/2024", "2024-2-1",
             "01/02/2024T10:00:00", "2024-01-01 10:00:00.250", " 2024-01-01"]
    got = column(spark, cells, lambda c: dates.minute_text(dates.staging_datetime(c)))
    assert got == ["2024-01-01 10:00", "2024-02-01 09:05", "2024-02-01 00:00", "", "", "",
                   "2024-01-01 10:00", ""]


def test_whole_minutes_go_towards_zero(spark):
    at = lambda s: F.lit(f"2024-01-01 {s}").cast("timestamp_ntz")
    row = spark.range(1).select(
        dates.minutes_between(at("00:00:00"), at("00:01:01")).alias("a"),
        dates.minutes_between(at("00:01:01"), at("00:00:00")).alias("b"),
    ).first()
    assert (row.a, row.b) == (1, -1)


def test_value_maps(spark):
    assert column(spark, ["Urgent", "urgente", "p1", None], values.priority) == [
        "Alta", "Media", "Urgente", "Media"]
    assert column(spark, ['="TRUE"', "'0", "sí", " Yes\t"], values.sla_flag) == [
        "true", "false", "", "true"]
    assert column(spark, ["Critica", "Crítica", "CRITICA"], text.match_key) == ["critica"] * 3


def scored(spark, *texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    rows = classify.score_terms(df, F.col("t")).orderBy("i").collect()
    return [r.scores for r in rows]


def test_terms(spark):
    both, end, inside, wild, broken, comma, nested = scored(
        spark, "Autenticación", "the vpn", "xvpn vpnx", "802x1x", "no\n internet",
        "no, internet", "oracle database",
    )
    assert both.ACC == 2.0  # known in two spellings
    assert end.NET == 1.0 and inside.NET == 0.0 and wild.NET == 1.5
    assert broken.NET == 1.0 and comma.NET == 0.0
    assert nested.APP == 2.0 and nested.HW == -1.0


def test_terms_against_single_patterns(spark):
    """The one-pass scan finds what one pattern per term finds."""
    import re

    words = ["oracle", "database", "db", "no", "internet", "access", "ndr", "auto-reply", "sap",
             "gui", "grant", "to", "red", "cable", "de", "802.1x", "power", "bi", "dataset"]
    texts = [" ".join(p) for p in itertools.permutations(words, 3)][::7]
    expected = []
    for t in texts:
        expected.append(sum(
            term.weight for term in default_terms()
            if re.search(rf"(?<!\w){term.term.replace(' ', chr(92) + 's+')}(?!\w)", t, re.I)
        ))
    got = [sum(r) for r in scored(spark, *texts)]
    assert got == pytest.approx(expected)


def test_decision(spark):
    df = spark.createDataFrame(
        [(1, "", ""), (2, "password email", ""), (3, "switched", "")],
        "i int, resumen string, descripcion string",
    )
    got = {r.i: r.categoria for r in classify.classify(df).collect()}
    assert got == {1: "SRV", 2: "MAIL", 3: "NET"}


def stepwise(opened, replied, closed, state, now):
    """The repair as six successive corrections of one date."""
    log, c = [], closed
    candidates = [d for d in (replied, opened) if d]
    latest = max(candidates) if candidates else None
    if c and c > now:
        log.append("A_future_close_cleared"); c = None
    if c and state in C.OPEN_STATES:
        log.append("1_open_with_close_cleared"); c = None
    if c and opened and c < opened:
        log.append("3_close_before_creation_cleared"); c = None
    if c and replied and c < replied:
        if state in C.CLOSED_STATES:
            log.append("4_close_before_first_fixed_to_max"); c = latest
        else:
            log.append("4_close_before_first_cleared_open_state"); c = None
    if not c and state in C.CLOSED_STATES and latest:
        log.append("2_closed_without_close_imputed"); c = latest
    return c or "", log


def test_repair_equals_the_cascade(spark):
    days = [None, "2024-01-01 00:00", "2024-01-02 00:00", "2024-01-03 00:00", "2024-01-09 00:00"]
    cases = [
        (str(i), o or "", f or "", c or "", s)
        for i, (o, f, c, s) in enumerate(
            itertools.product(days, days, days, ["Abierto", "Cerrado", "Otro"]))
    ]
    df = spark.createDataFrame(
        cases, "id_ticket string, fecha_creacion string, first_reply_at string,"
        " fecha_cierre string, estado string")
    now = "2024-01-05 00:00"
    fixed = repair.repair_closing_dates(df, now + ":00")
    got = {r.id_ticket: (r.fecha_cierre, [c.regla for c in r.cambios]) for r in fixed.collect()}
    for i, o, f, c, s in cases:
        assert got[i] == stepwise(o or None, f or None, c or None, s, now), (o, f, c, s)
    again = repair.repair_closing_dates(fixed.drop("cambios"), now + ":00")
    assert {r.id_ticket: r.fecha_cierre for r in again.collect()} == {
        k: v[0] for k, v in got.items()}


def test_merged_headers_and_ids(spark):
    df = spark.createDataFrame([(" ", "b"), ("a", "c")], ["Subject", "Short Description"])
    assert sorted(r.resumen for r in columns.canonical_columns(df).collect()) == ["a", "b"]
    rows = spark.createDataFrame(
        [("kaggle_1", "", 4), ("kaggle_1", "K1_x", 0), ("sintetico", "7", 0)],
        "s string, o string, p int")
    got = [r.x for r in rows.select(
        ids.source_id(F.col("s"), F.col("o"), F.col("p")).alias("x")).collect()]
    assert got == ["kaggle1_GEN5", "K1_x", "synt_7"]


def test_known_tickets_keep_their_number(spark):
    codes = spark.createDataFrame([("a",), ("b",), ("c",), ("a",)], "ticket_code string")
    known = spark.createDataFrame([("b", 777), ("z", 900)], "ticket_code string, id_ticket long")
    got = {r.ticket_code: r.id_ticket for r in ids.ticket_numbers(codes, known).collect()}
    assert got["b"] == 777 and sorted(got.values()) == [777, 901, 902]


def test_first_row_of_a_hot_key(spark):
    df = spark.range(3000).selectExpr("if(id % 3 = 0, 0, id) AS k", "id AS o", "id * 2 AS v")
    got = {r.k: (r.o, r.v) for r in warehouse.first_per_key(df, ["k"], ["o"]).collect()}
    assert got[0] == (0, 0) and len(got) == 2001 - 0


def test_folds_are_even_and_complete(spark):
    df = spark.range(1000).selectExpr("id", "if(id % 3 = 0, 'a', 'b') AS label")
    folds = training_sets.stratified_folds(df, "label", "id")
    sizes = folds.groupBy("label", "fold").count().collect()
    per = {}
    for r in sizes:
        per.setdefault(r.label, []).append(r["count"])
    assert sum(map(sum, per.values())) == 1000
    assert all(max(v) - min(v) <= 1 and len(v) == 5 for v in per.values())


def test_report_of_absent_classes(spark):
    df = spark.createDataFrame(
        [("A", "A"), ("A", "B"), ("Z", "A")], "real string, pred string")
    counts = metrics.confusion(df, "real", "pred")
    got = {r.label: r for r in metrics.class_report(counts, ["A", "B", "C"]).collect()}
    assert got["A"].precision == 0.5 and got["A"].recall == 0.5 and got["A"].support == 2
    assert got["B"].recall == 0.0 and got["C"].support == 0 and got["C"].f1 == 0.0
    seen = metrics.global_report(counts).first()
    assert seen.n == 3 and seen.accuracy == pytest.approx(1 / 3)
