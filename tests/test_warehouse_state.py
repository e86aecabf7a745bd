"""Writers of warehouse state: reloads keep every ticket and key, channels don't outlive a run."""

from __future__ import annotations

import datetime

import pytest
from pyspark.sql import functions as F

from ticketry import catalogs as C
from ticketry.operators import warehouse
from ticketry.plans import warehouse_load
from ticketry.sources import sinks
from ticketry.sources.snapshots import Conflict, Snapshots

STAMP = datetime.datetime(2024, 1, 1)


def facts(spark, rows):
    """(id_ticket, ticket_code, asunto) as fact rows."""
    full = [(i, c, 1, 1, 1, None, a, "", STAMP, None, None, None, None) for i, c, a in rows]
    return spark.createDataFrame(full, warehouse.FACT_SCHEMA)


def staged(spark, codes):
    return spark.createDataFrame([(c,) for c in codes], "id_ticket string")


def test_first_load_keeps_rows_without_code_and_rejects_repeated_codes(spark):
    load = facts(spark, [(None, "a", "x"), (None, "a", "y"), (None, None, "z"), (None, None, "z")])
    after = warehouse.reload_facts(facts(spark, []), staged(spark, ["a", "a", None, None]), load)
    rows = after.select("id_ticket", "ticket_code", "asunto").collect()
    assert sorted(r.id_ticket for r in rows) == [C.FIRST_TICKET_ID + i for i in range(3)]
    assert sorted((r.ticket_code or "", r.asunto) for r in rows) == [("", "z"), ("", "z"), ("a", "x")]
    assert [tuple(r) for r in warehouse.repeated_codes(load).collect()] == [("a", ["ticket_code"])]


def test_reload_keeps_known_numbers_and_counts_on(spark):
    existing = facts(spark, [(401, "a", "old"), (402, "b", "old"), (403, None, "old")])
    load = facts(spark, [(None, "b", "new"), (None, "c", "new"), (None, None, "new")])
    after = warehouse.reload_facts(existing, staged(spark, ["b", "c", None]), load)
    rows = {(r.ticket_code, r.asunto): r.id_ticket for r in after.collect()}
    assert rows["a", "old"] == 401 and rows["b", "new"] == 402 and rows[None, "old"] == 403
    assert {rows["c", "new"], rows[None, "new"]} == {404, 405} and len(rows) == 5


def test_an_overwrite_replaces_all_channels(spark, tmp_path):
    tickets = spark.createDataFrame(
        [("1", "EMAIL"), ("2", "PORTAL_INTERNO")], "id_ticket string, canal string"
    )
    path = str(tmp_path / "channels")
    sinks.write_by_channel(tickets, path)
    sinks.write_by_channel(tickets.where("canal = 'EMAIL'"), path)
    found = spark.read.options(sep=";", header=True).csv(path)
    assert [r.canal for r in found.select("canal").distinct().collect()] == ["EMAIL"]


def test_reloading_one_model_version_leaves_the_others(spark, tmp_path):
    path = str(tmp_path / "predictions")
    rows = spark.createDataFrame([(1, "v1.0"), (2, "v1.1")], "id_ticket long, modelo_version string")
    sinks.write_versions(rows, path)
    sinks.write_versions(rows.where("modelo_version = 'v1.1'").withColumn("id_ticket", F.lit(3).cast("long")), path)
    found = spark.read.parquet(path).select("id_ticket", "modelo_version").collect()
    assert sorted(tuple(r) for r in found) == [(1, "v1.0"), (3, "v1.1")]


def staging(spark, rows):
    """(id_ticket, resumen, fecha_creacion) as staged rows."""
    cells = (
        "id_ticket", "canal", "prioridad", "estado", "categoria", "resumen", "descripcion", "fecha_creacion",
        "first_reply_at", "fecha_cierre", "sla_met", "origen", "id_origen",
    )
    full = [(i, "EMAIL", "Alta", "Abierto", "HW", r, "", at, "", "", "", "", "") for i, r, at in rows]
    return spark.createDataFrame(full, ", ".join(f"{c} string" for c in cells))


def seen(spark, root, version=None):
    """(code, subject, number, origin id) of each fact with its lineage, as a reader finds them."""
    tables = warehouse_load.current(Snapshots(spark, root), version)
    assert warehouse_load.orphans(tables).isEmpty()
    rows = tables["f_tickets"].join(tables["map_id_origen"], "id_ticket", "left")
    return sorted((r.ticket_code, r.asunto, r.id_ticket, r.id_origen) for r in rows.collect())


FIRST = [("a", "old", "2024-01-01 10:00:00"), ("b", "old", "2024-01-02 10:00:00")]
SECOND = [("b", "new", "2024-01-02 10:00:00"), ("c", "new", "2024-01-03 10:00:00"), ("d", "undated", "")]


def test_a_load_changes_facts_and_lineage_together(spark, tmp_path):
    root = str(tmp_path / "gold")
    assert seen(spark, root) == []
    assert warehouse_load.load(spark, root, staging(spark, FIRST), "one") == 1
    before = seen(spark, root)
    assert [x[:2] for x in before] == [("a", "old"), ("b", "old")] and all(x[0] == x[3] for x in before)
    assert warehouse_load.load(spark, root, staging(spark, SECOND), "two") == 2
    after = seen(spark, root)
    assert [x[:2] for x in after] == [("a", "old"), ("b", "new"), ("c", "new")]
    assert {x[0]: x[2] for x in after[:2]} == {x[0]: x[2] for x in before} and after[2][2] == 403
    assert all(x[0] == x[3] for x in after) and seen(spark, root, 1) == before
    # The same load again is no load.
    assert warehouse_load.load(spark, root, staging(spark, SECOND), "two") == 2
    rejects = Snapshots(spark, root).read()["rechazos"].collect()
    assert [(r.id_ticket, r.motivos) for r in rejects] == [("d", ["fecha_creacion"])]


def test_a_load_that_stops_between_the_tables_leaves_the_version_before(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "gold")
    warehouse_load.load(spark, root, staging(spark, FIRST))
    before = seen(spark, root)

    def stop(*_):
        raise KeyboardInterrupt  # the facts are written, the lineage is not

    with monkeypatch.context() as patch:
        patch.setattr(warehouse, "reload_lineage", stop)
        with pytest.raises(KeyboardInterrupt):
            warehouse_load.load(spark, root, staging(spark, SECOND))
    with monkeypatch.context() as patch:
        patch.setattr(Snapshots, "_put", stop)  # all tables are written, the manifest is not
        with pytest.raises(KeyboardInterrupt):
            warehouse_load.load(spark, root, staging(spark, SECOND))
    assert Snapshots(spark, root).version() == 1 and seen(spark, root) == before
    assert warehouse_load.load(spark, root, staging(spark, SECOND)) == 2
    assert [x[:2] for x in seen(spark, root)] == [("a", "old"), ("b", "new"), ("c", "new")]


def test_of_two_writers_the_second_is_told(spark, tmp_path):
    snapshots = Snapshots(spark, str(tmp_path))
    row = lambda x: spark.createDataFrame([(x,)], "x string")
    snapshots.publish({"one": row("a"), "two": row("a")}, 0)
    reader = snapshots.read()
    snapshots.publish({"one": row("b")}, 1, "first")
    with pytest.raises(Conflict):
        snapshots.publish({"one": row("c")}, 1, "second")
    assert snapshots.publish({"one": row("d")}, 1, "first") == 2
    assert {n: t.first().x for n, t in snapshots.read().items()} == {"one": "b", "two": "a"}
    assert reader["one"].first().x == "a"  # a reader keeps the version it started with
    assert not [f for f in (tmp_path / "manifests").iterdir() if f.name.startswith(".") and "crc" not in f.name]


def test_expired_versions_go_with_their_tables(spark, tmp_path):
    snapshots = Snapshots(spark, str(tmp_path))
    row = lambda x: spark.createDataFrame([(x,)], "x string")
    snapshots.publish({"one": row("a"), "two": row("a")}, 0)
    for version, x in ((1, "b"), (2, "c")):
        snapshots.publish({"one": row(x)}, version)
    assert snapshots.expire(keep=1) == [1, 2] and snapshots.versions() == [3]
    assert {n: t.first().x for n, t in snapshots.read().items()} == {"one": "c", "two": "a"}
    assert len(list(tmp_path.glob("data/*/one"))) == 1


def tables(folder, orders=40):
    """Orders, line items and customers of a small shop, as files."""
    import duckdb

    base = duckdb.connect()
    for name, rows in {
        "orders": f"SELECT i AS o_orderkey, i % 7 AS o_custkey, 'F' AS o_orderstatus, '2-HIGH' AS o_orderpriority,"
                  f" TIMESTAMP '1996-01-02' + to_days(i::INT) AS o_orderdate FROM range(1, {orders}) t(i)",
        "lineitem": f"SELECT i AS l_orderkey, TIMESTAMP '1996-03-02' + to_days(i::INT) AS l_shipdate FROM range(1, {orders}) t(i)",
        "customer": "SELECT i AS c_custkey, 'BUILDING' AS c_mktsegment FROM range(7) t(i)",
        "documents": "SELECT i AS doc_id, 'web' AS source, repeat('word ', 20) AS text FROM range(100) t(i)",
    }.items():
        base.execute(f"COPY ({rows}) TO '{folder}/{name}.parquet' (FORMAT parquet)")
    return str(folder)


@pytest.mark.parametrize("name", ["reload_lineage", "reload_snapshot", "dq_fk_family", "dq_reconcile", "load_predictions"])
def test_tickets_are_made_once(spark, tmp_path, monkeypatch, name):
    from showcase import queries, standins

    made = []
    raw = standins.tickets_raw
    monkeypatch.setattr(standins, "tickets_raw", lambda *a: made.append(1) or raw(*a))
    found = queries.QUERIES[name](spark, tables(tmp_path))
    assert len(made) == 1
    # What was made is read as a table from there on.
    assert "lineitem" not in found._jdf.queryExecution().optimizedPlan().toString()
    assert found.count() > 0


def test_a_strict_scan_has_parts_by_its_size(spark, tmp_path, monkeypatch):
    from showcase import queries

    assert queries._strict_parts(None) == 8 and queries._strict_parts(100 << 26) == 100
    folder = tables(tmp_path)
    before = sorted(queries.scan_strict(spark, folder).collect())
    monkeypatch.setattr(queries, "STRICT_PART", 500)  # of 10000 bytes
    assert sorted(queries.scan_strict(spark, folder).collect()) == before and len(before) == 100


def test_a_load_is_reduced_once(spark):
    """The first row of each code used to be found twice, for known codes and for new ones."""
    existing = facts(spark, [(5, "b", "old")])
    codes = ["b", "b", "c", None]
    after = warehouse.reload_facts(existing, staged(spark, codes), existing.limit(0).unionByName(
        facts(spark, [(1, "b", "new"), (2, "b", "newer"), (3, "c", "new"), (4, None, "new")])
    ))
    assert "min(" not in after._jdf.queryExecution().optimizedPlan().toString()
    found = sorted((r.id_ticket, r.ticket_code or "") for r in after.collect())
    assert [i for i, _ in found] == [5, 6, 7] and sorted(c for _, c in found) == ["", "b", "c"]
    assert (5, "b") in found
