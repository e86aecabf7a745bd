"""Run registered queries next to their SQL twins and compare whole results.

    python -m tests.compare [sf] [name ...]
"""

from __future__ import annotations

import datetime
import decimal
import sys
import time

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(sf_dir: str):
    import duckdb

    connection = duckdb.connect()
    for t in TABLES:
        connection.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return connection


def _cell(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        return 0.0 if value == 0 else value
    if isinstance(value, (datetime.datetime, datetime.date)):
        return value.isoformat()
    return value


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_cell(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, connection, function, sql, sf_dir):
    """(rows, seconds, problem or None)."""
    start = time.time()
    df = function(spark, sf_dir)
    ours = [tuple(r) for r in df.collect()]
    seconds = time.time() - start
    if sql is None:
        return len(ours), seconds, None
    cursor = connection.execute(sql)
    names = [d[0] for d in cursor.description]
    theirs = cursor.fetchall()
    if sorted(names) != sorted(df.columns):
        return len(ours), seconds, f"columns {sorted(df.columns)} against {sorted(names)}"
    a, b = canonical(df.columns, ours), canonical(names, theirs)
    if a != b:
        from collections import Counter

        left, right = Counter(a), Counter(b)
        only_a, only_b = list((left - right).keys())[:2], list((right - left).keys())[:2]
        return len(ours), seconds, f"{len(a)} against {len(b)} rows; ours {only_a}; sql {only_b}"
    return len(ours), seconds, None


if __name__ == "__main__":
    sys.path.insert(0, ".")
    import __spark_entry__ as entry
    from ticketry.session import local_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "sf0.001"
    chosen = sys.argv[2:]
    folder = f"/root/testdata/{sf}"
    session, base = local_session(8), duck(folder)
    twins, bad = entry.oracle_sql(), 0
    for name, function in entry.queries().items():
        if chosen and name not in chosen:
            continue
        try:
            rows, seconds, problem = compare(session, base, function, twins.get(name), folder)
        except Exception as e:  # noqa: BLE001
            rows, seconds, problem = -1, 0.0, f"{type(e).__name__}: {str(e)[:600]}"
        bad += problem is not None
        mark = "FAIL" if problem else ("ok" if name in twins else "rows")
        print(f"{mark:5} {name:28} {rows:8} {seconds:7.2f}s {problem or ''}", flush=True)
    print("failed:", bad)
