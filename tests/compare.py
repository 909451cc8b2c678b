"""Runs registered queries beside their check SQL and compares rows without regard to order."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return connection


def _cell(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "null"
    if hasattr(value, "isoformat"):
        return value.isoformat().removesuffix("T00:00:00")
    return repr(value)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def compare(spark, connection, sf_dir: str, run, sql: str | None) -> tuple[bool, str]:
    frame = run(spark, sf_dir)
    got_columns, got = _rows(frame.columns, [tuple(r) for r in frame.collect()])
    if sql is None:
        return len(got) > 0, f"{len(got)} rows, no check SQL"
    cursor = connection.execute(sql)
    names = [d[0] for d in cursor.description]
    want_columns, want = _rows(names, cursor.fetchall())
    if got_columns != want_columns:
        return False, f"columns {got_columns} / {want_columns}"
    if got != want:
        only_got, only_want = sorted(set(got) - set(want)), sorted(set(want) - set(got))
        return False, f"{len(got)} / {len(want)} rows; {len(only_got)} differ, e.g. {only_got[:2]} / {only_want[:2]}"
    return True, f"{len(got)} rows"


if __name__ == "__main__":
    from __spark_entry__ import oracle_sql, queries
    from tidewell.session import build_session

    sf = next((a.split("=")[1] for a in sys.argv if a.startswith("sf=")), "0.01")
    chosen = [a for a in sys.argv[1:] if "=" not in a]
    directory = f"/root/testdata/sf{sf}"
    session = build_session(master="local[8]")
    session.sparkContext.setLogLevel("ERROR")
    db, checks, failed = connect(directory), oracle_sql(), 0
    for name, function in queries().items():
        if chosen and name not in chosen:
            continue
        start = time.time()
        try:
            good, note = compare(session, db, directory, function, checks.get(name))
        except Exception as error:  # noqa: BLE001
            good, note = False, f"{type(error).__name__}: {str(error)[:600]}"
        failed += not good
        print(f"{'ok  ' if good else 'FAIL'} {name:22s} {time.time() - start:6.2f}s  {note}", flush=True)
    print(f"{failed} failed")
