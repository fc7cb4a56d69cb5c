"""Run registered queries and their SQL side by side.

``python tests/compare.py sf_dir [name ...]`` prints one line per query.
"""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from evgraph.catalog import ORACLES, QUERIES  # noqa: E402
from evgraph.session import build_session  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels"
    " conversations"
).split()


def oracle_connection(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _value(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, (int, float)):
        return f"{float(v):.9g}" if not float(v).is_integer() else str(int(v))
    return str(v)


def row_bag(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_value(row[i]) for i in order) for row in rows)


def compare(spark, con, folder: str, name: str) -> tuple[bool, str]:
    began = time.time()
    df = QUERIES[name](spark, folder)
    rows = df.collect()
    took = time.time() - began
    if name not in ORACLES:
        return len(rows) > 0, f"rows={len(rows)} no SQL {took:.1f}s"
    began = time.time()
    result = con.execute(ORACLES[name])
    columns = [d[0] for d in result.description]
    expected = result.fetchall()
    sql_took = time.time() - began
    if sorted(columns) != sorted(df.columns):
        return False, f"columns {sorted(df.columns)} != {sorted(columns)}"
    got, want = row_bag(df.columns, rows), row_bag(columns, expected)
    if got != want:
        extra, lost = list((got - want).items())[:3], list((want - got).items())[:3]
        n = sum((got - want).values())
        return False, f"rows {len(rows)} vs {len(expected)}, {n} differ\n  cols {sorted(columns)}\n  spark {extra}\n  sql   {lost}"
    return True, f"rows={len(rows)} {took:.1f}s sql {sql_took:.1f}s"


if __name__ == "__main__":
    sf, names = sys.argv[1], sys.argv[2:] or sorted(QUERIES)
    session = build_session("local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"})
    session.sparkContext.setLogLevel("ERROR")
    connection = oracle_connection(sf)
    failed = []
    for item in names:
        try:
            ok, note = compare(session, connection, sf, item)
        except Exception as error:  # show and go on with the next query
            ok, note = False, f"{type(error).__name__}: {str(error)[:1500]}"
        print(("ok   " if ok else "FAIL ") + item, note, flush=True)
        if not ok:
            failed.append(item)
    print(f"{len(names) - len(failed)} of {len(names)} ok; failed: {failed}")
    session.stop()
