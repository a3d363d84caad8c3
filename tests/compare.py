"""Run registered queries against their SQL in DuckDB and report differences."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, bool):
        return value
    return value.item() if hasattr(value, "item") else value


def sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(plain(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda r: tuple((v is None, str(type(v)) if v is None else "", str(v)) for v in r))


def check(spark, con, make, sql, sf_dir):
    """(error text or None, rows, seconds)."""
    start = time.time()
    frame = make(spark, sf_dir)
    got = [tuple(r) for r in frame.collect()]
    seconds = time.time() - start
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    want = result.fetchall()
    if sorted(names) != sorted(frame.columns):
        return f"columns {sorted(frame.columns)} vs {sorted(names)}", len(got), seconds
    a, b = sorted_rows(frame.columns, got), sorted_rows(names, want)
    if len(a) != len(b):
        return f"row count {len(a)} vs {len(b)}", len(got), seconds
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    if bad:
        return f"{len(bad)} rows differ, {sorted(names)}: {str(bad[0])[:700]}", len(got), seconds
    kinds = [
        (n, type(x).__name__, type(y).__name__)
        for r, s in zip(a, b) for n, x, y in zip(sorted(names), r, s)
        if x is not None and y is not None and type(x) is not type(y)
    ]
    return (f"types {sorted(set(kinds))}" if kinds else None), len(got), seconds


if __name__ == "__main__":
    import __spark_entry__ as entry
    from tallyport.session import local_session

    sf_dir = sys.argv[1]
    wanted = sys.argv[2:]
    spark, con = local_session(), duck(sf_dir)
    queries, oracle = entry.queries(), entry.oracle_sql()
    failed = 0
    for name in wanted or queries:
        if name not in oracle:
            print("no sql", name, flush=True)
            continue
        try:
            error, rows, seconds = check(spark, con, queries[name], oracle[name], sf_dir)
        except Exception as exc:  # noqa: BLE001
            error, rows, seconds = f"{type(exc).__name__}: {str(exc)[:900]}", -1, 0
        failed += error is not None
        print(f"{'FAIL' if error else 'ok  '} {name} rows={rows} {seconds:.2f}s {error or ''}", flush=True)
    print("failed", failed, "of", len(wanted or queries), "extra sql:", sorted(set(oracle) - set(queries)))
