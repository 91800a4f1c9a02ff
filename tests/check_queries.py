"""Runs registered queries and compares them with their SQL in DuckDB."""

from __future__ import annotations

import math
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def normal(value):
    if value is None:
        return None
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    if hasattr(value, "to_pydatetime"):
        value = value.to_pydatetime()
    if isinstance(value, (int, bool, str)):
        return str(value)
    return str(value)


def compare(spark, con, name, fn, sql, sf_dir):
    """(message or empty text, rows, Spark seconds)."""
    start = time.time()
    df = fn(spark, sf_dir)
    rows = df.collect()
    took = time.time() - start
    if sql is None:
        return "", len(rows), took
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    expected = cur.fetchall()
    if sorted(names) != sorted(df.columns):
        return f"columns differ: {sorted(df.columns)} / {sorted(names)}", len(rows), took
    kinds = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "timestamp_ntz": "TIMESTAMP", "date": "DATE", "boolean": "BOOLEAN"}
    types = {d[0]: str(d[1]) for d in cur.description}
    for f in df.schema.fields:
        if kinds[f.dataType.simpleString()] != types[f.name]:
            return f"type of {f.name}: {f.dataType.simpleString()} / {types[f.name]}", len(rows), took
    order = sorted(names)
    key = lambda r: tuple("\0" if v is None else v for v in r)
    left = sorted((tuple(normal(r[c]) for c in order) for r in rows), key=key)
    right = sorted((tuple(normal(r[names.index(c)]) for c in order) for r in expected), key=key)
    if len(left) != len(right):
        return f"rows differ: {len(left)} / {len(right)}", len(rows), took
    bad = [(a, b) for a, b in zip(left, right) if a != b]
    if bad:
        a, b = bad[0]
        diff = {c: (x, y) for c, x, y in zip(order, a, b) if x != y}
        return f"{len(bad)} of {len(left)} rows differ, first: {diff} row {dict(zip(order, a))}"[:900], len(rows), took
    return "", len(rows), took


def main() -> int:
    from zonecast.plans.catalog import oracle_sql, queries
    from zonecast.session import build_session

    sf_dir = sys.argv[1]
    wanted = sys.argv[2:]
    spark = build_session("check", "local[8]", **{"spark.checkpoint.dir": tempfile.mkdtemp(prefix="zonecast-check-"), "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    oracle = oracle_sql()
    failed = 0
    for name, fn in queries().items():
        if wanted and not any(w in name for w in wanted):
            continue
        try:
            message, rows, took = compare(spark, con, name, fn, oracle.get(name), sf_dir)
        except Exception as e:  # noqa: BLE001
            message, rows, took = f"{type(e).__name__}: {str(e)[:2500]}", -1, 0.0
        failed += bool(message)
        kind = "sql" if name in oracle else "rows"
        print(f"{'FAIL' if message else 'ok  '} {name:36s} {kind} rows={rows:<7d} {took:6.2f}s {message}", flush=True)
    print("failed:", failed)
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
