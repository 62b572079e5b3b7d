"""Run registered queries beside their SQL: python -m tests.parity [sf_dir] [name ...]"""

from __future__ import annotations

import math
import sys
import time

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()
KINDS = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
         "date": "DATE"}


def oracle(sf_dir: str):
    con = duckdb.connect()
    con.execute("set timezone='UTC'")
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


def _key(v):
    return (v is None, str(type(v)), v if v is not None else 0)


def _clean(v):
    if isinstance(v, float):
        return 0.0 if v == 0 else ("nan" if math.isnan(v) else v)
    return v


def rows_of(columns, rows):
    at = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_clean(r[i]) for i in at) for r in rows), key=lambda r: tuple(_key(v) for v in r))


def compare(spark, con, name, fn, sql, sf_dir) -> tuple[str, float, float]:
    """('' or what differs, Spark seconds, SQL seconds)."""
    t0 = time.time()
    df = fn(spark, sf_dir)
    got = df.collect()
    took = time.time() - t0
    if sql is None:
        return ("" if got else "no rows"), took, 0.0
    t0 = time.time()
    cur = con.execute(sql)
    cols = [c[0] for c in cur.description]
    kinds = {c[0]: str(c[1]) for c in cur.description}
    want = cur.fetchall()
    sql_took = time.time() - t0
    problems = []
    if sorted(df.columns) != sorted(cols):
        return f"columns {sorted(df.columns)} vs {sorted(cols)}", took, sql_took
    for f in df.schema.fields:
        if KINDS.get(f.dataType.simpleString()) != kinds[f.name]:
            problems.append(f"type {f.name}: {f.dataType.simpleString()} vs {kinds[f.name]}")
    if len(got) != len(want):
        problems.append(f"rows {len(got)} vs {len(want)}")
    a, b = rows_of(df.columns, got), rows_of(cols, want)
    if a != b:
        diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
        problems.append(f"values differ ({sum(x != y for x, y in zip(a, b))}): {sorted(cols)} {str(diff)[:900]}")
    if not got:
        problems.append("empty result")
    return "; ".join(problems), took, sql_took


def main(argv):
    from millrace.session import local_session
    import __spark_entry__ as entry

    sf = argv[0] if argv and argv[0].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in argv if not a.startswith("/")]
    spark, con = local_session(), oracle(sf)
    checks = entry.oracle_sql()
    bad = 0
    for name, fn in entry.queries().items():
        if names and not any(name == n or (n.endswith("*") and name.startswith(n[:-1])) for n in names):
            continue
        try:
            problem, took, sql_took = compare(spark, con, name, fn, checks.get(name), sf)
        except Exception as error:  # noqa: BLE001
            problem, took, sql_took = f"{type(error).__name__}: {str(error)[:900]}", 0.0, 0.0
        bad += bool(problem)
        mark = "FAIL" if problem else ("ok  " if name in checks else "rows")
        print(f"{mark} {name:28s} {took:6.2f}s {sql_took:6.2f}s {problem}", flush=True)
    print("failures:", bad)


if __name__ == "__main__":
    main(sys.argv[1:])
