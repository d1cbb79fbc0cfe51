"""Compare registered queries with their SQL on DuckDB.

    python tests/oracle.py [sf] [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def oracle_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _cell(v):
    if v is None:
        return (0, "")
    if isinstance(v, bool):
        return (1, str(v))
    if isinstance(v, float):
        return (2, "nan" if math.isnan(v) else repr(v + 0.0))
    return (3, str(v))


def rows_of(names: list[str], rows) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows)


SPARK_TO_DUCK = {
    "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP", "date": "DATE",
}


# What no plan may hold: row-wise Python and joins without a key.
UNWANTED = ("Python", "CartesianProduct", "BroadcastNestedLoopJoin")


def compare(spark, con, name: str, fn, sql: str | None, sf_dir: str) -> str | None:
    """None when equal, else what differs."""
    df = fn(spark, sf_dir)
    ours = df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    unwanted = [word for word in UNWANTED if word in plan]
    if unwanted:
        return f"plan has {unwanted}"
    if sql is None:
        return None if ours else "no rows"
    cur = con.execute(sql)
    names = [c[0] for c in cur.description]
    kinds = {c[0]: str(c[1]) for c in cur.description}
    theirs = cur.fetchall()
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} vs {sorted(names)}"
    wrong = {n: (t, kinds[n]) for n, t in df.dtypes if SPARK_TO_DUCK.get(t, t) != kinds[n]}
    a, b = rows_of(df.columns, ours), rows_of(names, theirs)
    if len(a) != len(b):
        return f"{len(a)} rows vs {len(b)}; types {wrong}"
    if a != b:
        bad = [(x, y) for x, y in zip(a, b) if x != y]
        cols = sorted(names)
        x, y = bad[0]
        diff = {cols[i]: (x[i][1], y[i][1]) for i in range(len(cols)) if x[i] != y[i]}
        return f"{len(bad)} rows differ, first {diff}"
    if wrong:
        return f"types {wrong}"
    if not a:
        return "no rows"
    return None


def main() -> int:
    from __spark_entry__ import oracle_sql, queries
    from signalmill.session import local_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    only = sys.argv[2:]
    sf_dir = f"/root/testdata/sf{sf}"
    spark, con = local_session("oracle"), oracle_connection(sf_dir)
    sqls, failed = oracle_sql(), 0
    for name, fn in queries().items():
        if only and name not in only:
            continue
        start = time.time()
        try:
            problem = compare(spark, con, name, fn, sqls.get(name), sf_dir)
        except Exception as e:  # noqa: BLE001 - report and go on
            problem = f"{type(e).__name__}: {str(e)[:700]}"
        failed += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.time() - start:.1f}s {problem or ''}", flush=True)
    print(f"{failed} failed")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
