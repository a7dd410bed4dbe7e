"""Run a registered query next to its SQL and compare the rows.

    python tests/compare.py [sf directory] [query ...]
"""

from __future__ import annotations

import math
import sys
import tempfile
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def oracle_rows(sf_dir: str, sql: str) -> tuple[list[str], list[tuple]]:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    cur = con.execute(sql)
    return [d[0] for d in cur.description], cur.fetchall()


def plain(value):
    if isinstance(value, bool) or value is None or isinstance(value, str):
        return value
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9)
    if hasattr(value, "as_tuple"):
        return round(float(value), 9)
    return value


def ordered(names: list[str], rows: list[tuple]) -> list[tuple]:
    at = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(plain(r[i]) for i in at) for r in rows), key=repr)


def compare(spark, sf_dir: str, name: str) -> str:
    from __spark_entry__ import oracle_sql, queries

    start = time.time()
    df = queries()[name](spark, sf_dir)
    got = [tuple(r) for r in df.collect()]
    took = time.time() - start
    sql = oracle_sql().get(name)
    if sql is None:
        return f"rows {len(got)} {took:.1f}s {df.dtypes}"
    names, want = oracle_rows(sf_dir, sql)
    if sorted(names) != sorted(df.columns):
        return f"FAIL columns {sorted(df.columns)} vs {sorted(names)}"
    a, b = ordered(df.columns, got), ordered(names, want)
    types = {type(v).__name__ for r in got[:50] for v in r} ^ {type(v).__name__ for r in want[:50] for v in r}
    note = f" types differ: {types}" if types else ""
    if a != b:
        only = [(x, y) for x, y in zip(a, b) if x != y][:3]
        return f"FAIL {len(a)} vs {len(b)} rows {took:.1f}s{note}\n   " + "\n   ".join(str(p)[:600] for p in only)
    return f"ok {len(a)} rows {took:.1f}s{note}"


def main() -> None:
    from lectern.session import build_session
    from __spark_entry__ import queries

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session(
        "compare", "local[8]", tempfile.mkdtemp(prefix="run-", dir="/tmp"), spark__sql__shuffle__partitions="8", spark__ui__enabled="false",
        spark__driver__memory="8g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    wanted = sys.argv[2:]
    names = [n for n in queries() if not wanted or any(n.startswith(w) for w in wanted)]
    for name in names:
        try:
            print(name, compare(spark, sf_dir, name), flush=True)
        except Exception as err:  # report and go on with the next query
            print(name, "ERROR", type(err).__name__, str(err)[:1500], flush=True)


if __name__ == "__main__":
    main()
