"""Compare a registered query with its SQL on DuckDB: columns, row count and an order-free value hash."""

from __future__ import annotations

import hashlib
import os
import sys
import time
from datetime import date, datetime
from decimal import Decimal

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from read_parquet('{folder}/{name}.parquet')")
    return con


def cell(value) -> str:
    if value is None:
        return "\\N"
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, (float, Decimal)):
        return repr(round(float(value), 6))
    if isinstance(value, (datetime, date)):
        return value.isoformat()
    if isinstance(value, (list, tuple)):
        return "[" + ",".join(cell(v) for v in value) + "]"
    return str(value)


def digest(columns: list[str], rows) -> tuple[int, str, list[str]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    texts = sorted("\x1f".join(cell(r[i]) for i in order) for r in rows)
    return len(texts), hashlib.sha256("\x1e".join(texts).encode()).hexdigest(), texts


KINDS = {"BIGINT": "bigint", "INTEGER": "int", "VARCHAR": "string", "BOOLEAN": "boolean", "DOUBLE": "double",
         "TIMESTAMP": "timestamp", "DATE": "date"}


def check(spark, con, folder: str, name: str, query, sql: str | None) -> dict:
    begin = time.time()
    df = query(spark, folder)
    rows = [tuple(r) for r in df.collect()]
    took = round(time.time() - begin, 2)
    if sql is None:
        return {"name": name, "rows": len(rows), "sec": took, "ok": len(rows) > 0, "why": "" if rows else "empty", "oracle": False}
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    kinds = {d[0]: KINDS.get(str(d[1]).upper(), str(d[1])) for d in cursor.description}
    want = digest(names, cursor.fetchall())
    got = digest(df.columns, rows)
    why = ""
    if sorted(names) != sorted(df.columns):
        why = f"columns {sorted(df.columns)} != {sorted(names)}"
    elif got[0] != want[0]:
        why = f"rows {got[0]} != {want[0]}"
    elif got[1] != want[1]:
        why = "values"
    if why and not why.startswith("columns"):
        a, b = set(got[2]), set(want[2])
        why += f"\n   only spark: {[x[:300] for x in sorted(a - b)[:2]]}\n   only duck:  {[x[:300] for x in sorted(b - a)[:2]]}"
    types = dict(df.dtypes)
    odd = {c: (types[c], kinds[c]) for c in types if c in kinds and types[c] != kinds[c]}
    return {"name": name, "rows": got[0], "sec": took, "ok": not why, "why": why, "types": odd, "oracle": True}


if __name__ == "__main__":
    sys.path.insert(0, os.path.join(os.path.dirname(__file__), ".."))
    import __spark_entry__ as entry
    from pagemill.session import local_session

    size = os.environ.get("SF", "0.01")
    folder = f"/root/testdata/sf{size}"
    wanted = sys.argv[1:]
    spark = local_session("compare")
    con = connect(folder)
    oracle = entry.oracle_sql()
    bad = 0
    for name, query in entry.queries().items():
        if wanted and not any(w in name for w in wanted):
            continue
        try:
            result = check(spark, con, folder, name, query, oracle.get(name))
        except Exception as error:  # noqa: BLE001 - report and go on
            result = {"name": name, "rows": -1, "sec": 0, "ok": False, "why": f"{type(error).__name__}: {str(error)[:900]}"}
        bad += not result["ok"]
        print(("ok  " if result["ok"] else "BAD ") + f"{name:28s} rows={result['rows']:<8} {result['sec']}s "
              + (f"types={result['types']} " if result.get("types") else "") + result["why"], flush=True)
    print("bad:", bad)
