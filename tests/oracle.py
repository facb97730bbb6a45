"""Run registered queries and their SQL side by side and report differences."""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET threads = 8")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    return con


def norm(value):
    if value is None:
        return None
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return f"{value + 0.0:.6f}" if value else "0.000000"
    if isinstance(value, int):
        return f"{float(value):.6f}"
    if hasattr(value, "is_integer") or type(value).__name__ == "Decimal":
        return f"{float(value):.6f}"
    return str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(norm(r[i]) for i in order) for r in rows), key=lambda t: tuple((v is None, v or "") for v in t))


def compare(spark, con, name, build, sql, folder):
    t0 = time.time()
    df = build(spark, folder)
    got = df.collect()
    t1 = time.time()
    if sql is None:
        return ("rows-only", len(got), None, t1 - t0, 0.0, "")
    cur = con.execute(sql)
    columns = [c[0] for c in cur.description]
    want = cur.fetchall()
    t2 = time.time()
    if sorted(columns) != sorted(df.columns):
        return ("COLUMNS", len(got), len(want), t1 - t0, t2 - t1, f"{sorted(df.columns)} vs {sorted(columns)}")
    a, b = rows_of(df.columns, got), rows_of(columns, want)
    if a == b:
        return ("ok", len(a), len(b), t1 - t0, t2 - t1, "")
    sa, sb = set(a), set(b)
    detail = f"only spark {len(sa - sb)}: {sorted(sa - sb, key=str)[:3]} only sql {len(sb - sa)}: {sorted(sb - sa, key=str)[:3]}"
    return ("DIFF", len(a), len(b), t1 - t0, t2 - t1, detail)


def main():
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as entry
    from kinfold.session import local_session

    folder = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    wanted = sys.argv[1:]
    spark = local_session("oracle")
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(folder)
    sqls, bad = entry.oracle_sql(), 0
    for name, build in entry.queries().items():
        if wanted and not any(w in name for w in wanted):
            continue
        try:
            status, n, m, ts, td, detail = compare(spark, con, name, build, sqls.get(name), folder)
        except Exception as e:  # noqa: BLE001
            status, n, m, ts, td, detail = "ERROR", 0, 0, 0.0, 0.0, f"{type(e).__name__}: {str(e)[:1500]}"
        bad += status not in ("ok", "rows-only")
        print(f"{status:9s} {name:28s} rows={n}/{m} spark={ts:.2f}s sql={td:.2f}s {detail}", flush=True)
    print("bad:", bad)


if __name__ == "__main__":
    main()
