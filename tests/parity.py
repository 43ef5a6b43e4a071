"""Compare registered queries with their SQL twins on the same parquet files."""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(folder: str):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def plain(value):
    import datetime as dt
    import decimal
    import math

    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    if isinstance(value, decimal.Decimal):
        return repr(float(value))
    if isinstance(value, dict):
        return str(sorted((plain(k), plain(v)) for k, v in value.items()))
    if isinstance(value, (list, tuple)):
        return "[" + ",".join(plain(v) for v in value) + "]"
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    return repr(value)


def rows_of(columns, records):
    at = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in at], sorted(tuple(plain(r[i]) for i in at) for r in records)


def compare(spark, con, folder: str, name: str, fn, sql: str | None):
    """(ok, message) for one query."""
    df = fn(spark, folder)
    got_cols, got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if sql is None:
        return True, f"{len(got)} rows, no SQL twin"
    cur = con.execute(sql)
    want_cols, want = rows_of([d[0] for d in cur.description], cur.fetchall())
    if got_cols != want_cols:
        return False, f"columns {got_cols} != {want_cols}"
    if got == want:
        return True, f"{len(got)} rows equal"
    extra, missing = sorted(set(got) - set(want)), sorted(set(want) - set(got))
    return False, (
        f"rows {len(got)} vs {len(want)}, {len(extra)} only ours, {len(missing)} only SQL\n"
        f"   {got_cols}\n   ours {extra[:3]}\n   sql  {missing[:3]}"
    )


def main(folder: str, names: list[str]):
    import __spark_entry__ as e
    from wakeframe.session import local_session

    spark = local_session(8)
    con = connect(folder)
    queries, sql = e.queries(), e.oracle_sql()
    bad = 0
    for name, fn in queries.items():
        if names and not any(n in name for n in names):
            continue
        start = time.time()
        try:
            ok, message = compare(spark, con, folder, name, fn, sql.get(name))
        except Exception as exc:  # report and go on
            ok, message = False, f"{type(exc).__name__}: {str(exc)[:1500]}"
        bad += not ok
        print(f"{'ok  ' if ok else 'FAIL'} {name} {time.time() - start:.1f}s {message}", flush=True)
    print(f"{bad} failed", flush=True)


if __name__ == "__main__":
    main(f"/root/testdata/sf{sys.argv[1]}", sys.argv[2:])
