"""Runs a query in Spark and its SQL in DuckDB and compares the rows, whatever their order."""

from __future__ import annotations

import datetime
import math
import sys
import time

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return repr(value + 0.0) if value else "0.0"
    if isinstance(value, datetime.datetime):
        return value.isoformat(sep=" ")
    return str(value)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_plain(r[i]) for i in order) for r in rows)


def _kind(name: str) -> str:
    name = str(name).lower()
    known = {"integer": "int", "varchar": "string", "timestamp_ntz": "timestamp"}
    return known.get(name, name)


def differences(df, con, sql: str) -> list[str]:
    """What differs: column names, types, row count, or the first few rows."""
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    kinds = {d[0]: _kind(d[1]) for d in cur.description}
    expected = cur.fetchall()
    found = df.collect()
    out = []
    if sorted(df.columns) != sorted(names):
        return [f"columns {sorted(df.columns)} != {sorted(names)}"]
    for n, k in df.dtypes:
        if _kind(k) != kinds[n]:
            out.append(f"type of {n}: spark {k}, duckdb {kinds[n]}")
    a, b = _rows(df.columns, found), _rows(names, expected)
    if len(a) != len(b):
        out.append(f"rows {len(a)} != {len(b)}")
    if a != b:
        only_a, only_b = sorted(set(a) - set(b))[:3], sorted(set(b) - set(a))[:3]
        out.append(f"values over {sorted(df.columns)}:\n  spark  {only_a}\n  duckdb {only_b}")
    return out


def main() -> None:
    """``python -m tests.oracle [sf] [name prefix ...]``"""
    import __spark_entry__ as entry
    from tests.conftest import make_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    prefixes = tuple(sys.argv[2:]) or ("",)
    sf_dir = f"/root/testdata/sf{sf}"
    spark, con = make_session(), connect(sf_dir)
    oracle = entry.oracle_sql()
    bad = 0
    for name, build in entry.queries().items():
        if not name.startswith(prefixes):
            continue
        t0 = time.time()
        try:
            df = build(spark, sf_dir)
            if name in oracle:
                diff = differences(df, con, oracle[name])
                n = ""
            else:
                n, diff = f"rows={df.count()}, no SQL", []
        except Exception as error:  # report and go on with the next query
            diff, n = [f"{type(error).__name__}: {str(error)[:1500]}"], ""
        bad += bool(diff)
        print(f"{'DIFF' if diff else 'ok  '} {name} {time.time() - t0:.1f}s {n}", flush=True)
        for d in diff:
            print("   ", d, flush=True)
    print("differing:", bad)


if __name__ == "__main__":
    main()
