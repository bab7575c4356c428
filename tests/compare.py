"""Runs registered queries beside their SQL in DuckDB and reports differences."""

from __future__ import annotations

import glob
import math
import os
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def _plain(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return v + 0.0
    if hasattr(v, "item"):
        return v.item()
    return v


def _key(row):
    return [(v is None, type(v).__name__, v if v is not None else 0) for v in row]


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_plain(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(out, key=lambda r: [(v is None, str(v)) for v in r])


def check(spark, con, registry, name: str, folder: str):
    """None when equal, else a message; with the seconds of both sides."""
    t0 = time.time()
    df = registry.queries[name](spark, folder)
    rows = [tuple(r) for r in df.collect()]
    t1 = time.time()
    if name not in registry.sql:
        return (None if rows else "no rows"), len(rows), t1 - t0, 0.0
    rel = con.sql(registry.sql[name])
    expected = rel.fetchall()
    t2 = time.time()
    sc, sr = _rows(df.columns, rows)
    dc, dr = _rows(list(rel.columns), expected)
    message = None
    if sc != dc:
        message = f"columns {sc} vs {dc}"
    elif len(sr) != len(dr):
        message = f"{len(sr)} rows vs {len(dr)}"
    elif not sr:
        message = "no rows"
    else:
        bad = [(a, b) for a, b in zip(sr, dr) if a != b or [type(x) for x in a] != [type(x) for x in b]]
        if bad:
            message = f"{len(bad)} rows differ; columns {sc}\n   spark {bad[0][0]}\n   sql   {bad[0][1]}"
    return message, len(sr), t1 - t0, t2 - t1


if __name__ == "__main__":
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    from hydrosignal.catalog import load
    from hydrosignal.session import build_session

    folder = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    spark = build_session("local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    reg, con = load(), connect(folder)
    wanted = [n for n in reg.queries if not sys.argv[1:] or any(n.startswith(a) for a in sys.argv[1:])]
    failed = 0
    for n in wanted:
        try:
            message, count, a, b = check(spark, con, reg, n, folder)
        except Exception as e:  # noqa: BLE001
            message, count, a, b = f"{type(e).__name__}: {str(e)[:1500]}", 0, 0, 0
        failed += message is not None
        print(f"{'ok  ' if message is None else 'FAIL'} {n} rows={count} spark={a:.1f}s sql={b:.1f}s {'' if n in reg.sql else '(rows only)'} {message or ''}", flush=True)
    print(f"{len(wanted) - failed}/{len(wanted)} ok")
