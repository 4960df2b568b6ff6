"""Run queries next to their SQL twins: python -m showcase.verify [sf] [name ...]"""
from __future__ import annotations

import datetime as dt
import decimal
import math
import sys
import time

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def _norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, decimal.Decimal):
        return ("dec", str(v))
    if isinstance(v, float):
        return float(f"{v:.9g}")
    if isinstance(v, (dt.datetime, dt.date)):
        return str(v)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    return v


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return [names[i] for i in order], sorted(out, key=lambda r: tuple((x is None, str(type(x)), str(x)) for x in r))


def connect(folder: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{folder}/{t}.parquet'")
    return con


def compare(spark, con, folder, fn, sql):
    """None if both sides agree, else a short description."""
    df = fn(spark, folder)
    got = _rows(df.columns, [tuple(r) for r in df.collect()])
    if sql is None:
        return None if got[1] else "no rows", len(got[1])
    cur = con.execute(sql)
    want = _rows([d[0] for d in cur.description], cur.fetchall())
    if got[0] != want[0]:
        return f"columns {got[0]} vs {want[0]}", len(got[1])
    if len(got[1]) != len(want[1]):
        return f"rows {len(got[1])} vs {len(want[1])}: {got[1][:2]} vs {want[1][:2]}", len(got[1])
    bad = [(a, b) for a, b in zip(got[1], want[1]) if a != b or any(type(x) is not type(y) for x, y in zip(a, b))]
    if bad:
        return f"{len(bad)} rows differ, first {bad[0][0]} vs {bad[0][1]}", len(got[1])
    return (None if got[1] else "no rows"), len(got[1])


def main(argv):
    from ledgerloom.session import build
    from . import REGISTRY
    sf = argv[0] if argv else "0.01"
    folder = f"/root/testdata/sf{sf}"
    spark = build("verify", "local[8]", **{"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "8",
                                           "spark.driver.memory": "8g",
                                           "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    wanted = argv[1:]
    failed = 0
    for name, (fn, sql) in REGISTRY.items():
        if wanted and not any(name == w or (w.endswith("*") and name.startswith(w[:-1])) for w in wanted):
            continue
        t = time.time()
        try:
            problem, n = compare(spark, con, folder, fn, sql)
        except Exception as e:  # report and go on with the next query
            problem, n = f"{type(e).__name__}: {str(e)[:600]}", -1
        failed += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} rows={n} {time.time() - t:.1f}s"
              f"{'' if sql else ' (no sql)'} {problem or ''}", flush=True)
    print("failed:", failed)
    return failed


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
