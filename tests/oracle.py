"""Run queries beside their SQL: ``python tests/oracle.py [sf_dir] [name ...]``."""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def cell(v):
    if v is None:
        return "∅"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v:.9g}"
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return str(v)


def compare(spark, con, fn, sql, sf_dir):
    """``(rows, message)``; the message is empty when both sides agree."""
    df = fn(spark, sf_dir)
    got = [tuple(r) for r in df.collect()]
    if sql is None:
        return len(got), "" if got else "no rows"
    rel = con.execute(sql)
    names = [d[0] for d in rel.description]
    want = rel.fetchall()
    if sorted(names) != sorted(df.columns):
        return len(got), f"columns {sorted(df.columns)} != {sorted(names)}"
    order = sorted(names)
    a = sorted(tuple(cell(r[df.columns.index(n)]) for n in order) for r in got)
    b = sorted(tuple(cell(r[names.index(n)]) for n in order) for r in want)
    if a == b:
        return len(got), ""
    sa, sb = set(a), set(b)
    return len(got), f"{len(a)} rows vs {len(b)}; spark only {sorted(sa - sb)[:2]}; sql only {sorted(sb - sa)[:2]}"


def main(argv):
    import duckdb

    import __spark_entry__ as entry
    from ledgerfold.session import build_session

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    spark = build_session("oracle", "local[8]", **{
        "spark.ui.enabled": "false", "spark.sql.shuffle.partitions": 8, "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    sqls, bad = entry.oracle_sql(), 0
    for name, fn in entry.queries().items():
        if argv[1:] and name not in argv[1:]:
            continue
        start = time.time()
        try:
            rows, message = compare(spark, con, fn, sqls.get(name), sf_dir)
        except Exception as exc:  # a broken query must not hide the others
            rows, message = -1, f"{type(exc).__name__}: {str(exc)[:600]}"
        bad += bool(message)
        flag = "FAIL" if message else ("ok  " if name in sqls else "rows")
        print(f"{flag} {name:28s} {rows:7d} rows {time.time() - start:6.2f}s {message}", flush=True)
    print("failures:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(bool(main(sys.argv[1:])))
