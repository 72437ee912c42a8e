"""Run a registered query and its oracle and compare the rows."""

from __future__ import annotations

import datetime as dt
import decimal
import math
import sys
import time
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def plain(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, decimal.Decimal):
        v = int(v) if v == v.to_integral_value() else float(v)
    if isinstance(v, float):
        return None if math.isnan(v) else float(f"{v:.10g}")
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    return v


def kind(v) -> str:
    return "int" if isinstance(v, int) and not isinstance(v, bool) else type(v).__name__


def compare(spark, con, sf_dir: str, fn, sql: str) -> str | None:
    """None when equal, else a short description of the difference."""
    df = fn(spark, sf_dir)
    mine = df.collect()
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    theirs = cur.fetchall()
    if sorted(df.columns) != sorted(names):
        return f"columns: only spark {sorted(set(df.columns) - set(names))}, only oracle {sorted(set(names) - set(df.columns))}"
    order = sorted(names)
    a = Counter(tuple(plain(r[c]) for c in order) for r in mine)
    pos = [names.index(c) for c in order]
    b = Counter(tuple(plain(r[i]) for i in pos) for r in theirs)
    for i, c in enumerate(order):
        ka = {kind(r[i]) for r in a if r[i] is not None}
        kb = {kind(r[i]) for r in b if r[i] is not None}
        if ka and kb and ka != kb:
            return f"type of {c}: spark {ka}, oracle {kb}"
    if a != b:
        only_a, only_b = list((a - b).items())[:2], list((b - a).items())[:2]
        return f"rows {sum(a.values())} vs {sum(b.values())}\n  columns {order}\n  only spark  {str(only_a)[:1500]}\n  only oracle {str(only_b)[:1500]}"
    return None if a else "EMPTY RESULT"


if __name__ == "__main__":
    sys.path.insert(0, __file__.rsplit("/", 2)[0])
    import __spark_entry__ as entry
    from teampulse.session import local_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = set(sys.argv[2:])
    spark, con = local_session(8), connect(sf)
    q, o = entry.queries(), entry.oracle_sql()
    bad = 0
    for key, fn in q.items():
        if only and key not in only:
            continue
        t = time.time()
        try:
            if key in o:
                diff = compare(spark, con, sf, fn, o[key])
            else:
                diff = None if fn(spark, sf).count() else "EMPTY RESULT"
        except Exception as e:  # noqa: BLE001
            diff = f"{type(e).__name__}: {str(e)[:900]}"
        bad += diff is not None
        print(f"{'ok  ' if diff is None else 'FAIL'} {key} {time.time() - t:.1f}s {'' if key in o else '(no oracle)'} {diff or ''}", flush=True)
    print("failed:", bad, "of", len(only) or len(q))
