"""Run queries() against oracle_sql() the way the driver does (row count, columns,
order-insensitive value hash). Usable as a script:

    python tests/oracle_check.py [sf_dir] [name ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import hashlib
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (bytes, bytearray)):
        return bytes(v).hex()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    keyed = sorted(repr(tuple(_norm(r[i]) for i in order)) for r in rows)
    h = hashlib.sha256("\n".join(keyed).encode()).hexdigest()
    return [cols[i] for i in order], h, keyed


def duck(sf_dir):
    import duckdb
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def compare(spark, con, name, fn, sql, sf_dir):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    srows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    res = con.execute(sql)
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    scols, sh, sk = _digest(list(sdf.columns), srows)
    dc, dh, dk = _digest(dcols, drows)
    ok = (scols == dc and len(srows) == len(drows) and sh == dh)
    info = dict(name=name, ok=ok, rows=len(srows), oracle_rows=len(drows),
                cols_ok=scols == dc, spark_sec=round(t1 - t0, 2))
    if not ok:
        info["spark_cols"], info["oracle_cols"] = scols, dc
        a, b = set(sk), set(dk)
        info["only_spark"] = sorted(a - b)[:3]
        info["only_oracle"] = sorted(b - a)[:3]
    return info


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 and argv[1].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in argv[1:] if not a.startswith("/")]
    import __spark_entry__ as E
    from mailsift.session import get_spark
    spark = get_spark("oracle-check")
    con = duck(sf_dir)
    qs, sqls = E.queries(), E.oracle_sql()
    bad = 0
    for name in names or list(qs):
        if name not in sqls:
            n = qs[name](spark, sf_dir).count()
            print(f"{name}: rows-only {n}")
            continue
        try:
            info = compare(spark, con, name, qs[name], sqls[name], sf_dir)
        except Exception as e:  # noqa: BLE001
            info = dict(name=name, ok=False, error=f"{type(e).__name__}: {str(e)[:800]}")
        bad += not info["ok"]
        print(info, flush=True)
    print("FAILED" if bad else "ALL OK", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
