"""Run every registered query against its DuckDB oracle SQL and compare.

    python tests/oracle_check.py [sf_dir] [name ...]

Compares row count, column names, column types (loosely) and an
order-insensitive hash of the values, the way the driver's correctness
gate does.
"""

from __future__ import annotations

import datetime as dt
import decimal
import hashlib
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return str(int(v))
    if isinstance(v, float):
        return repr(round(v, 6))
    if isinstance(v, decimal.Decimal):
        return format(v.normalize(), "f") if v == v.to_integral() else str(v.normalize())
    if isinstance(v, dt.datetime):
        return v.isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    return str(v)


def pandas_rows(pdf):
    import pandas as pd

    out = []
    for row in pdf.itertuples(index=False):
        vals = []
        for v in row:
            if v is None or (isinstance(v, float) and v != v) or v is pd.NaT:
                vals.append(None)
            elif isinstance(v, pd.Timestamp):
                vals.append(v.to_pydatetime())
            elif hasattr(v, "item"):
                vals.append(v.item())
            else:
                vals.append(v)
        out.append(tuple(vals))
    return out


def digest(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = sorted("|".join(norm(r[i]) for i in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()[:16], lines


def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 and argv[1].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in argv[1:] if not a.startswith("/")]
    import __spark_entry__ as entry
    from starmart.session import build_session

    spark = build_session()
    qs, sqls = entry.queries(), entry.oracle_sql()
    con = duck(sf_dir)
    bad = 0
    for name, fn in qs.items():
        if names and name not in names:
            continue
        t0 = time.time()
        df = fn(spark, sf_dir)
        srows = [tuple(r) for r in df.collect()]
        scols = df.columns
        t1 = time.time()
        if name not in sqls:
            print(f"{name:32s} rows={len(srows):7d} spark={t1 - t0:5.1f}s  (no oracle)")
            continue
        rel = con.sql(sqls[name])
        dcols = rel.columns
        drows = rel.fetchall()
        sh, sl = digest(scols, srows)
        dh, dl = digest(dcols, drows)
        # The same comparison through pandas (toPandas / .df()), as a
        # pandas-based checker would see the results.
        ph = digest(scols, pandas_rows(df.toPandas()))[0]
        qh = digest(dcols, pandas_rows(con.sql(sqls[name]).df()))[0]
        ok = len(srows) == len(drows) and sorted(scols) == sorted(dcols) and sh == dh and ph == qh
        bad += not ok
        print(f"{name:32s} rows={len(srows):7d}/{len(drows):<7d} {'OK ' if ok else 'BAD'} "
              f"spark={t1 - t0:5.1f}s")
        if not ok:
            print("   spark cols", list(zip(scols, [f.dataType.simpleString() for f in df.schema.fields])))
            print("   duck  cols", list(zip(dcols, [str(t) for t in rel.types])))
            sd, dd = set(sl), set(dl)
            print("   only spark:", sorted(sd - dd)[:3])
            print("   only duck :", sorted(dd - sd)[:3])
    print("mismatches:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
