"""Compare registered Spark queries with their SQL oracle (DuckDB).

Usage: python tests/oracle_check.py [sf_dir] [name ...]
Mirrors the driver's check: row count, column names, and an
order-insensitive hash of the values (columns sorted by name).
"""

from __future__ import annotations

import datetime as dt
import decimal
import hashlib
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        return f"{v:.4f}"
    if isinstance(v, decimal.Decimal):
        return f"{float(v):.4f}"
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()[:10] if isinstance(v, dt.date) and not isinstance(v, dt.datetime) else v.isoformat()
    if isinstance(v, bool):
        return str(v)
    return str(v)


def digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join(norm(r[i]) for i in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest(), lines


SPARK_TO_DUCK = {"int": "INTEGER", "bigint": "BIGINT", "smallint": "SMALLINT", "double": "DOUBLE",
                 "string": "VARCHAR", "date": "DATE", "boolean": "BOOLEAN", "float": "FLOAT",
                 "timestamp": "TIMESTAMP WITH TIME ZONE", "timestamp_ntz": "TIMESTAMP", "tinyint": "TINYINT"}


def type_mismatches(df, description):
    spark_t = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    out = []
    for d in description:
        name, dtype = d[0], str(d[1])
        st = spark_t.get(name)
        if st is None:
            continue
        want = SPARK_TO_DUCK.get(st, st.upper().replace(" ", ""))
        if want.replace(" ", "") != dtype.replace(" ", ""):
            out.append(f"{name}: spark {st} / duckdb {dtype}")
    return out


def duck(sf_dir):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    import __spark_entry__ as E
    from tallyhouse.session import get_spark
    spark = get_spark("local[8]", 8)
    qs, oracle = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    bad = 0
    for name in names or list(qs):
        t = time.time()
        df = qs[name](spark, sf_dir)
        srows = [tuple(r) for r in df.collect()]
        scols = df.columns
        ts = time.time() - t
        if name not in oracle:
            print(f"{name:32s} rows={len(srows):7d} (no oracle) {ts:5.1f}s")
            continue
        t = time.time()
        cur = con.execute(oracle[name])
        ocols = [d[0] for d in cur.description]
        orows = cur.fetchall()
        to = time.time() - t
        hs, ls = digest(scols, srows)
        ho, lo = digest(ocols, orows)
        ok = hs == ho and sorted(scols) == sorted(ocols) and len(srows) == len(orows)
        bad += not ok
        tm = type_mismatches(df, cur.description)
        print(f"{name:32s} spark={len(srows):7d} oracle={len(orows):7d} {'OK ' if ok else 'BAD'} "
              f"{ts:5.1f}s/{to:4.1f}s" + (f"  types: {tm}" if tm else ""))
        if not ok:
            if sorted(scols) != sorted(ocols):
                print("   cols spark:", sorted(scols), "\n   cols oracle:", sorted(ocols))
            so, oo = set(ls), set(lo)
            print("   only spark:", sorted(so - oo)[:3])
            print("   only oracle:", sorted(oo - so)[:3])
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
