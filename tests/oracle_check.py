"""Compare every registered query with its DuckDB oracle, the way the driver
does: row count, column names, and an order-insensitive hash of the values.

    python tests/oracle_check.py [sf_dir] [name ...]
"""

from __future__ import annotations

import datetime as dt
import hashlib
import math
import sys
import time
from decimal import Decimal
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import duckdb  # noqa: E402

TYPES = {
    "string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "date": "DATE",
    "boolean": "BOOLEAN", "timestamp": "TIMESTAMP", "timestamp_ntz": "TIMESTAMP",
}
TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return repr(v)
    if isinstance(v, Decimal):
        return repr(float(v))
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, (list, tuple)):
        return str([norm(x) for x in v])
    return str(v)


def digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join(str(norm(r[i])) for i in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()[:16], lines


def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    con.execute("SET TimeZone='UTC'")
    return con


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 and argv[1].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in argv[1:] if not a.startswith("/")]
    import __spark_entry__ as entry
    from harvestline import get_session

    spark = get_session("local[8]", 8)
    qs, sqls = entry.queries(), entry.oracle_sql()
    con = duck(sf_dir)
    bad = 0
    for name in names or sorted(qs):
        t = time.time()
        try:
            sdf = qs[name](spark, sf_dir)
            scols = sdf.columns
            srows = [tuple(r) for r in sdf.collect()]
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: spark error {type(e).__name__}: {str(e)[:400]}")
            bad += 1
            continue
        ts = time.time() - t
        if name not in sqls:
            print(f"rows-only {name}: {len(srows)} rows ({ts:.1f}s)")
            continue
        try:
            cur = con.execute(sqls[name])
            dcols = [d[0] for d in cur.description]
            drows = cur.fetchall()
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: duckdb error {str(e)[:400]}")
            bad += 1
            continue
        hs, ls = digest(scols, srows)
        hd, ld = digest(dcols, drows)
        stypes = {f.name: TYPES.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in sdf.schema.fields}
        dtypes = dict(zip(dcols, [str(t) for t in con.sql(sqls[name]).types]))
        ok = sorted(scols) == sorted(dcols) and len(srows) == len(drows) and hs == hd and stypes == dtypes
        status = "ok  " if ok else "FAIL"
        print(f"\n{status} {name}: spark {len(srows)} duck {len(drows)} rows ({ts:.1f}s)")
        if not ok:
            bad += 1
            if sorted(scols) != sorted(dcols):
                print("   cols", sorted(scols), sorted(dcols))
            if stypes != dtypes:
                print("   types", {k: (stypes.get(k), dtypes.get(k)) for k in stypes if stypes.get(k) != dtypes.get(k)})
            a, b = set(ls), set(ld)
            for x in sorted(a - b)[:3]:
                print("   spark-only", x[:300])
            for x in sorted(b - a)[:3]:
                print("   duck-only ", x[:300])
    print("bad:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
