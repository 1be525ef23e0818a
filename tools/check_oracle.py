"""Run registered queries in Spark and their oracle SQL in DuckDB; compare.

usage: python tools/check_oracle.py [sf_dir] [name ...]
Prints one line per query: OK / MISMATCH with row counts and type notes.
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from ledgerline.plans.catalog import TABLES  # noqa: E402
from ledgerline.plans.registry import load_all  # noqa: E402
from ledgerline.session import build_session  # noqa: E402


def norm(v):
    if v is None:
        return (0, "")
    if isinstance(v, float):
        if math.isnan(v):
            return (1, "nan")
        if os.environ.get("CHECK_EXACT"):
            return (1, repr(v))
        return (1, f"{v:.6g}" if abs(v) >= 1e15 else f"{round(v, 6):.6f}")
    if hasattr(v, "isoformat"):
        return (2, v.isoformat())
    if isinstance(v, (list, tuple)):
        return (3, repr([norm(x) for x in v]))
    if isinstance(v, dict):
        return (4, repr(sorted((k, norm(x)) for k, x in v.items())))
    if isinstance(v, bool):
        return (5, str(v))
    if isinstance(v, int):
        return (6, str(v))
    return (7, str(v))


SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
                 "date": "DATE", "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN",
                 "float": "FLOAT", "smallint": "SMALLINT", "timestamp": "TIMESTAMP WITH TIME ZONE"}


def main():
    args = sys.argv[1:]
    sf_dir = args[0] if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in args if not a.startswith("/")]
    reg = load_all()
    extra = {}
    if os.environ.get("CHECK_SESSION_TZ"):
        extra["spark.sql.session.timeZone"] = os.environ["CHECK_SESSION_TZ"]
    spark = build_session("local[8]", shuffle_partitions=8, extra=extra)
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    bad = 0
    for name, r in reg.items():
        if names and name not in names:
            continue
        t0 = time.time()
        try:
            sdf = r.build(spark, sf_dir)
            srows = [tuple(x) for x in sdf.collect()]
            scols = sdf.columns
            stypes = [SPARK_TO_DUCK.get(t, t.upper()) for _, t in sdf.dtypes]
        except Exception as e:  # noqa: BLE001
            print(f"SPARK-ERROR {name}: {str(e)[:400]}")
            bad += 1
            continue
        st = time.time() - t0
        if not r.sql:
            print(f"ROWS-ONLY {name}: spark={len(srows)} ({st:.1f}s)")
            continue
        try:
            rel = con.execute(r.sql)
            drows = rel.fetchall()
            dcols = [d[0] for d in rel.description]
            dtypes = [str(d[1]) for d in rel.description]
        except Exception as e:  # noqa: BLE001
            print(f"DUCK-ERROR {name}: {str(e)[:400]}")
            bad += 1
            continue
        notes = []
        if sorted(scols) != sorted(dcols):
            notes.append(f"cols spark={sorted(scols)} duck={sorted(dcols)}")
        else:
            sm = dict(zip(scols, stypes))
            dm = dict(zip(dcols, dtypes))
            tdiff = {c: (sm[c], dm[c]) for c in scols if sm[c] != dm[c]}
            if tdiff:
                notes.append(f"types {tdiff}")
        ok = len(srows) == len(drows)
        if ok and not notes:
            order = sorted(range(len(scols)), key=lambda i: scols[i])
            dorder = [dcols.index(scols[i]) for i in order]
            a = sorted(tuple(norm(row[i]) for i in order) for row in srows)
            b = sorted(tuple(norm(row[i]) for i in dorder) for row in drows)
            if a != b:
                ok = False
                from collections import Counter
                ca, cb = Counter(a), Counter(b)
                only_s = list((ca - cb).elements())[:2]
                only_d = list((cb - ca).elements())[:2]
                notes.append(f"values differ ({sum((ca - cb).values())} rows) e.g. "
                             f"spark-only {only_s} duck-only {only_d}")
        status = "OK" if ok and not notes else "MISMATCH"
        bad += status != "OK"
        print(f"{status} {name}: spark={len(srows)} duck={len(drows)} ({st:.1f}s) {' '.join(notes)}")
    print(f"done; {bad} problems")


if __name__ == "__main__":
    main()
