"""Local stand-in for the driver's check: run each registered query and its
DuckDB oracle on the same parquet tables; compare rows, columns and an
order-insensitive hash of the values.

    python tests/compare_oracle.py [sf_dir] [key ...]
"""

import hashlib
import json
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def norm(v):
    if v is None:
        return "∅"
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return f"{round(v, 6):.6f}"
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(norm(x) for x in v) + "]"
    if hasattr(v, "item"):
        return norm(v.item())
    return str(v)


def digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join(norm(r[i]) for i in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()[:16], lines


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = set(sys.argv[2:])
    import __spark_entry__ as E
    from quarry.session import local_session
    spark = local_session(8)
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    qs, orc = E.queries(), E.oracle_sql()
    report = {}
    for k, fn in qs.items():
        if only and k not in only:
            continue
        t0 = time.time()
        try:
            df = fn(spark, sf)
            rows = [tuple(r) for r in df.collect()]
            cols = df.columns
        except Exception as e:  # noqa: BLE001
            report[k] = {"status": "spark_error", "error": str(e)[:400]}
            print(k, "SPARK ERROR", str(e)[:400], flush=True)
            continue
        ts = time.time() - t0
        if k not in orc:
            report[k] = {"status": "rows_only", "rows": len(rows)}
            print(f"{k:20s} rows-only {len(rows)} ({ts:.1f}s)", flush=True)
            continue
        t0 = time.time()
        try:
            res = con.execute(orc[k])
            ocols = [d[0] for d in res.description]
            orows = res.fetchall()
        except Exception as e:  # noqa: BLE001
            report[k] = {"status": "oracle_error", "error": str(e)[:400]}
            print(k, "ORACLE ERROR", str(e)[:400], flush=True)
            continue
        to = time.time() - t0
        h1, l1 = digest(cols, rows)
        h2, l2 = digest(ocols, orows)
        ok = sorted(cols) == sorted(ocols) and len(rows) == len(orows) and h1 == h2
        report[k] = {"status": "match" if ok else "MISMATCH", "rows": len(rows),
                     "oracle_rows": len(orows), "cols": cols, "oracle_cols": ocols}
        print(f"{k:20s} {'ok ' if ok else 'BAD'} spark={len(rows)} oracle={len(orows)} "
              f"({ts:.1f}s / {to:.1f}s)", flush=True)
        if not ok:
            if sorted(cols) != sorted(ocols):
                print("   cols", cols, ocols)
            a, b = set(l1), set(l2)
            for x in sorted(a - b)[:3]:
                print("   spark only :", x[:300])
            for x in sorted(b - a)[:3]:
                print("   oracle only:", x[:300])
    out = os.environ.get("COMPARE_OUT")
    if out:
        json.dump(report, open(out, "w"), indent=1)
    bad = [k for k, v in report.items() if v["status"] not in ("match", "rows_only")]
    print("SUMMARY", len(report) - len(bad), "ok of", len(report), "bad:", bad)


if __name__ == "__main__":
    main()
