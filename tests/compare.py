"""Run Spark queries and the DuckDB oracle side by side (order-insensitive).

Usage: python tests/compare.py [sf_dir] [query ...]
"""

from __future__ import annotations

import hashlib
import sys
import time

import duckdb

sys.path.insert(0, __file__.rsplit("/tests/", 1)[0])

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def norm(v):
    if v is None:
        return "\x00"
    if isinstance(v, float):
        return repr(round(v, 6))
    if hasattr(v, "isoformat"):
        return v.isoformat(sep=" ")
    return str(v)


def digest(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join(norm(r[i]) for i in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()[:16], lines


def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 and sys.argv[1].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in sys.argv[1:] if not a.startswith("/")]
    from tidemart.session import build_session
    import __spark_entry__ as entry
    spark = build_session("local[8]", 8)
    qs, sql = entry.queries(), entry.oracle_sql()
    con = duck(sf)
    ok = 0
    for n in names or list(qs):
        t = time.time()
        try:
            sdf = qs[n](spark, sf)
            scols = sdf.columns
            srows = [tuple(r) for r in sdf.collect()]
            st = time.time() - t
            if n not in sql:
                print(f"{n:30s} spark rows={len(srows)} (no oracle)")
                continue
            res = con.execute(sql[n])
            dcols = [d[0] for d in res.description]
            drows = res.fetchall()
            sh, sl = digest(srows, scols)
            dh, dl = digest(drows, dcols)
            same = sorted(scols) == sorted(dcols) and sh == dh
            ok += same
            print(f"{n:30s} {'OK ' if same else 'BAD'} spark={len(srows)} duck={len(drows)} {st:.1f}s", flush=True)
            if not same:
                if sorted(scols) != sorted(dcols):
                    print("   cols spark", sorted(scols), "\n   cols duck ", sorted(dcols))
                else:
                    a, b = set(sl), set(dl)
                    print("   spark-only:", sorted(a - b)[:3])
                    print("   duck-only: ", sorted(b - a)[:3])
        except Exception as e:  # noqa: BLE001
            print(f"{n:30s} ERR {type(e).__name__}: {str(e)[:400]}", flush=True)
    print(f"matched {ok}")


if __name__ == "__main__":
    main()
