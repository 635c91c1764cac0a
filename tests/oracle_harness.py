"""Run registered queries in Spark and their oracle SQL in DuckDB; compare.

    python tests/oracle_harness.py [sf_dir] [name ...]

Comparison: same column names, same row count, same multiset of rows after
rounding floats to 6 places (columns sorted by name).
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck(sf_dir):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None or type(v).__name__ == "NAType":
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6)
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def rows_of(pdf):
    cols = sorted(pdf.columns)
    out = []
    for rec in pdf[cols].itertuples(index=False, name=None):
        out.append(tuple(_norm(x) for x in rec))
    out.sort(key=lambda r: tuple((x is None, str(type(x)), x if x is not None else 0) for x in r))
    return cols, out


def compare(spark, con, sf_dir, name, fn, sql):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    s_pdf = sdf.toPandas()
    t1 = time.time()
    res = {"name": name, "spark_rows": len(s_pdf), "spark_sec": round(t1 - t0, 2)}
    if sql is None:
        res["status"] = "rows-only"
        return res
    d_pdf = con.execute(sql).df()
    res["oracle_rows"] = len(d_pdf)
    sc, sr = rows_of(s_pdf)
    dc, dr = rows_of(d_pdf)
    if sc != dc:
        res["status"] = "COLUMNS"
        res["detail"] = f"spark={sc} oracle={dc}"
    elif len(sr) != len(dr):
        res["status"] = "ROWCOUNT"
    elif sr != dr:
        bad = [(a, b) for a, b in zip(sr, dr) if a != b][:3]
        res["status"] = "VALUES"
        res["detail"] = str(bad)[:600]
    else:
        res["status"] = "OK"
    return res


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 and os.path.isdir(argv[1]) else "/root/testdata/sf0.01"
    names = [a for a in argv[1:] if not os.path.isdir(a)]
    import __spark_entry__ as E
    from edcohort.session import local_session
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    qs, oracle = E.queries(), E.oracle_sql()
    ok = 0
    for name in (names or sorted(qs)):
        try:
            r = compare(spark, con, sf_dir, name, qs[name], oracle.get(name))
        except Exception as e:  # report and continue
            r = {"name": name, "status": "ERROR", "detail": repr(e)[:800]}
        ok += r["status"] in ("OK", "rows-only")
        print(r, flush=True)
    print(f"{ok}/{len(names or qs)} passed")


if __name__ == "__main__":
    main(sys.argv)
