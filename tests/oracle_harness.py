"""Run catalogue queries in Spark and their oracle SQL in DuckDB; compare results.

Usage: python tests/oracle_harness.py [sf_dir] [query ...]
       ORACLE_EXTRA_CONF='{"spark.sql.session.timeZone": "Asia/Seoul"}' python tests/oracle_harness.py
"""

from __future__ import annotations

import datetime as dt
import json
import math
import os
import sys
import time
from decimal import Decimal

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def duck_connect(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return v + 0.0
    if isinstance(v, Decimal):
        return v.normalize()
    if isinstance(v, (dt.datetime, dt.date, str, int, bool)) or v is None:
        return v
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if hasattr(v, "asDict"):
        return tuple(_norm(x) for x in v)
    return v


def _key(row):
    return tuple((x is None, type(x).__name__, str(x)) for x in row)


def _family(t: str) -> str:
    t = t.upper()
    if any(k in t for k in ("BIGINT", "LONG", "INT", "SHORT", "BYTE", "HUGEINT")):
        return "int"
    if any(k in t for k in ("DOUBLE", "FLOAT", "REAL")):
        return "float"
    if "DECIMAL" in t:
        return "decimal"
    if "TIMESTAMP" in t:
        return "timestamp"
    if "DATE" in t:
        return "date"
    if any(k in t for k in ("STRING", "VARCHAR")):
        return "string"
    if "BOOL" in t:
        return "bool"
    return t


def compare(spark, name, fn, sql, sf_dir, con=None):
    con = con or duck_connect(sf_dir)
    t0 = time.time()
    df = fn(spark, sf_dir)
    s_cols = df.columns
    s_types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    s_rows = df.collect()
    t1 = time.time()
    if sql is None:
        return {"name": name, "ok": None, "rows": len(s_rows), "spark_s": round(t1 - t0, 2), "note": "no oracle"}
    res = con.execute(sql)
    d_cols = [d[0] for d in res.description]
    d_types = {d[0]: str(d[1]) for d in res.description}
    d_rows = res.fetchall()
    out = {"name": name, "rows": len(s_rows), "oracle_rows": len(d_rows), "spark_s": round(t1 - t0, 2)}
    if sorted(s_cols) != sorted(d_cols):
        out.update(ok=False, note=f"columns differ: spark={s_cols} duck={d_cols}")
        return out
    order = sorted(s_cols)
    si = [s_cols.index(c) for c in order]
    di = [d_cols.index(c) for c in order]
    type_diff = [c for c in order if _family(s_types[c]) != _family(d_types[c])]
    a = sorted((tuple(_norm(r[i]) for i in si) for r in s_rows), key=_key)
    b = sorted((tuple(_norm(r[i]) for i in di) for r in d_rows), key=_key)
    if len(a) != len(b):
        out.update(ok=False, note="row count differs")
    elif a != b:
        bad = next(i for i in range(len(a)) if a[i] != b[i])
        out.update(ok=False, note=f"values differ at {bad}: spark={a[bad]} duck={b[bad]} cols={order}")
    else:
        out.update(ok=True)
    if type_diff:
        out["type_diff"] = {c: (s_types[c], d_types[c]) for c in type_diff}
    return out


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 and argv[1].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in argv[1:] if not a.startswith("/")]
    from marketlake.session import build_session
    import __spark_entry__ as entry

    extra = {"spark.ui.showConsoleProgress": "false"}
    extra.update(json.loads(os.environ.get("ORACLE_EXTRA_CONF", "{}")))  # e.g. another time zone
    spark = build_session("local[8]", shuffle_partitions=8, extra=extra)
    spark.sparkContext.setLogLevel("ERROR")
    qs, sqls = entry.queries(), entry.oracle_sql()
    con = duck_connect(sf_dir)
    bad = 0
    for name in names or list(qs):
        try:
            r = compare(spark, name, qs[name], sqls.get(name), sf_dir, con)
        except Exception as e:  # report and continue
            r = {"name": name, "ok": False, "note": f"{type(e).__name__}: {str(e)[:400]}"}
        bad += r.get("ok") is False or "type_diff" in r
        print(r, flush=True)
    print(f"{len(names or qs)} queries, {bad} problems")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
