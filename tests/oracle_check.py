"""Run registered queries in Spark and their oracle SQL in DuckDB, and compare.

Mirrors the driver's check: row count, column names, order-insensitive values.
Usage: python tests/oracle_check.py [sf_dir] [name ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import sys
import time

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def _norm(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, (int,)):
        return int(v)
    if isinstance(v, (float, decimal.Decimal)):
        f = float(v)
        if math.isnan(f):
            return "nan"
        return round(f, 6)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return str(v)


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i].lower())
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=repr)


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def compare(spark, con, name, fn, sql, sf_dir):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    srows = sdf.collect()
    scols = sdf.columns
    t1 = time.time()
    if sql is None:
        return dict(name=name, ok=None, rows=len(srows), spark_s=round(t1 - t0, 2))
    res = con.sql(sql)
    dcols = [c[0] for c in res.description]
    drows = res.fetchall()
    out = dict(name=name, rows=len(srows), oracle_rows=len(drows), spark_s=round(t1 - t0, 2))
    if sorted(c.lower() for c in scols) != sorted(c.lower() for c in dcols):
        out.update(ok=False, why=f"columns {sorted(scols)} vs {sorted(dcols)}")
        return out
    a, b = _rows(scols, srows), _rows(dcols, drows)
    if a != b:
        diff = [x for x in a if x not in set(b)][:3]
        diff2 = [x for x in b if x not in set(a)][:3]
        out.update(ok=False, why=f"values differ; spark-only {diff} oracle-only {diff2}")
        return out
    out["ok"] = True
    return out


def main(argv):
    sys.path.insert(0, "/root/repo")
    sf_dir = argv[1] if len(argv) > 1 and argv[1].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in argv[1:] if not a.startswith("/") and not a.startswith("--")]
    from __spark_entry__ import oracle_sql, queries
    if "--plain" in argv:
        # a session as a caller might build it, without quarry's defaults
        from pyspark.sql import SparkSession
        spark = (SparkSession.builder.master("local[*]")
                 .config("spark.sql.shuffle.partitions", "8")
                 .config("spark.ui.enabled", "false").getOrCreate())
    else:
        from quarry.session import get_session
        spark = get_session("local[8]", 8)
    con = duck(sf_dir)
    qs, sqls = queries(), oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if names and name not in names:
            continue
        try:
            r = compare(spark, con, name, fn, sqls.get(name), sf_dir)
        except Exception as e:  # report and go on
            r = dict(name=name, ok=False, why=f"{type(e).__name__}: {str(e)[:400]}")
        bad += r.get("ok") is False
        print(r, flush=True)
    print(f"FAILED {bad}" if bad else "ALL OK")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
