"""Run registered queries in Spark and their SQL twins in DuckDB; compare.

Usage: python tests/oracle_check.py [sf_dir] [name ...]
Compares row count, column names and the multiset of rows (columns sorted by
name, doubles rounded to 6 places), like the driver's check.
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def _canon(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return repr(round(v, 6))
    if hasattr(v, "isoformat"):
        return v.isoformat(sep=" ") if hasattr(v, "hour") else v.isoformat()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_canon(x) for x in v) + "]"
    if hasattr(v, "tolist"):
        return _canon(v.tolist())
    return str(v)


def rows_of(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(_canon(r[i]) for i in order) for r in rows)


def duck(sf_dir):
    import duckdb
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def check(spark, con, name, fn, sql, sf_dir):
    t = time.time()
    df = fn(spark, sf_dir)
    scols = df.columns
    srows = [tuple(r) for r in df.collect()]
    ts = time.time() - t
    if sql is None:
        return dict(name=name, ok=None, rows=len(srows), spark_s=round(ts, 2))
    t = time.time()
    cur = con.execute(sql)
    dcols = [d[0] for d in cur.description]
    drows = cur.fetchall()
    td = time.time() - t
    res = dict(name=name, rows=len(srows), oracle_rows=len(drows),
               spark_s=round(ts, 2), duck_s=round(td, 2))
    if sorted(scols) != sorted(dcols):
        res.update(ok=False, why=f"columns {sorted(scols)} vs {sorted(dcols)}")
        return res
    a, b = rows_of(scols, srows), rows_of(dcols, drows)
    if a != b:
        diff = [(x, y) for x, y in zip(a, b) if x != y][:2]
        res.update(ok=False, why=f"values differ, e.g. {diff}"[:600])
        return res
    res["ok"] = True
    return res


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 and argv[1].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in argv[1:] if not a.startswith("/")]
    import __spark_entry__ as E
    from tokenloom.session import get_spark
    if os.environ.get("PLAIN_SESSION"):
        # a session without this library's defaults (as another driver may build it)
        from pyspark.sql import SparkSession
        spark = (SparkSession.builder.master("local[8]")
                 .config("spark.sql.session.timeZone", os.environ.get("PLAIN_TZ", "America/New_York"))
                 .getOrCreate())
    else:
        spark = get_spark("local[8]", conf={"spark.sql.shuffle.partitions": "8",
                                            "spark.driver.memory": "16g"})
    con = duck(sf_dir)
    qs, ors = E.queries(), E.oracle_sql()
    bad = 0
    for name in (names or sorted(qs)):
        try:
            r = check(spark, con, name, qs[name], ors.get(name), sf_dir)
        except Exception as e:  # report and continue
            r = dict(name=name, ok=False, why=f"{type(e).__name__}: {str(e)[:400]}")
        bad += r.get("ok") is False
        print(r, flush=True)
    print(f"FAILED {bad}" if bad else "ALL OK")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
