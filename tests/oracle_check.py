"""Compare every catalogue query with its DuckDB oracle (usable from pytest or the shell).

    python tests/oracle_check.py /root/testdata/sf0.01 [name ...]
"""

from __future__ import annotations

import math
import sys
import time

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6)
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def rows_of(records, cols):
    out = [tuple(_norm(r[c]) for c in cols) for r in records]
    return sorted(out, key=lambda t: tuple((x is None, str(type(x)), x if x is not None else 0) for x in t))


def compare(spark, con, name, fn, oracle_sql, sf_dir):
    df = fn(spark, sf_dir)
    spark_cols = sorted(df.columns)
    srows = [r.asDict() for r in df.collect()]
    if oracle_sql is None:
        return True, f"{name}: {len(srows)} rows (no oracle)"
    cur = con.execute(oracle_sql)
    dcols = [d[0] for d in cur.description]
    drows = [dict(zip(dcols, r)) for r in cur.fetchall()]
    if sorted(dcols) != spark_cols:
        return False, f"{name}: columns differ spark={spark_cols} duck={sorted(dcols)}"
    a, b = rows_of(srows, spark_cols), rows_of(drows, spark_cols)
    if len(a) != len(b):
        return False, f"{name}: row count spark={len(a)} duck={len(b)}"
    diffs = [(x, y) for x, y in zip(a, b) if x != y]
    if diffs:
        return False, f"{name}: {len(diffs)} differing rows, first spark={diffs[0][0]} duck={diffs[0][1]}"
    return True, f"{name}: {len(a)} rows match"


def main(argv):
    sys.path.insert(0, ".")
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:] or list(entry.queries())
    spark = (SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
             .config("spark.sql.shuffle.partitions", "8").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    qs, os_ = entry.queries(), entry.oracle_sql()
    bad = 0
    for n in names:
        t = time.time()
        try:
            ok, msg = compare(spark, con, n, qs[n], os_.get(n), sf_dir)
        except Exception as e:  # report and continue
            ok, msg = False, f"{n}: ERROR {type(e).__name__}: {str(e)[:400]}"
        bad += not ok
        print(("OK  " if ok else "BAD ") + msg + f"  [{time.time() - t:.1f}s]", flush=True)
    print(f"{len(names) - bad}/{len(names)} ok")
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv))
