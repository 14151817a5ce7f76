"""Runs registered queries and their SQL side by side: python -m tests.oracle [name...]"""

import glob
import math
import os
import sys
import time

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        if glob.glob(path):
            con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{path}{'/*.parquet' if os.path.isdir(path) else ''}'")
    return con


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else f"{v:.9g}"
    if hasattr(v, "as_tuple"):
        return f"{float(v):.9g}"
    if isinstance(v, (list, tuple)):
        return str([plain(x) for x in v])
    return str(v)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted([tuple(plain(r[i]) for i in order) for r in rows], key=str)


def compare(spark, con, name, f, sql, sf_dir):
    df = f(spark, sf_dir)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    rel = con.sql(sql)
    want = rows_of(rel.columns, rel.fetchall())
    kinds = {c: str(t) for c, t in zip(rel.columns, rel.types, strict=True)}
    if got[0] != want[0]:
        return f"columns {got[0]} {want[0]}"
    names = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN"}
    off = [(c, t, kinds[c]) for c, t in df.dtypes if names.get(t, kinds[c]) != kinds[c]]
    if got[1] != want[1]:
        a, b = set(got[1]), set(want[1])
        return f"rows {len(got[1])} {len(want[1])}: {sorted(a - b)[:3]} / {sorted(b - a)[:3]}"[:900]
    return f"ok {len(got[1])}" + (f" TYPES {off}" if off else "")


if __name__ == "__main__":
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    spark = SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8").config("spark.driver.memory", "6g").config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    sf_dir = os.environ.get("SF_DIR", "/root/testdata/sf0.001")
    con, sql, bad = connect(sf_dir), entry.oracle_sql(), 0
    for name, f in entry.queries().items():
        if sys.argv[1:] and not any(name.startswith(x) for x in sys.argv[1:]):
            continue
        began = time.time()
        try:
            said = compare(spark, con, name, f, sql[name], sf_dir) if name in sql else f"rows only {f(spark, sf_dir).count()}"
        except Exception as e:  # noqa: BLE001
            said = f"FAILED {type(e).__name__}: {str(e)[:600]}"
        bad += not said.startswith(("ok", "rows only"))
        print(f"{name}: {said} ({time.time() - began:.1f} s)", flush=True)
    sys.exit(bad > 0)
