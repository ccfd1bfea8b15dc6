"""Run registered queries in Spark and DuckDB and compare the rows.

    python tests/oracle.py [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time
from glob import glob

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

KINDS = {
    "tinyint": "int", "smallint": "int", "int": "int", "bigint": "int", "integer": "int", "hugeint": "huge",
    "float": "real", "double": "real", "boolean": "bool", "string": "text", "varchar": "text",
}


def kind(type_name: str) -> str:
    return KINDS.get(type_name.lower(), type_name.lower())


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    return value


def sorted_rows(rows, order):
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def compare(df, con, sql):
    """Empty text where Spark and DuckDB agree, else what differs."""
    names = df.columns
    spark_rows = [tuple(r) for r in df.collect()]
    cur = con.execute(sql)
    duck_names = [d[0] for d in cur.description]
    duck_rows = cur.fetchall()
    if sorted(names) != sorted(duck_names):
        return f"columns {sorted(names)} / {sorted(duck_names)}"
    types = con.execute("DESCRIBE " + sql).fetchall()
    duck_types = {t[0]: kind(t[1]) for t in types}
    wrong = {n: (t, duck_types[n]) for n, t in df.dtypes if kind(t) != duck_types[n]}
    if wrong:
        return f"types {wrong}"
    order = sorted(names)
    a = sorted_rows(spark_rows, [names.index(n) for n in order])
    b = sorted_rows(duck_rows, [duck_names.index(n) for n in order])
    if len(a) != len(b):
        return f"rows {len(a)} / {len(b)}"
    for x, y in zip(a, b):
        if x != y:
            return f"{order}\n   spark {x}\n   duck  {y}"
    return "" if a else "no rows"


def connect(sf_dir):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def session(cores="8"):
    from pyspark.sql import SparkSession

    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def main(argv):
    import __spark_entry__ as entry

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    queries, sqls = entry.queries(), entry.oracle_sql()
    names = argv[1:] or list(queries)
    spark, con = session(), connect(sf_dir)
    bad = 0
    for name in names:
        t0 = time.time()
        try:
            df = queries[name](spark, sf_dir)
            told = compare(df, con, sqls[name]) if name in sqls else f"no SQL, {df.count()} rows"
        except Exception as e:  # report and go on
            told = f"{type(e).__name__}: {str(e)[:600]}"
        ok = told == "" or told.startswith("no SQL")
        bad += not ok
        print(f"{'ok ' if ok else 'BAD'} {name} {time.time() - t0:.2f}s {told}", flush=True)
    print(f"{len(names)} queries, {bad} bad")
    return bad


if __name__ == "__main__":
    sys.exit(bool(main(sys.argv[1:])))
