"""Compare catalog queries with their SQL in DuckDB, on one scale.

    python tests/oracle.py SF_DIR [NAME ...]
"""

import glob
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from sparkrank import catalog  # noqa: E402


def connect(sf_dir):
    con = duckdb.connect()
    for path in sorted(glob.glob(f"{sf_dir}/*.parquet")):
        name = os.path.splitext(os.path.basename(path))[0]
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def normal(rows):
    """Rows in one order, with floats as they compare exactly."""
    def value(v):
        if isinstance(v, float):
            return "nan" if math.isnan(v) else repr(v + 0.0)
        return repr(v)
    return sorted(tuple(value(v) for v in row) for row in rows)


def compare(spark, con, sf_dir, name):
    """(rows, seconds, problem or None) of one query."""
    start = time.time()
    df = catalog.QUERIES[name](spark, sf_dir)
    columns = sorted(df.columns)
    found = normal(tuple(r) for r in df.select(*columns).collect())
    seconds = time.time() - start
    if name not in catalog.SQL:
        return len(found), seconds, None
    relation = con.sql(catalog.SQL[name])
    if sorted(relation.columns) != columns:
        return len(found), seconds, f"columns {columns} / {sorted(relation.columns)}"
    expected = normal(con.sql(f"SELECT {', '.join(columns)} FROM relation").fetchall())
    if found != expected:
        only = [r for r in found if r not in set(expected)][:3]
        other = [r for r in expected if r not in set(found)][:3]
        return len(found), seconds, f"{len(found)}/{len(expected)} rows; {only} / {other}"
    return len(found), seconds, None


if __name__ == "__main__":
    from pyspark.sql import SparkSession

    spark = (
        SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g").config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    sf_dir, names = sys.argv[1], sys.argv[2:] or list(catalog.QUERIES)
    con, bad = connect(sf_dir), 0
    for name in names:
        try:
            rows, seconds, problem = compare(spark, con, sf_dir, name)
        except Exception as error:
            rows, seconds, problem = 0, 0.0, f"{type(error).__name__}: {str(error)[:500]}"
        bad += problem is not None
        print(f"{name:32} {rows:8} {seconds:7.2f}s {problem or 'ok'}", flush=True)
    print("failed:", bad)
