"""Run every registered query next to its SQL and compare all values.

``python -m checks.compare [sf_dir] [name ...]``
"""

from __future__ import annotations

import math
import sys
import time
from collections import Counter

import duckdb
from pyspark.sql import DataFrame, SparkSession

from checks import registry

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _value(x):
    if x is None or (isinstance(x, float) and math.isnan(x)):
        return None
    if isinstance(x, float) and x == 0:
        return 0.0
    return x


def bag(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_value(r[i]) for i in order) for r in rows)


def difference(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> str:
    """Empty when both give the same columns and the same rows."""
    expected = con.execute(sql)
    columns = [c[0] for c in expected.description]
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} instead of {sorted(columns)}"
    want, got = bag(columns, expected.fetchall()), bag(df.columns, df.collect())
    if want == got:
        return ""
    return (
        f"{sum(got.values())} rows, expected {sum(want.values())}; "
        f"extra {list((got - want).items())[:3]}, missing {list((want - got).items())[:3]}; "
        f"columns {sorted(columns)}")


def main(sf_dir: str = "/root/testdata/sf0.01", *names: str) -> int:
    spark = (
        SparkSession.builder.master("local[8]").appName("compare")
        .config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = duck(sf_dir), 0
    for name in names or registry.ALL:
        query, sql = registry.ALL[name]
        began = time.time()
        try:
            problem = difference(query(spark, sf_dir), con, sql) if sql else "no SQL"
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:700]}"
        bad += bool(problem)
        print(f"{'ok  ' if not problem else 'FAIL'} {name} {time.time() - began:.1f}s {problem}",
              flush=True)
    print(f"{bad} of {len(names or registry.ALL)} differ")
    return bad


if __name__ == "__main__":
    sys.exit(main(*sys.argv[1:]))
