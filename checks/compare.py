"""Run registered queries and their SQL side by side: python -m checks.compare [sf_dir] [name ...]"""

from __future__ import annotations

import sys
import time

import duckdb
from pyspark.sql import SparkSession

from checks.oracle import SQL
from checks.queries import QUERIES
from phrasetide.session import build_session

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()

SPARK_TYPES = {"BIGINT": "bigint", "INTEGER": "int", "VARCHAR": "string", "BOOLEAN": "boolean",
               "DOUBLE": "double", "TIMESTAMP": "timestamp_ntz"}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"create view {table} as select * from '{sf_dir}/{table}.parquet'")
    return con


def normal(columns: list[str], rows: list[tuple]) -> list[tuple]:
    """Rows with columns in name order, sorted; floats rounded to six digits."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    clean = [tuple(round(r[i], 6) if isinstance(r[i], float) else r[i] for i in order)
             for r in rows]
    return sorted(clean, key=lambda r: tuple((v is not None, str(v)) for v in r))


def differences(spark: SparkSession, con, sf_dir: str, name: str) -> tuple[int, list[str]]:
    """Rows of the Spark result, and what differs from the SQL (none without SQL)."""
    ours = QUERIES[name](spark, sf_dir)
    a = normal(ours.columns, [tuple(r) for r in ours.collect()])
    if name not in SQL:
        return len(a), []
    theirs = con.execute(SQL[name])
    columns = [d[0] for d in theirs.description]
    types = {d[0]: SPARK_TYPES.get(str(d[1]), str(d[1])) for d in theirs.description}
    b = normal(columns, theirs.fetchall())
    found = []
    if types != dict(ours.dtypes):
        found.append(f"types {types} against {dict(ours.dtypes)}")
    if len(a) != len(b):
        found.append(f"{len(a)} rows against {len(b)}")
    found += [f"{str(x)[:300]} against {str(y)[:300]}"
              for x, y in zip(a, b) if x != y][:3]
    return len(a), found


def main(sf_dir: str = "/root/testdata/sf0.01", *names: str) -> int:
    spark = build_session("compare", "local[8]", **{
        "spark.sql.shuffle.partitions": 8, "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "12g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    failed = 0
    for name in names or QUERIES:
        start = time.time()
        rows, found = differences(spark, con, sf_dir, name)
        verdict = "DIFF" if found else "ok" if name in SQL else "no SQL"
        print(f"{name:32} {verdict:6} rows={rows} {time.time() - start:.1f}s", flush=True)
        for line in found:
            print("   ", line)
        failed += bool(found)
    return failed


if __name__ == "__main__":
    sys.exit(main(*sys.argv[1:]))
