"""Runs registered queries in Spark and their SQL in DuckDB and compares all values.

Usage: python tests/oracle_check.py SF_DIR [name ...]
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _norm(value):
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    if isinstance(value, float) and value == 0:
        return 0.0
    return value


def _sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    picked = [tuple(_norm(row[i]) for i in order) for row in rows]
    return sorted(picked, key=lambda r: [(v is not None, str(type(v)), str(v)) for v in r])


def compare(spark_df, con, sql: str) -> str | None:
    """None when equal, else what differs."""
    spark_rows = [tuple(r) for r in spark_df.collect()]
    result = con.execute(sql)
    names = [c[0] for c in result.description]
    oracle_rows = result.fetchall()
    if sorted(names) != sorted(spark_df.columns):
        return f"columns {sorted(spark_df.columns)} vs {sorted(names)}"
    if len(spark_rows) != len(oracle_rows):
        return f"{len(spark_rows)} rows vs {len(oracle_rows)}"
    left = _sorted_rows(spark_df.columns, spark_rows)
    right = _sorted_rows(names, oracle_rows)
    for a, b in zip(left, right):
        if a != b or [type(x) for x in a] != [type(x) for x in b]:
            return f"{a} vs {b}"
    return None


def main() -> int:
    from pyspark.sql import SparkSession

    from __spark_entry__ import oracle_sql, queries

    sf_dir, names = sys.argv[1], sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    oracles, bad = oracle_sql(), 0
    for name, query in queries().items():
        if names and name not in names:
            continue
        started = time.time()
        try:
            df = query(spark, sf_dir)
            if name in oracles:
                problem = compare(df, con, oracles[name])
                outcome = "equal" if problem is None else f"DIFFERENT {problem[:1500]}"
            else:
                problem, outcome = None, f"rows only: {len(df.collect())}"
        except Exception as error:
            problem, outcome = "error", f"ERROR {type(error).__name__} {str(error)[:1500]}"
        bad += problem is not None
        print(f"{name}: {outcome} ({time.time() - started:.1f}s)", flush=True)
    print("different:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(main())
