"""Compare every query with its oracle: python tests/check_oracles.py [sf_dir] [name ...]"""

from __future__ import annotations

import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str):
    db = duckdb.connect()
    for name in TABLES:
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return db


def rows_of(columns, rows):
    """Rows as sorted tuples, columns in name order, integers and floats told apart."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted((tuple(r[i] for i in order) for r in rows), key=repr)


def compare(spark, db, sf_dir, query, sql):
    """None when both sides agree, else a description of the difference."""
    result = db.execute(sql)
    expected = rows_of([d[0] for d in result.description], result.fetchall())
    df = query(spark, sf_dir)
    actual = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if actual[0] != expected[0]:
        return f"columns {actual[0]} != {expected[0]}"
    if len(actual[1]) != len(expected[1]):
        return f"{len(actual[1])} rows != {len(expected[1])}"
    for a, e in zip(actual[1], expected[1]):
        if a != e or [type(x) for x in a] != [type(x) for x in e]:
            return f"{str(a)[:700]}\n   != {str(e)[:700]}"
    return None


if __name__ == "__main__":
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    db = connect(sf_dir)
    oracles = entry.oracle_sql()
    for name, query in entry.queries().items():
        if len(sys.argv) > 2 and name not in sys.argv[2:] or name not in oracles:
            continue
        start = time.time()
        try:
            problem = compare(session, db, sf_dir, query, oracles[name])
        except Exception as error:  # report and go on
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.time() - start:.1f}s", flush=True)
        if problem:
            print("   " + problem, flush=True)
