"""Run registered queries next to their oracles: python -m checks.compare [folder] [query ...]"""

import sys
import tempfile
import time

import duckdb
from pyspark.sql import SparkSession

from checks.oracles import oracle_sql
from checks.registry import queries

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def oracle_rows(folder: str, text: str):
    db = duckdb.connect()
    for name in TABLES:
        db.execute(f"create view {name} as select * from '{folder}/{name}.parquet'")
    result = db.execute(text)
    return [column[0] for column in result.description], result.fetchall()


def canonical(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(repr([row[i] for i in order]) for row in rows)


def session() -> SparkSession:
    return (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="run-"))
        .getOrCreate()
    )


def main(folder="/root/testdata/sf0.01", *wanted):
    spark = session()
    spark.sparkContext.setLogLevel("ERROR")
    oracles = oracle_sql()
    failed = 0
    for name, query in queries().items():
        if wanted and name not in wanted:
            continue
        started = time.time()
        try:
            table = query(spark, folder)
            mine = canonical(table.columns, [tuple(row) for row in table.collect()])
            took = time.time() - started
            columns, rows = oracle_rows(folder, oracles[name])
            theirs = canonical(columns, rows)
        except Exception as error:
            failed += 1
            print(f"ERROR {name}: {str(error)[:1500]}", flush=True)
            continue
        same = sorted(columns) == sorted(table.columns) and mine == theirs
        failed += not same
        print(f"{'ok   ' if same else 'DIFF '} {name} rows={len(mine)}/{len(theirs)} {took:.2f}s", flush=True)
        if not same:
            print("  columns", sorted(table.columns), sorted(columns))
            ours, others = set(mine), set(theirs)
            print("  only spark", sorted(ours - others)[:3])
            print("  only oracle", sorted(others - ours)[:3], flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(bool(main(*sys.argv[1:])))
