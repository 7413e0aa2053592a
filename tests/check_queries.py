"""Compare every registered query with its SQL. Usage: check_queries.py [sf_dir] [name ...]"""

import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entry  # noqa: E402
from tallyhouse.session import build_session  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def normal(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(
        (tuple(row[i] for i in order) for row in rows), key=repr)


def connect(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return con


def compare(spark, con, sf_dir, name):
    """(matches, rows in Spark, rows in SQL, Spark seconds)."""
    begin = time.time()
    df = entry.queries()[name](spark, sf_dir)
    got = normal([tuple(r) for r in df.collect()], df.columns)
    seconds = time.time() - begin
    sql = entry.oracle_sql().get(name)
    if sql is None:
        return bool(got[1]), len(got[1]), None, seconds
    cursor = con.execute(sql)
    want = normal(cursor.fetchall(), [c[0] for c in cursor.description])
    if got != want:
        print(name, "columns", got[0], want[0])
        extra = [r for r in got[1] if r not in set(want[1])][:3]
        missing = [r for r in want[1] if r not in set(got[1])][:3]
        print("  only Spark:", extra, "\n  only SQL:", missing)
    return got == want, len(got[1]), len(want[1]), seconds


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("check", **{"spark.master": "local[8]", "spark.ui.enabled": "false",
                                      "spark.sql.shuffle.partitions": "8",
                                      "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    bad = []
    for name in sys.argv[2:] or entry.queries():
        try:
            ok, rows, want, seconds = compare(spark, con, sf_dir, name)
        except Exception as error:
            ok, rows, want, seconds = False, str(error)[:600], None, 0
        print(f"{'ok ' if ok else 'BAD'} {name:32} {rows} {want} {seconds:.2f}s", flush=True)
        bad += [] if ok else [name]
    print("bad:", bad)


if __name__ == "__main__":
    main()
