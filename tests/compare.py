"""Runs the registered queries against DuckDB: python -m tests.compare <folder> [names...]"""

import math
import os
import sys
import time

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()


def duck(sf_dir):
    import duckdb

    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if value is None:
        return None
    if isinstance(value, bool):
        return value
    if isinstance(value, (int, float)) or type(value).__name__ == "Decimal":
        number = float(value)
        return None if math.isnan(number) else round(number, 6)
    return str(value)


def normalised(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    names = [columns[i] for i in order]
    return names, sorted((tuple(_plain(row[i]) for i in order) for row in rows), key=repr)


def spark_result(df):
    return normalised(df.columns, [tuple(row) for row in df.collect()])


def duck_result(con, sql):
    cursor = con.execute(sql)
    return normalised([d[0] for d in cursor.description], cursor.fetchall())


def main(sf_dir, names):
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as entry
    from cutline.session import build_session

    spark = build_session("compare", "local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "8g",
        "spark.sql.warehouse.dir": "/tmp/cutline-warehouse",
    })
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    sql = entry.oracle_sql()
    bad = 0
    for name, query in entry.queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            got = spark_result(query(spark, sf_dir))
        except Exception as error:
            bad += 1
            print(f"{name:28s} ERROR {str(error)[:1500]}")
            continue
        spent = time.time() - start
        if name not in sql:
            print(f"{name:28s} rows={len(got[1])} (no SQL) {spent:.2f}s")
            continue
        try:
            want = duck_result(con, sql[name])
        except Exception as error:
            bad += 1
            print(f"{name:28s} SQL ERROR {str(error)[:1500]}")
            continue
        ok = got == want
        bad += not ok
        print(f"{name:28s} {'ok' if ok else 'DIFFERS'} rows={len(got[1])}/{len(want[1])} {spent:.2f}s")
        if not ok:
            print("   columns", got[0], want[0])
            for a, b in [pair for pair in zip(got[1], want[1]) if pair[0] != pair[1]][:3]:
                print("   spark ", a, "\n   duckdb", b)
    print("bad:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1], sys.argv[2:]) else 0)
