"""Compare registered queries with their SQL on DuckDB.

Usage: python tests/oracle.py <folder of Parquet tables> [query ...]
"""

from __future__ import annotations

import datetime
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def plain(value):
    if value is None:
        return None
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    return str(value)


def sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(
        (tuple(plain(row[i]) for i in order) for row in rows), key=lambda r: tuple((v is not None, v or "") for v in r)
    )


def duck(folder):
    import duckdb

    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def compare(spark, con, name, query, sql, folder):
    """Empty string if equal, else what differs."""
    df = query(spark, folder)
    got = sorted_rows(df.columns, [tuple(r) for r in df.collect()])
    cursor = con.execute(sql)
    columns = [c[0] for c in cursor.description]
    want = sorted_rows(columns, cursor.fetchall())
    if sorted(df.columns) != sorted(columns):
        return f"columns {sorted(df.columns)} / {sorted(columns)}"
    if len(got) != len(want):
        return f"rows {len(got)} / {len(want)}; first: {got[:1]} / {want[:1]}"
    differing = [(a, b) for a, b in zip(got, want) if a != b]
    return f"{len(differing)} of {len(got)} rows differ: {differing[:2]}" if differing else ""


def main():
    from __spark_entry__ import oracle_sql, queries
    from stayline.session import build_session

    folder, only = sys.argv[1], sys.argv[2:]
    spark = build_session(
        "oracle", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "12g"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, sqls = duck(folder), oracle_sql()
    for name, query in queries().items():
        if only and name not in only:
            continue
        started = time.time()
        try:
            if name in sqls:
                problem = compare(spark, con, name, query, sqls[name], folder)
            else:
                problem = "" if query(spark, folder).count() >= 0 else "no rows"
        except Exception as error:  # report every query, not only the first failure
            problem = f"{type(error).__name__}: {str(error)[:900]}"
        state = "FAIL" if problem else ("ok" if name in sqls else "ok (rows only)")
        print(f"{name:28s} {time.time() - started:6.2f}s {state} {problem}", flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
