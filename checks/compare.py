"""Run the registered queries beside their SQL: ``python -m checks.compare [FOLDER] [NAME ...]``."""

from __future__ import annotations

import math
import sys
import time

import duckdb

from checks import oracle, registry
from tallyworks.session import get_session

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS FROM '{folder}/{table}.parquet'")
    return connection


def canonical(columns: list[str], rows: list[tuple]) -> list[tuple]:
    """Rows with columns in name order, sorted; values must be equal bit for bit."""
    order = sorted(range(len(columns)), key=columns.__getitem__)
    picked = [tuple(row[i] for i in order) for row in rows]
    return sorted(picked, key=lambda row: [(value is None, str(value)) for value in row])


def same(left: object, right: object) -> bool:
    if isinstance(left, float) and isinstance(right, float):
        return left == right or (math.isnan(left) and math.isnan(right))
    return type(left) is type(right) and left == right


def differences(mine: list[tuple], theirs: list[tuple]) -> list[tuple]:
    return [
        (a, b)
        for a, b in zip(mine, theirs, strict=False)
        if not all(same(x, y) for x, y in zip(a, b, strict=False))
    ]


def main() -> None:
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_session(cores=8)
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(folder)
    sql = oracle.oracle_sql()
    failed = []
    for name, query in registry.queries().items():
        if sys.argv[2:] and name not in sys.argv[2:]:
            continue
        started = time.time()
        frame = query(spark, folder)
        mine = canonical(frame.columns, [tuple(row) for row in frame.collect()])
        spent = time.time() - started
        if name not in sql:
            print(f"----  {name}: {len(mine)} rows, no SQL, {spent:.2f}s")
            continue
        try:
            result = connection.execute(sql[name])
        except duckdb.Error as error:
            print(f"FAIL  {name}: {error}")
            failed.append(name)
            continue
        columns = [column[0] for column in result.description]
        theirs = canonical(columns, result.fetchall())
        wrong = differences(mine, theirs)
        good = sorted(columns) == sorted(frame.columns) and len(mine) == len(theirs) and not wrong
        print(f"{'ok  ' if good else 'FAIL'}  {name}: {len(mine)} rows, {spent:.2f}s", flush=True)
        if not good:
            failed.append(name)
            print("      columns", sorted(frame.columns), sorted(columns))
            print("      rows", len(mine), len(theirs), "different", len(wrong))
            for a, b in wrong[:3]:
                print("      spark", a, "\n      sql  ", b)
    print("failed:", failed)


if __name__ == "__main__":
    main()
