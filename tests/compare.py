"""Run registered queries against their DuckDB oracles.

``python tests/compare.py [sf_dir] [name ...]`` prints one line per query.
"""

from __future__ import annotations

import datetime
import decimal
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

FAMILIES = {
    "bigint": "int", "int": "int", "smallint": "int", "tinyint": "int",
    "BIGINT": "int", "INTEGER": "int", "SMALLINT": "int", "TINYINT": "int",
    "double": "float", "float": "float", "DOUBLE": "float", "FLOAT": "float",
    "string": "text", "VARCHAR": "text", "boolean": "bool", "BOOLEAN": "bool",
    "timestamp_ntz": "time", "TIMESTAMP": "time", "date": "date", "DATE": "date",
}


def database(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def value(cell):
    if isinstance(cell, decimal.Decimal):
        return ("decimal", str(cell))
    if isinstance(cell, float):
        return "nan" if math.isnan(cell) else repr(cell + 0.0)
    if isinstance(cell, datetime.datetime):
        return cell.isoformat()
    return str(cell)


def table_of(names: list[str], rows: list) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(value(row[i]) for i in order) for row in rows)


def compare(spark, con, query, sql: str, sf_dir: str) -> str:
    """Empty when equal, else what differs."""
    df = query(spark, sf_dir)
    ours = [tuple(row) for row in df.collect()]
    result = con.execute(sql)
    names = [column[0] for column in result.description]
    kinds = {c[0]: FAMILIES.get(str(c[1]), str(c[1])) for c in result.description}
    theirs = result.fetchall()
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(set(df.columns) ^ set(names))}"
    for name, kind in df.dtypes:
        if FAMILIES.get(kind, kind) != kinds[name]:
            return f"type of {name}: {kind} against {kinds[name]}"
    left, right = table_of(df.columns, ours), table_of(names, theirs)
    if len(left) != len(right):
        return f"rows {len(left)} against {len(right)}"
    for mine, other in zip(left, right):
        if mine != other:
            return f"{sorted(names)}\n    {mine}\n    {other}"
    return ""


def main() -> None:
    from __spark_entry__ import oracle_sql, queries
    from talkmeter.session import build_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark = build_session(
        master="local[8]",
        **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
           "spark.driver.memory": "8g", "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, sql = database(sf_dir), oracle_sql()
    bad = 0
    for name, query in queries().items():
        if wanted and name not in wanted:
            continue
        began = time.time()
        try:
            if name in sql:
                problem = compare(spark, con, query, sql[name], sf_dir)
                count = f"{len(con.execute(sql[name]).fetchall())} rows " if not problem else ""
            else:
                problem, count = "", f"{query(spark, sf_dir).count()} rows only"
        except Exception as error:  # the report goes on with the next query
            problem, count = f"{type(error).__name__}: {' '.join(str(error).split())[:300]}", ""
        bad += bool(problem)
        print(f"{'BAD' if problem else 'ok '} {name} {time.time() - began:.1f}s {count}{problem}",
              flush=True)
    unknown = sorted(set(sql) - set(queries()))
    print(f"{bad} bad; oracles without a query: {unknown}")


if __name__ == "__main__":
    main()
