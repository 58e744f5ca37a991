"""Run registered queries next to their SQL in DuckDB and compare all rows."""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

# The tables of the test data.
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return connection


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return repr(value)


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_plain(row[i]) for i in order) for row in rows)


def compare(result, sf_dir: str, sql: str) -> str:
    """Empty if the DataFrame equals the SQL, else the difference."""
    found = rows_of(result.columns, result.collect())
    relation = connect(sf_dir).execute(sql)
    columns = [c[0] for c in relation.description]
    expected = rows_of(columns, relation.fetchall())
    if sorted(columns) != sorted(result.columns):
        return f"columns {sorted(result.columns)} != {sorted(columns)}"
    if found == expected:
        return ""
    lost, extra = list(set(expected) - set(found)), list(set(found) - set(expected))
    return f"{len(found)} rows, expected {len(expected)}; missing {str(lost[:2])[:600]}; extra {str(extra[:2])[:600]}"


if __name__ == "__main__":
    import __spark_entry__ as contract
    from vecloom.session import get_session

    spark = get_session("oracle", "local[8]", {"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("OFF")
    sql = contract.oracle_sql()
    wanted = sys.argv[2:]
    for name, query in contract.queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            outcome = compare(query(spark, sys.argv[1]), sys.argv[1], sql[name])
        except Exception as error:
            outcome = f"ERROR {str(error)[:800]}"
        print(f"{name:28s} {time.time() - start:6.1f}s {outcome or 'equal'}", flush=True)
