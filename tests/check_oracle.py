"""Compare queries with their SQL: python tests/check_oracle.py FOLDER [name ...]"""

from __future__ import annotations

import sys
import time
from datetime import date, datetime
from decimal import Decimal
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from pyspark.sql import DataFrame  # noqa: E402

TABLES = "region nation customer supplier part orders lineitem documents embeddings conversations labels pages benchmark".split()


def _plain(value):
    if isinstance(value, Decimal):
        return format(value, "f")
    if isinstance(value, (date, datetime)):
        return value.isoformat()
    if isinstance(value, float):
        return repr(round(value, 6))
    return value


def _sorted_rows(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return sorted(plain, key=lambda row: tuple((v is None, str(v)) for v in row))


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


_KINDS = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "date": "DATE", "double": "DOUBLE", "timestamp_ntz": "TIMESTAMP"}


def difference(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None when rows, names and types agree, else what differs."""
    mine = _sorted_rows(df.columns, df.collect())
    answer = con.execute(sql)
    names = [d[0] for d in answer.description]
    theirs = _sorted_rows(names, answer.fetchall())
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} and {sorted(names)}"
    kinds = {n: _KINDS.get(t, t.upper()) for n, t in df.dtypes}
    other = {d[0]: str(d[1]) for d in answer.description}
    odd = {n: (kinds[n], other[n]) for n in names if kinds[n] != other[n]}
    if odd:
        return f"types {odd}"
    if len(mine) != len(theirs):
        return f"{len(mine)} rows and {len(theirs)}"
    if mine != theirs:
        return "first difference " + str(next((a, b) for a, b in zip(mine, theirs) if a != b))
    return None


def main() -> None:
    from __spark_entry__ import oracle_sql, queries

    from brokerhouse.session import build_session

    folder, chosen = sys.argv[1], sys.argv[2:]
    spark = build_session("check", "local[8]", spark__sql__shuffle__partitions="8", spark__driver__memory="8g")
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    sqls = oracle_sql()
    for name, query in queries().items():
        if chosen and name not in chosen:
            continue
        start = time.time()
        try:
            found = difference(query(spark, folder), con, sqls[name])
        except Exception as error:  # report and go on to the next query
            found = f"{type(error).__name__} {str(error)[:600]}"
        print(f"{'ok  ' if found is None else 'DIFF'} {name} {time.time() - start:.1f}s {found or ''}", flush=True)


if __name__ == "__main__":
    main()
