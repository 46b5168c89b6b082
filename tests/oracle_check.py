"""Compare queries with their oracle SQL. As a script: python tests/oracle_check.py <sf_dir> [name ...]"""

from __future__ import annotations

import sys
import time
from decimal import Decimal
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def oracle_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def _value(value):
    if isinstance(value, Decimal):
        return format(value.normalize(), "f")
    return repr(value)


def _rows(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_value(r[i]) for i in order) for r in rows)


def difference(df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None when rows, column names and values agree exactly, else what differs first."""
    oracle = con.execute(sql)
    names = [c[0] for c in oracle.description]
    expected = _rows(names, oracle.fetchall())
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    found = _rows(df.columns, df.collect())
    if len(found) != len(expected):
        return f"{len(found)} rows != {len(expected)}; e.g. {sorted(set(found) ^ set(expected))[:3]}"
    for ours, theirs in zip(found, expected, strict=True):
        if ours != theirs:
            return f"{sorted(df.columns)}\n  spark  {ours}\n  oracle {theirs}"
    return None


def main() -> None:
    import __spark_entry__ as entry
    from ledgerspark.session import build_session

    sf_dir, only = sys.argv[1], sys.argv[2:]
    conf = {"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false"}
    spark = build_session("check", "local[8]", **conf)
    spark.sparkContext.setLogLevel("ERROR")
    con, sqls = oracle_connection(sf_dir), entry.oracle_sql()
    failed = 0
    for name, build in entry.queries().items():
        if only and name not in only:
            continue
        start = time.time()
        try:
            df = build(spark, sf_dir)
            if name in sqls:
                problem = difference(df, con, sqls[name])
            else:
                problem = None if df.count() else "no rows"
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        failed += problem is not None
        print(f"{'FAIL' if problem else 'ok  '} {name} {time.time() - start:.2f}s {problem or ''}", flush=True)
    print("failed:", failed)


if __name__ == "__main__":
    main()
