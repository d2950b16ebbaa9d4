"""Compare every named query with its SQL, run by DuckDB on the same files.

    python -m tests.check_oracle [sf_dir] [name ...]
"""

from __future__ import annotations

import sys
import time
from collections import Counter
from decimal import Decimal

import duckdb

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, (float, Decimal)):
        return round(float(value), 6)
    return value


def _bag(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def differences(spark, con, query, sql: str, sf_dir: str) -> list[str]:
    """Empty if columns and rows agree."""
    df = query(spark, sf_dir)
    found = con.execute(sql)
    names = [d[0] for d in found.description]
    if sorted(names) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} against {sorted(names)}"]
    ours, theirs = _bag(df.columns, df.collect()), _bag(names, found.fetchall())
    if ours == theirs:
        return []
    only_ours, only_theirs = ours - theirs, theirs - ours
    return [
        f"rows {ours.total()} against {theirs.total()}",
        *[f"only Spark: {r}" for r in list(only_ours)[:3]],
        *[f"only SQL:   {r}" for r in list(only_theirs)[:3]],
    ]


def main(sf_dir: str = "/root/testdata/sf0.01", *names: str) -> int:
    from __spark_entry__ import oracle_sql, queries
    from orderflow.session import local_session

    spark, con, sql = local_session(), duck(sf_dir), oracle_sql()
    failed = 0
    for name, query in queries().items():
        if names and name not in names:
            continue
        start = time.time()
        diff = differences(spark, con, query, sql[name], sf_dir) if name in sql else ["no SQL"]
        failed += bool(diff)
        print(f"{'FAIL' if diff else 'ok  '} {name} {time.time() - start:.1f}s", *diff, sep="\n  ")
    return failed


if __name__ == "__main__":
    sys.exit(main(*sys.argv[1:]))
