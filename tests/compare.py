"""Runs registered queries next to their SQL and compares the rows."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def database(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def plain(value):
    if value is None or isinstance(value, (bool, str)):
        return value
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9) + 0.0
    if hasattr(value, "as_integer_ratio"):
        return int(value) if int(value) == value else round(float(value), 9)
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(row[i]) for i in order) for row in rows), key=repr)


def compare(spark, con, build, sql, sf_dir):
    """Empty text if both sides agree, else what differs."""
    df = build(spark, sf_dir)
    left = rows_of(df.columns, [tuple(row) for row in df.collect()])
    found = con.execute(sql)
    names = [column[0] for column in found.description]
    right = rows_of(names, found.fetchall())
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} / {sorted(names)}"
    if len(left) != len(right):
        return f"rows {len(left)} / {len(right)}"
    for a, b in zip(left, right):
        if a != b:
            return f"{sorted(names)}\n  spark {str(a)[:600]}\n  sql   {str(b)[:600]}"
    return "" if left else "no rows"


if __name__ == "__main__":
    sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
    import __spark_entry__ as entry
    from tests.session import spark_session

    sf_dir = f"/root/testdata/{sys.argv[1]}"
    wanted = sys.argv[2:] or list(entry.queries())
    spark, con = spark_session(), database(sf_dir)
    for name in wanted:
        start = time.time()
        try:
            result = compare(spark, con, entry.queries()[name], entry.oracle_sql()[name], sf_dir)
        except Exception as error:
            result = f"{type(error).__name__}: {str(error)[:900]}"
        print(f"{'ok  ' if not result else 'DIFF'} {name} {time.time() - start:.1f}s {result}", flush=True)
