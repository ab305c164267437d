"""Compare every query with its SQL twin: ``python -m checks.compare [sf_dir] [name ...]``."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame, SparkSession


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


def _plain(value):
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v) for v in value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value.hex()
    return value


def _sorted_rows(names: list[str], rows) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(_plain(row[i]) for i in order) for row in rows), key=repr)


def difference(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None if both sides hold the same rows, bit for bit; otherwise what differs first."""
    result = con.execute(sql)
    theirs_names = [column[0] for column in result.description]
    theirs = _sorted_rows(theirs_names, result.fetchall())
    ours = _sorted_rows(df.columns, df.collect())
    if sorted(df.columns) != sorted(theirs_names):
        return f"columns {sorted(df.columns)} against {sorted(theirs_names)}"
    if len(ours) != len(theirs):
        return f"{len(ours)} rows against {len(theirs)}"
    for mine, other in zip(ours, theirs):
        if mine != other:
            return f"{mine} against {other}"
    return None


def main(sf_dir: str, names: list[str]) -> int:
    from checks.oracle import ORACLE
    from checks.queries import QUERIES
    from checks.session import local_session

    spark: SparkSession = local_session("compare")
    con = connect(sf_dir)
    failed = 0
    for name in names or QUERIES:
        start = time.time()
        found = difference(QUERIES[name](spark, sf_dir), con, ORACLE[name])
        failed += found is not None
        print(f"{name:30} {time.time() - start:6.2f}s  {found or 'equal'}", flush=True)
    spark.stop()
    return failed


if __name__ == "__main__":
    sys.exit(main((sys.argv[1:] or ["/root/testdata/sf0.01"])[0], sys.argv[2:]))
