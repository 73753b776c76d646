"""Run queries on Spark and their SQL on DuckDB, and compare the results row by row.

``python -m tests.compare [scale] [query ...]`` prints one line per query.
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

DATA = Path("/root/testdata")


def connect(sf_dir: Path) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for file in sorted(sf_dir.glob("*.parquet")):
        con.execute(f"create view {file.stem} as select * from read_parquet('{file}')")
    return con


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    return value


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return sorted(names), sorted(plain, key=lambda r: [(v is None, str(v)) for v in r])


def spark_rows(df):
    return _rows(df.columns, df.collect())


def sql_rows(con, sql):
    result = con.execute(sql)
    return _rows([d[0] for d in result.description], result.fetchall())


def difference(df, con, sql) -> str | None:
    """None if equal, else what differs first."""
    (names, got), (want_names, want) = spark_rows(df), sql_rows(con, sql)
    if names != want_names:
        return f"columns {names} against {want_names}"
    if len(got) != len(want):
        return f"{len(got)} rows against {len(want)}"
    for a, b in zip(got, want):
        if a != b or [type(x) for x in a] != [type(x) for x in b]:
            return f"row {a} against {b}"
    return None


def main() -> int:
    sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
    import __spark_entry__ as entry
    from hazeline.session import local_session

    sf_dir = DATA / (sys.argv[1] if len(sys.argv) > 1 else "sf0.01")
    chosen = sys.argv[2:] or list(entry.oracle_sql())
    spark, con = local_session(), connect(sf_dir)
    sql, bad = entry.oracle_sql(), 0
    for name in chosen:
        start = time.time()
        try:
            df = entry.queries()[name](spark, str(sf_dir))
            found = difference(df, con, sql[name]) if name in sql else f"no SQL, {df.count()} rows"
        except Exception as error:
            found = f"{type(error).__name__}: {str(error)[:600]}"
        bad += found is not None
        mark, took = "ok  " if found is None else "DIFF", time.time() - start
        print(f"{mark} {name} {took:.1f}s {found or ''}", flush=True)
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main())
