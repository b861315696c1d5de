"""Run a query and its SQL over the same tables and compare the rows."""

from __future__ import annotations

from collections import Counter
from pathlib import Path

import duckdb


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in Path(folder).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def spark_rows(df) -> tuple[list[str], Counter]:
    names = sorted(df.columns)
    return names, Counter(tuple(row) for row in df.select(*names).collect())


def sql_rows(con: duckdb.DuckDBPyConnection, sql: str) -> tuple[list[str], Counter]:
    result = con.execute(sql)
    columns = [c[0] for c in result.description]
    names = sorted(columns)
    places = [columns.index(n) for n in names]
    return names, Counter(tuple(row[p] for p in places) for row in result.fetchall())


def difference(df, con, sql) -> str | None:
    """None when equal, otherwise a short description."""
    names, got = spark_rows(df)
    want_names, want = sql_rows(con, sql)
    if names != want_names:
        return f"columns {names} != {want_names}"
    if got == want:
        return None
    extra, missing = got - want, want - got
    return (
        f"{sum(got.values())} rows against {sum(want.values())}; "
        f"extra {list(extra.items())[:3]}; missing {list(missing.items())[:3]}"
    )
