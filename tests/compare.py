"""Compare a Spark result with the expected SQL run by DuckDB on the same files."""

from __future__ import annotations

import glob
import math
import os

import duckdb


def database(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


_KINDS = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "date": "DATE",
}


def _cell(value):
    return "null" if value is None or (isinstance(value, float) and math.isnan(value)) else repr(value)


def differences(result, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """Human-readable differences in columns, types and rows; empty when equal."""
    relation = con.sql(sql)
    want_types = dict(zip(relation.columns, map(str, relation.types)))
    have_types = {name: _KINDS.get(kind, kind) for name, kind in result.dtypes}
    if want_types != have_types:
        return [f"schema: spark {sorted(have_types.items())} expected {sorted(want_types.items())}"]
    names = sorted(have_types)
    have = sorted(tuple(_cell(row[n]) for n in names) for row in result.collect())
    at = [relation.columns.index(n) for n in names]
    want = sorted(tuple(_cell(row[i]) for i in at) for row in relation.fetchall())
    if have == want:
        return []
    only_have, only_want = sorted(set(have) - set(want))[:3], sorted(set(want) - set(have))[:3]
    return [f"rows: spark {len(have)} expected {len(want)}", f"columns {names}", f"spark only {only_have}", f"expected only {only_want}"]
