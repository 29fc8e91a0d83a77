"""Compare a Spark result with a DuckDB result, row order aside."""

from __future__ import annotations

import glob
import math
import os

import duckdb

SPARK_TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
}


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        table = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"create view {table} as select * from '{path}'")
    return con


def _normal(value):
    """Values are compared exactly; NaN equals NaN and -0.0 equals 0.0."""
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    return value


def _rows(rows, order):
    picked = [tuple(_normal(r[i]) for i in order) for r in rows]
    return sorted(picked, key=lambda r: tuple((v is not None, str(v)) for v in r))


def differences(df, con, sql: str) -> list[str]:
    """Human-readable differences, empty when the results agree."""
    result = con.execute(sql)
    types = {d[0]: str(d[1]) for d in result.description}
    expected = result.fetchall()
    names = sorted(df.columns)
    if names != sorted(types):
        return [f"columns {names} / {sorted(types)}"]
    found = []
    for field in df.schema:
        want = SPARK_TYPES.get(field.dataType.simpleString(), field.dataType.simpleString())
        if want != types[field.name]:
            found.append(f"type of {field.name}: {want} / {types[field.name]}")
    actual = [tuple(r) for r in df.collect()]
    a = _rows(actual, [df.columns.index(n) for n in names])
    b = _rows(expected, [list(types).index(n) for n in names])
    if len(a) != len(b):
        found.append(f"rows {len(a)} / {len(b)}")
    for x, y in zip(a, b):
        if x != y:
            found.append(f"first difference {dict(zip(names, x))} / {dict(zip(names, y))}")
            break
    return found
