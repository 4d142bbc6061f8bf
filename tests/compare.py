"""Compare a Spark result with its oracle in DuckDB: columns by name, rows in any order."""

from __future__ import annotations

import duckdb
import numpy as np
import pandas as pd

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return con


def _normal(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame[sorted(frame.columns)].copy()
    for c in frame.columns:
        if frame[c].map(lambda v: isinstance(v, (list, np.ndarray))).any():
            frame[c] = frame[c].map(str)
    return frame.sort_values(list(frame.columns), na_position="last").reset_index(drop=True)


def differences(got: pd.DataFrame, expected: pd.DataFrame) -> str | None:
    got, expected = _normal(got), _normal(expected)
    if list(got.columns) != list(expected.columns):
        return f"columns {list(got.columns)} != {list(expected.columns)}"
    if len(got) != len(expected):
        return f"rows {len(got)} != {len(expected)}"
    for c in got.columns:
        a, b = got[c], expected[c]
        if str(a.dtype) != str(b.dtype) and not (a.dtype.kind in "OM" and b.dtype.kind in "OM"):
            if not a.isna().all():
                return f"type of {c}: {a.dtype} != {b.dtype}"
        same = (a == b) | (a.isna() & b.isna())
        if not same.all():
            at = int(np.flatnonzero(~same.to_numpy())[0])
            return f"{c}: {int((~same).sum())} differ, first {got.iloc[at].to_dict()} != {expected.iloc[at].to_dict()}"
    return None


#: Spark types and the oracle's types for the same column.
TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP", "date": "DATE",
}


def type_differences(dtypes: list[tuple[str, str]], con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    described = {row[0]: row[1] for row in con.execute(f"describe {sql}").fetchall()}
    return [f"{n}: {t} != {described.get(n)}" for n, t in dtypes if TYPES.get(t, t) != described.get(n)]
