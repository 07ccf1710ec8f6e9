"""Run a query on Spark and its check on DuckDB, and compare names, types and values."""

from __future__ import annotations

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
TYPES = {
    "string": "VARCHAR",
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "float": "FLOAT",
    "boolean": "BOOLEAN",
    "date": "DATE",
}


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return con


def _key(row):
    return tuple((v is None, str(type(v)), v if v is not None else 0) for v in row)


def differences(df, con, sql: str) -> str | None:
    """None if both sides agree exactly, else what differs."""
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    theirs = cur.fetchall()
    types = {d[0]: str(d[1]) for d in cur.description}
    cols = sorted(df.columns)
    if cols != sorted(names):
        return f"columns {cols} vs {sorted(names)}"
    bad = {n: (t, types[n]) for n, t in df.dtypes if TYPES.get(t) != types[n]}
    if bad:
        return f"types {bad}"
    at = [names.index(n) for n in cols]
    a = sorted((tuple(r) for r in df.select(*[f"`{n}`" for n in cols]).collect()), key=_key)
    b = sorted((tuple(row[i] for i in at) for row in theirs), key=_key)
    if len(a) != len(b):
        return f"{len(a)} rows vs {len(b)}"
    if not a:
        return "no rows on either side"
    diff = [(x, y) for x, y in zip(a, b) if repr(x) != repr(y)]
    return f"{len(diff)} of {len(a)} rows differ in {cols}: {diff[:3]}" if diff else None
