"""Compare a query with its SQL twin, row by row."""

import math
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

# Spark type -> SQL type
TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "string": "VARCHAR",
    "double": "DOUBLE",
    "float": "FLOAT",
    "boolean": "BOOLEAN",
}


def connect(folder):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{folder}/{t}.parquet'")
    return con


def _cell(x):
    if isinstance(x, float):
        return "nan" if math.isnan(x) else repr(x + 0.0)
    return x


def differences(df, con, sql, limit=3):
    """Empty list when columns, types and rows agree."""
    rel = con.sql(sql)
    names = sorted(df.columns)
    if names != sorted(rel.columns):
        return [f"columns {names} != {sorted(rel.columns)}"]
    ours = dict(df.dtypes)
    theirs = dict(zip(rel.columns, map(str, rel.types)))
    bad = [
        f"type of {n}: {ours[n]} != {theirs[n]}"
        for n in names
        if TYPES.get(ours[n], ours[n]) != theirs[n]
    ]
    quoted = ", ".join(f'"{n}"' for n in names)
    expected = Counter(
        tuple(_cell(x) for x in r) for r in rel.select(quoted).fetchall()
    )
    got = Counter(
        tuple(_cell(r[n]) for n in names) for r in df.select(*[f"`{n}`" for n in names]).collect()
    )
    if got != expected:
        extra, missing = got - expected, expected - got
        bad.append(
            f"rows {sum(got.values())} != {sum(expected.values())} or values differ: "
            f"extra {str(list(extra)[:limit])[:600]}, missing {str(list(missing)[:limit])[:600]}"
        )
    return bad
