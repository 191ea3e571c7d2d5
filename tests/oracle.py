"""Compare a Spark DataFrame with DuckDB SQL on the same parquet tables:
column names, row count and the sorted multiset of normalised values."""

from __future__ import annotations

import math

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def norm(v):
    if v is None:
        return "None"
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 9))
    if hasattr(v, "asDict"):
        v = v.asDict()
    if isinstance(v, dict):
        return "{" + ",".join(f"{k}:{norm(x)}" for k, x in sorted(v.items())) + "}"
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(norm(x) for x in v) + "]"
    return str(v)


def rows_of(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(norm(r[i]) for i in order) for r in rows)


TYPE_NAMES = {"INTEGER": "int", "BIGINT": "bigint", "VARCHAR": "string", "DOUBLE": "double", "BOOLEAN": "boolean", "DATE": "date"}


def compare(df, con, sql):
    scols, srows = df.columns, df.collect()
    rel = con.sql(sql)
    dcols, drows = rel.columns, rel.fetchall()
    assert sorted(scols) == sorted(dcols), (scols, dcols)
    stypes = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    dtypes = {c: TYPE_NAMES.get(str(t), str(t)) for c, t in zip(dcols, rel.types)}
    assert stypes == dtypes, {c: (stypes[c], dtypes[c]) for c in stypes if stypes[c] != dtypes.get(c)}
    a, b = rows_of(scols, srows), rows_of(dcols, drows)
    assert len(a) == len(b), (len(a), len(b))
    assert a == b, (sorted(set(a) - set(b))[:3], sorted(set(b) - set(a))[:3])
    return len(a)
