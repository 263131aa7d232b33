"""Order-insensitive comparison of a Spark result with DuckDB SQL."""

from __future__ import annotations

import datetime as dt
import math

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return float(f"{v:.12g}")
    if isinstance(v, (bytes, bytearray, memoryview)):
        return bytes(v).hex()
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    if hasattr(v, "asDict"):
        return _norm(v.asDict())
    return v


def canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return [cols[i] for i in order], sorted(out, key=repr)


def compare(df, con, sql: str):
    s_cols = df.columns
    s_rows = [tuple(r) for r in df.collect()]
    res = con.execute(sql)
    d_cols = [c[0] for c in res.description]
    d_rows = res.fetchall()
    sc, sr = canon(s_cols, s_rows)
    dc, dr = canon(d_cols, d_rows)
    problems = []
    if sc != dc:
        problems.append(f"columns {sc} != {dc}")
    if len(sr) != len(dr):
        problems.append(f"rows {len(sr)} != {len(dr)}")
    elif sr != dr:
        diff = [(a, b) for a, b in zip(sr, dr) if a != b][:3]
        problems.append(f"values differ, e.g. {diff}")
    return problems, len(sr)


SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE",
                 "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP", "binary": "BLOB"}


def type_problems(df, con, sql: str):
    st = {f.name: SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema.fields}
    dt = {r[0]: r[1] for r in con.execute("DESCRIBE " + sql).fetchall()}
    return {k: (st.get(k), dt.get(k)) for k in set(st) | set(dt) if st.get(k) != dt.get(k)}
