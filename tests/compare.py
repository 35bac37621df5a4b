"""Compare a Spark result with a DuckDB result: types, rows, values."""

from __future__ import annotations

import datetime as dt
import math
from collections import Counter

import duckdb

BASE = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
        "conversations").split()
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE",
         "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN"}


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in BASE:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _cell(v):
    if isinstance(v, float):
        return None if math.isnan(v) else v + 0.0
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    return v


def difference(spark_df, con, sql: str) -> str | None:
    """None when equal, else what differs."""
    rel = con.sql(sql)
    duck = dict(zip(rel.columns, [str(t) for t in rel.types]))
    ours = {f.name: TYPES.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in spark_df.schema}
    if duck != ours:
        return f"schema: spark only/changed {set(ours.items()) - set(duck.items())}, oracle {set(duck.items()) - set(ours.items())}"
    cols = sorted(ours)
    a = Counter(tuple(_cell(r[c]) for c in cols) for r in spark_df.collect())
    pos = [rel.columns.index(c) for c in cols]
    b = Counter(tuple(_cell(r[i]) for i in pos) for r in rel.fetchall())
    if a == b:
        return None
    return (f"rows {sum(a.values())} vs {sum(b.values())}; columns {cols}; only spark {list((a - b).items())[:4]}; "
            f"only oracle {list((b - a).items())[:4]}")
