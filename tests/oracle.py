"""Compare a query with its SQL: column names, types, and rows as a multiset."""

from __future__ import annotations

import collections
import datetime as dt
import decimal
import math

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


def connect(folder: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def _plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 9)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    if isinstance(v, decimal.Decimal):
        return format(v.normalize(), "f")
    if isinstance(v, (bytes, bytearray)):
        return bytes(v)
    if isinstance(v, (list, tuple)):
        return tuple(_plain(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _plain(x)) for k, x in v.items()))
    return v


_FAMILY = {"bigint": "BIGINT", "int": "INTEGER", "smallint": "SMALLINT", "tinyint": "TINYINT", "string": "VARCHAR",
           "double": "DOUBLE", "float": "FLOAT", "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP",
           "timestamp": "TIMESTAMP", "date": "DATE", "binary": "BLOB"}


def differences(df, con, sql: str) -> list[str]:
    relation = con.execute(sql)
    names = [d[0] for d in relation.description]
    types = dict(zip(names, [str(t) for t in con.sql(sql).types]))
    rows = relation.fetchall()
    found = []
    if sorted(names) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} != {sorted(names)}"]
    for f in df.schema:
        want = _FAMILY.get(f.dataType.simpleString(), f.dataType.simpleString().upper())
        have = types[f.name]
        if want != have:
            found.append(f"type of {f.name}: {want} != {have}")
    order = sorted(names)
    mine = collections.Counter(tuple(_plain(r[c]) for c in order) for r in df.collect())
    at = [names.index(c) for c in order]
    theirs = collections.Counter(tuple(_plain(r[i]) for i in at) for r in rows)
    if mine != theirs:
        found.append(f"rows {sum(mine.values())} / {sum(theirs.values())}; only here {list((mine - theirs).items())[:2]}; "
                     f"only in SQL {list((theirs - mine).items())[:2]}")
    return found
