"""Compare a Spark result with DuckDB's answer to the equal SQL."""

import math
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()
# Spark's name of a type, by DuckDB's.
TYPES = {
    "VARCHAR": "string",
    "BIGINT": "bigint",
    "INTEGER": "int",
    "DOUBLE": "double",
    "BOOLEAN": "boolean",
    "TIMESTAMP": "timestamp_ntz",
    "DATE": "date",
}


def connect(sf_dir):
    connection = duckdb.connect()
    for name in TABLES:
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return connection


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 6)
    return value


def compare(result, connection, sql):
    """None when names, types and rows agree, else what differs first."""
    names = sorted(result.columns)
    relation = connection.sql(sql)
    if sorted(relation.columns) != names:
        return f"columns: {names} instead of {sorted(relation.columns)}"
    kinds = dict(result.dtypes)
    wanted = {c: TYPES.get(str(t), str(t)) for c, t in zip(relation.columns, relation.types, strict=True)}
    if kinds != wanted:
        return f"types: {kinds} instead of {wanted}"
    ours = Counter(tuple(_plain(v) for v in row) for row in result.select(*names).collect())
    order = [relation.columns.index(c) for c in names]
    theirs = Counter(tuple(_plain(row[i]) for i in order) for row in relation.fetchall())
    if ours != theirs:
        extra, lacking = ours - theirs, theirs - ours
        return f"rows: {sum(extra.values())} extra {list(extra)[:3]}, {sum(lacking.values())} missing {list(lacking)[:3]}"
    if not ours:
        return "no rows at all"
    return None
