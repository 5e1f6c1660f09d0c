"""Runs a query in Spark and its SQL in DuckDB and compares the two results as multisets."""

from __future__ import annotations

import math

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


_KINDS = {"string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "boolean": "BOOLEAN",
          "timestamp_ntz": "TIMESTAMP"}


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value
    return value


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


def compare(df, con, sql: str) -> list[str]:
    """Empty when names, types and rows agree, else what differs."""
    relation = con.sql(sql)
    problems = []
    spark_types = {f.name: _KINDS.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema}
    duck_types = {n: str(t) for n, t in zip(relation.columns, relation.types)}
    if spark_types != duck_types:
        problems.append(f"types differ: {sorted(set(spark_types.items()) ^ set(duck_types.items()))}")
    ours = _rows(df.columns, [tuple(r) for r in df.collect()])
    theirs = _rows(relation.columns, relation.fetchall())
    if len(ours) != len(theirs):
        problems.append(f"rows: {len(ours)} against {len(theirs)}")
    elif ours != theirs:
        bad = [(a, b) for a, b in zip(ours, theirs) if a != b]
        problems.append(f"{len(bad)} rows differ, first {bad[0]}")
    return problems
