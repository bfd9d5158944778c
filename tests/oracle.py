"""Run a registered query and its SQL side by side."""

from __future__ import annotations

import datetime
import glob
import math
import os

import duckdb

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def connect(sf: str):
    con = duckdb.connect()
    for path in glob.glob(f"{sf}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9) + 0.0
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v) for v in value)
    if isinstance(value, dict):
        return tuple(sorted((k, _plain(v)) for k, v in value.items()))
    return value


def _sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    plain = [tuple(_plain(r[i]) for i in order) for r in rows]
    return sorted(plain, key=lambda r: tuple((v is None, str(type(v)), str(v)) for v in r))


_KIND = {
    "string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE",
    "boolean": "BOOLEAN", "timestamp": "TIMESTAMP", "float": "FLOAT", "date": "DATE",
}


def compare(spark_df, con, sql: str) -> int:
    """Assert equal column names, types and rows; returns the row count."""
    answer = con.execute(sql)
    names = [d[0] for d in answer.description]
    kinds = {d[0]: str(d[1]) for d in answer.description}
    expected = _sorted_rows(names, answer.fetchall())
    assert sorted(names) == sorted(spark_df.columns), (sorted(names), sorted(spark_df.columns))
    got_kinds = {f.name: f.dataType.simpleString() for f in spark_df.schema.fields}
    for name in names:
        want = kinds[name]
        if got_kinds[name] in _KIND:
            assert want == _KIND[got_kinds[name]], (name, want, got_kinds[name])
    got = _sorted_rows(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    assert len(got) == len(expected), (len(got), len(expected))
    for i, (g, e) in enumerate(zip(got, expected)):
        assert g == e, (i, g, e)
    return len(got)
