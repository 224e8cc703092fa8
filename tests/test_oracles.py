"""Every query with SQL against DuckDB on the same files: columns, rows and values."""

import glob
import math
import os

import duckdb
import pytest

from tidemark.plans import catalogue

SF = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for p in glob.glob(f"{SF}/*.parquet"):
        c.sql(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}'")
    return c


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else v + 0.0
    return list(map(plain, v)) if isinstance(v, list) else v


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted((tuple(plain(r[i]) for i in order) for r in rows), key=str)


@pytest.mark.parametrize("name", sorted(catalogue.ORACLES))
def test_query_equals_sql(spark, duck, name):
    df = catalogue.QUERIES[name](spark, SF)
    rel = duck.sql(catalogue.ORACLES[name])
    assert rows_of(df.columns, df.collect()) == rows_of(rel.columns, rel.fetchall())
    kinds = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string", "DATE": "date", "BOOLEAN": "boolean", "TINYINT": "tinyint", "TIMESTAMP": "timestamp_ntz", "VARCHAR[]": "array<string>"}
    assert dict(df.dtypes) == {c: kinds.get(str(t), str(t)) for c, t in zip(rel.columns, rel.types)}
