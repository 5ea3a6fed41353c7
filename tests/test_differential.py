"""Every registered query against its SQL in DuckDB over the same files."""

import math
import os

import duckdb
import pytest

from carledger.plans.oracles import ORACLES
from carledger.plans.queries import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return con


TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "float": "FLOAT", "date": "DATE"}


def _key(row):
    return tuple((v is None, "" if v is None else str(v)) for v in row)


def _value(v):
    return "NaN" if isinstance(v, float) and math.isnan(v) else v


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_sql(spark, duck, name):
    got = QUERIES[name](spark, SF_DIR)
    columns = sorted(got.columns)
    cursor = duck.execute(ORACLES[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    types = {d[0]: str(d[1]) for d in cursor.description}
    assert {c: TYPES[t] for c, t in got.dtypes} == types
    want = cursor.fetchall()
    picked = [names.index(c) for c in columns]
    want = sorted((tuple(_value(r[i]) for i in picked) for r in want), key=_key)
    have = sorted((tuple(_value(v) for v in r) for r in got.select(*columns).collect()), key=_key)
    assert len(have) == len(want)
    assert have == want
