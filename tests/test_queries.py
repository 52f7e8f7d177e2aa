"""Every registered query against its SQL on the smallest tables."""

import datetime
import glob
import os

import duckdb
import pytest

from wheelpace.checks.oracles import oracles
from wheelpace.checks.queries import queries

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def plain(value):
    if isinstance(value, float):
        return round(value, 9) + 0.0
    return value.replace(tzinfo=None) if isinstance(value, datetime.datetime) else value


def test_every_oracle_has_a_query():
    assert set(oracles()) == set(queries())


@pytest.mark.parametrize("name", sorted(queries()))
def test_query(spark, duck, name):
    df = queries()[name](spark, SF_DIR)
    names = sorted(df.columns)
    rows = sorted((tuple(plain(r[c]) for c in names) for r in df.collect()), key=repr)
    assert rows
    if name in oracles():
        found = duck.execute(oracles()[name])
        columns = [c[0] for c in found.description]
        assert sorted(columns) == names
        at = [columns.index(c) for c in names]
        assert rows == sorted((tuple(plain(r[i]) for i in at) for r in found.fetchall()), key=repr)
