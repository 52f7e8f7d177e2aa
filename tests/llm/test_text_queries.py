"""Every registered text query runs; where SQL can state it, DuckDB gives the same rows."""

import duckdb
import pytest

from wheelpace.llm.queries import oracles, queries

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(oracles()))
def test_query_equals_sql(spark, name):
    with duckdb.connect() as db:
        for table in ("documents", "benchmark", "pages", "embeddings", "conversations"):
            db.execute(f"create view {table} as select * from '{SF_DIR}/{table}.parquet'")
        found = db.execute(oracles()[name])
        columns = [c[0] for c in found.description]
        want = sorted(map(repr, found.fetchall()))
    df = queries()[name](spark, SF_DIR)
    assert sorted(df.columns) == sorted(columns)
    assert sorted(repr(tuple(r)) for r in df.select(*columns).collect()) == want


@pytest.mark.parametrize("name", sorted(set(queries()) - set(oracles())))
def test_query_runs(spark, name):
    assert queries()[name](spark, SF_DIR).count() > 0
