"""Every query that has SQL gives the rows of its SQL, on the driver's smallest tables."""

import os

import duckdb
import pytest

from frameloom.plans import registry

DATA = "/root/testdata/sf0.001"
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="the driver's tables are not here")
KINDS = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string", "BOOLEAN": "boolean"}


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return con


def ordered(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: tuple((x is None, str(x)) for x in r))


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_matches_sql(spark, sql, name):
    got, want = registry.queries()[name](spark, DATA), sql.sql(registry.oracle_sql()[name])
    columns = sorted(got.columns)
    assert sorted(want.columns) == columns
    rows = ordered(got.select(*columns).collect())
    at = [want.columns.index(c) for c in columns]
    assert rows == ordered([r[i] for i in at] for r in want.fetchall())
    assert rows


@pytest.mark.parametrize("name", sorted(set(registry.queries()) - set(registry.oracle_sql()) - {"colour_kmeans"}))
def test_other_queries_run(spark, name):
    assert registry.queries()[name](spark, DATA).count() > 0
