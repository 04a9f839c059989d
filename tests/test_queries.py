"""Every query of the package against its SQL on DuckDB."""

import duckdb
import pytest

from loomtext.plans.oracles import SQL
from loomtext.plans.queries import QUERIES

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def rows(columns, table):
    return sorted(map(repr, zip(*(table[c] for c in sorted(columns)))))


@pytest.fixture(scope="module")
def duck(data):
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{data}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, data, duck, name):
    got = QUERIES[name](spark, data).toArrow()
    want = duck.sql(SQL[name]).to_arrow_table()
    assert sorted(got.column_names) == sorted(want.column_names)
    assert rows(got.column_names, got.to_pydict()) == rows(want.column_names, want.to_pydict())


def test_entry_and_registry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
