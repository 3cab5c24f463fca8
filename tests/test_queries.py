"""Every registered query against its SQL, strictly: column names, row count and values."""

import duckdb
import pytest

import __spark_entry__ as contract

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()
QUERIES = contract.queries()
ORACLES = contract.oracle_sql()


@pytest.fixture(scope="module")
def duck(data_dir):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{data_dir}/{name}.parquet'")
    yield connection
    connection.close()


def rows_of(arrow):
    names = sorted(arrow.column_names)
    rows = [tuple(r[n] for n in names) for r in arrow.select(names).to_pylist()]
    return names, sorted(rows, key=lambda r: [(v is None, str(v)) for v in r])


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_gives_what_its_sql_gives(spark, duck, data_dir, name):
    got_names, got = rows_of(QUERIES[name](spark, data_dir).toArrow())
    want_names, want = rows_of(duck.execute(ORACLES[name]).to_arrow_table())
    assert got_names == want_names
    assert len(got) == len(want) > 0
    assert got == want


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_without_sql_gives_rows(spark, data_dir, name):
    assert QUERIES[name](spark, data_dir).count() > 0


def test_every_statement_belongs_to_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry_has_rows(spark):
    assert contract.entry(spark).count() > 0
