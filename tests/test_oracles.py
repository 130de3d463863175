"""Every registered query that has SQL must give the rows DuckDB gives."""

import pytest
from __spark_entry__ import ENTRY_DIR, entry, oracle_sql, queries
from oracle_check import compare, connect


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


def test_every_oracle_belongs_to_a_query():
    assert set(oracle_sql()) <= set(queries())


def test_entry_is_stable(spark):
    first, second = entry(spark), entry(spark)
    assert first.schema == second.schema
    assert first.collect() == second.collect()
    assert ENTRY_DIR.endswith("sf0.001")


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_matches_sql(spark, sf_dir, duck, name):
    assert compare(queries()[name](spark, sf_dir), duck, oracle_sql()[name]) is None
