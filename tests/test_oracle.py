"""Every registered query against its SQL at the middle scale."""

import pytest

import __spark_entry__ as entry
import oracle

SF = "/root/testdata/sf0.01"
QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SF)


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, con, name):
    assert oracle.compare(con, QUERIES[name](spark, SF), SQL[name]) == []


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_runs(spark, name):
    assert QUERIES[name](spark, "/root/testdata/sf0.001").count() > 0


def test_entry(spark):
    rows = {r["split"]: r for r in entry.entry(spark).collect()}
    assert set(rows) == {"train", "test"}
    assert rows["train"]["n_samples"] > rows["test"]["n_samples"] > 0
