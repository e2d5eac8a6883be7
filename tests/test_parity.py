"""Every query with SQL gives the same rows, names and types as DuckDB."""

import __spark_entry__ as entry_points
import parity
import pytest
from cohortloom.plans import catalog, oracle

QUERIES, SQL = catalog.queries(), oracle.oracle_sql()
TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
}


@pytest.fixture(scope="module")
def duck(data):
    return parity.connect(data)


def test_sql_names_known_queries():
    assert set(SQL) <= set(QUERIES)
    assert set(QUERIES) - set(SQL) == {
        "fit_outcome",
        "fit_cpc",
        "score_cohort",
        "train_and_evaluate",
    }


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, data, duck, name):
    df = QUERIES[name](spark, data)
    relation = duck.sql(SQL[name])
    sql_types = dict(zip(relation.columns, map(str, relation.types)))
    assert {c: TYPES[t] for c, t in df.dtypes} == sql_types
    assert parity.difference(df, duck, SQL[name]) is None


def test_entry(spark):
    assert entry_points.entry(spark).count() == 10
