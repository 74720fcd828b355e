"""Every registered query against its SQL, on the smallest test data."""

import os

import pytest
from compare import difference, duckdb_on, types

import __spark_entry__ as registered
from checks.oracle import ORACLE

SF = "/root/testdata/sf0.001"
SAME = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "boolean": "BOOLEAN",
    "date": "DATE", "timestamp_ntz": "TIMESTAMP", "decimal(38,10)": "DECIMAL(38,10)",
}

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not at hand")


@pytest.fixture(scope="module")
def db():
    return duckdb_on(SF)


# The text operators have their own tests.
@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query(spark, db, name):
    ours = registered.queries()[name](spark, SF)
    theirs = db.sql(registered.oracle_sql()[name])
    assert difference(ours, theirs) is None
    for column, (spark_type, duckdb_type) in types(ours, theirs).items():
        assert SAME[spark_type] == duckdb_type, column


def test_entry(spark):
    assert registered.entry(spark).count() > 0
