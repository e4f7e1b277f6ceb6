"""Every registered query against its SQL in DuckDB, on whole tables."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_point

SF = "/root/testdata/sf0.001"
from wardlake.oracles import ORACLES  # noqa: E402
from wardlake.registry import QUERIES  # noqa: E402


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in sorted(Path(SF).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    yield connection
    connection.close()


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


SPARK_TO_DUCK = {
    "string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "date": "DATE",
    "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP",
}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    cursor = duck.execute(ORACLES[name])
    types = {column[0]: str(column[1]) for column in cursor.description}
    expected = cursor.fetchall()
    assert {c: SPARK_TO_DUCK[t] for c, t in df.dtypes} == types
    found = [tuple(row) for row in df.select(*[f"`{c}`" for c in types]).collect()]
    assert sorted(map(repr, found)) == sorted(map(repr, expected))


def test_entry(spark):
    df = entry_point.entry(spark)
    assert df.columns == QUERIES["vw_finance_summary"](spark, SF).columns
    assert df.count() == QUERIES["vw_finance_summary"](spark, SF).count() > 0
