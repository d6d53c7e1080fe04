"""Every query of the library against its SQL on the same tables; tests/llm has the others."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as driver
from tallyhouse.plans.catalog import QUERIES
from tallyhouse.plans.oracle import ORACLES

DATA = "/root/testdata/sf0.001"
TABLES = [p.stem for p in Path(DATA).glob("*.parquet")]

pytestmark = pytest.mark.skipif(not TABLES, reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{DATA}/{name}.parquet'")
    return connection


def _value(value):
    if value is None:
        return None
    if isinstance(value, float):
        return None if value != value else round(value, 6)
    return str(value) if hasattr(value, "isoformat") else value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted(tuple(repr(_value(row[i])) for i in order) for row in rows)


def test_each_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(driver.queries()) and set(ORACLES) <= set(driver.oracle_sql())
    assert set(driver.oracle_sql()) <= set(driver.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    found = driver.queries()[name](spark, DATA)
    wanted = duck.execute(ORACLES[name])
    columns = [c[0] for c in wanted.description]
    assert sorted(found.columns) == sorted(columns)
    assert _rows(found.columns, found.collect()) == _rows(columns, wanted.fetchall())


def test_entry_answers_with_rows(spark):
    flagship = driver.entry(spark)
    assert flagship.columns == [
        "store_id",
        "sales_person_id",
        "full_name",
        "sales_month",
        "total_sales",
        "incentive",
    ]
    assert flagship.limit(1).count() == 1
