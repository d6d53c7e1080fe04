"""Parquet datasets, versions, and the JDBC calls."""

from datetime import date
from decimal import Decimal
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from helpers import explained, golden_sales, rows_of
from tallyhouse.functions.calendar import month_label
from tallyhouse.sinks import jdbc as jdbc_sink
from tallyhouse.sinks import parquet
from tallyhouse.sources import dimensions, jdbc, typed
from tallyhouse.schemas import FACT, MONEY


def monthly(spark):
    return golden_sales(spark).withColumn("sales_month", month_label(F.col("sales_date")))


def test_overwrite_replaces_all(spark, tmp_path):
    path = str(tmp_path / "out")
    parquet.overwrite(golden_sales(spark), path)
    parquet.overwrite(golden_sales(spark).where("store_id = 122"), path)
    assert spark.read.parquet(path).count() == 2


def test_partitions_are_replaced_one_by_one(spark, tmp_path):
    path = str(tmp_path / "out")
    keys = ["sales_month", "store_id"]
    parquet.overwrite_partitions(monthly(spark), path, keys)
    before = rows_of(spark.read.parquet(path), "sales_month", "total_cost")
    parquet.overwrite_partitions(monthly(spark), path, keys)
    assert rows_of(spark.read.parquet(path), "sales_month", "total_cost") == before
    april = monthly(spark).where("sales_month = '2023-04'")
    doubled = april.withColumn("total_cost", (F.col("total_cost") * 2).cast(MONEY))
    parquet.overwrite_partitions(doubled, path, keys)
    after = spark.read.parquet(path)
    assert after.count() == 9
    assert rows_of(after.where("sales_month = '2023-04'"), "total_cost") == [(Decimal("9.00"),)]


def test_reading_one_month_prunes_the_others(spark, tmp_path):
    path = str(tmp_path / "out")
    parquet.overwrite_partitions(monthly(spark), path, ["sales_month", "store_id"])
    one = spark.read.parquet(path).where("sales_month = '2023-04'").select("total_cost")
    assert one.count() == 1
    plan = explained(one)
    filters = next(x for x in plan.splitlines() if "PartitionFilters" in x)
    assert "sales_month" in filters and "2023-04" in filters
    assert "ReadSchema: struct<total_cost:decimal" in plan


def test_the_latest_version_is_read_with_its_own_columns(spark, tmp_path):
    base = str(tmp_path / "published")
    sales = monthly(spark)
    old = parquet.publish(sales.drop("total_cost"), base, epoch_ms=999)
    new = parquet.publish(sales, base, ["sales_month"])
    assert old == 999 and new > old
    latest = parquet.latest(spark, base)
    assert latest.count() == 9 and set(latest.columns) == set(sales.columns)


def test_json_rows_are_typed(spark, tmp_path):
    path = tmp_path / "sales.json"
    path.write_text(
        '{"customer_id": 1, "sales_date": "2023-03-03", "total_cost": 10.5}\n'
        '{"customer_id": "x", "total_cost": 1}\n'
    )
    rows = typed.json_rows(spark, str(path), FACT)
    assert rows_of(rows, "customer_id", "sales_date", "total_cost") == [
        (None, None, Decimal("1.00")),
        (1, date(2023, 3, 3), Decimal("10.50")),
    ]


# No database runs here: these tests check what Spark is asked to do.

DATABASE = jdbc.Database("jdbc:mysql://db/sales", {"user": "reader"})


def test_jdbc_scan_asks_for_split_reads():
    calls = []
    reader = SimpleNamespace(jdbc=lambda *args, **options: calls.append((args, options)))
    session = SimpleNamespace(read=reader)
    jdbc.scan(session, DATABASE, "store")
    jdbc.scan(session, DATABASE, "customer", jdbc.Split("customer_id", 1, 1000, 16))
    assert calls == [
        (("jdbc:mysql://db/sales", "store"), {"properties": {"user": "reader"}}),
        (
            ("jdbc:mysql://db/sales", "customer"),
            {
                "column": "customer_id",
                "lowerBound": 1,
                "upperBound": 1000,
                "numPartitions": 16,
                "properties": {"user": "reader"},
            },
        ),
    ]


def test_jdbc_bounds_come_from_the_database():
    asked = []

    def read(url, table, properties):
        asked.append(table)
        return SimpleNamespace(first=lambda: {"least": 5, "most": 900})

    session = SimpleNamespace(read=SimpleNamespace(jdbc=read))
    cut = jdbc.split_by(session, DATABASE, "customer", "customer_id", 16)
    assert cut == jdbc.Split("customer_id", 5, 900, 16)
    assert asked == ["(SELECT min(customer_id) AS least, max(customer_id) AS most FROM customer) AS bounds"]


@pytest.mark.parametrize("products", [False, True])
def test_the_customer_table_is_always_read_in_parts(monkeypatch, products):
    read = {}
    monkeypatch.setattr(dimensions, "split_by", lambda *given: jdbc.Split(given[3], 1, 9, given[4]))
    monkeypatch.setattr(dimensions, "scan", lambda _, __, table, cut: read.setdefault(table, cut))
    monkeypatch.setattr(dimensions.scratch, "keep", lambda frame, table: frame)
    found = dimensions.Dimensions.from_database(None, DATABASE, products=products)
    assert found.customers == jdbc.Split("customer_id", 1, 9, 16)
    assert ("product" in read) == products


@pytest.mark.parametrize("save, mode", [(jdbc_sink.append, "append"), (jdbc_sink.replace, "overwrite")])
def test_jdbc_write_rounds_money_and_raises(spark, monkeypatch, save, mode):
    written = {}

    class Writer:
        def __init__(self, df):
            self.df = df

        def option(self, name, value):
            written[name] = value
            return self

        def jdbc(self, url, table, mode, properties):
            written.update(url=url, table=table, mode=mode, rows=rows_of(self.df))
            raise RuntimeError("no such table")

    mart = spark.createDataFrame(
        [(1, Decimal("104.555"))], "store_id int, total_sales decimal(10,3)"
    )
    monkeypatch.setattr(type(mart), "write", property(Writer))
    with pytest.raises(RuntimeError, match="no such table"):
        save(mart, DATABASE, "sales_team_data_mart", connections=3)
    assert written["mode"] == mode and written["numPartitions"] == 3
    assert written.get("truncate", False) == (mode == "overwrite")
    assert written["rows"] == [(1, Decimal("104.56"))]
