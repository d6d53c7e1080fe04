"""Physical plans of the queries that have to scale."""

import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from helpers import explained, plan_of
from tallyhouse.operators import enrich, marts
from tallyhouse.operators.windows import with_group_sum
from tallyhouse.plans.catalog import QUERIES
from tallyhouse.plans.retail import Retail

DATA = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(DATA).exists(), reason="no test tables")


def final_plan(df):
    df.collect()
    plan = plan_of(df)
    return plan.split("+- == Initial Plan ==")[0]


@pytest.fixture
def large(spark):
    """Plans as they are when no side is small enough to be broadcast."""
    names = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    before = spark.conf.get(names[0])
    for name in names:
        spark.conf.set(name, "-1")
    yield spark
    spark.conf.set(names[0], before)
    spark.conf.unset(names[1])


def test_no_join_forces_a_broadcast(large):
    for name in ("salesperson_incentive", "customer_month_mart", "enrich_sales", "window_sum_customer"):
        plan = plan_of(QUERIES[name](large, DATA))
        assert "Broadcast" not in plan and "Cartesian" not in plan, name


def test_small_dimensions_are_broadcast_by_size(spark):
    assert "SortMergeJoin" not in plan_of(QUERIES["enrich_sales"](spark, DATA))


def test_flagship_scans_the_facts_once(spark):
    plan = final_plan(QUERIES["salesperson_incentive"](spark, DATA))
    assert "ReusedExchange" in plan
    assert len(re.findall(r"FileScan parquet \[l_orderkey", plan)) == 1
    assert "Window" not in plan


def test_flagship_reads_the_needed_columns_only(spark):
    plan = plan_of(QUERIES["salesperson_incentive"](spark, DATA))
    scan = next(line for line in plan.splitlines() if "FileScan parquet [l_orderkey" in line)
    assert "ReadSchema: struct<l_orderkey:bigint,l_suppkey:bigint,l_extendedprice:double,l_shipdate" in scan
    assert "IsNotNull(l_orderkey)" in scan


def test_totals_combine_before_the_shuffle(large):
    sales = Retail(large, DATA).sales(store=False, product=False)
    plan = plan_of(marts.customer_month_total(sales))
    lines = [line for line in plan.splitlines() if "HashAggregate" in line or "Exchange" in line]
    assert "partial_sum" not in lines[0] and "Exchange" in lines[1] and "partial_sum" in lines[2]


def test_ranks_and_segments_scan_the_facts_once(spark):
    """The facts are totalled into a kept table; what is left to run reads only that."""
    for name in ("salesperson_rank", "customer_spend_segment"):
        assert "l_orderkey" not in plan_of(QUERIES[name](spark, DATA)), name


def test_group_sums_compute_their_rows_once(spark):
    for name in ("window_sum_customer", "window_sum_salesperson"):
        plan = plan_of(QUERIES[name](spark, DATA))
        assert "l_orderkey" not in plan, name
        assert len(re.findall("FileScan", plan)) == 2, name  # of the kept rows


def test_customer_rows_check_every_key(spark):
    plan = plan_of(QUERIES["customer_rows"](spark, DATA))
    assert all(f"{key}#" in plan for key in ("n_nationkey", "s_suppkey", "c_custkey"))


def test_one_month_is_read_back_by_its_partitions(spark):
    plan = explained(QUERIES["partitioned_write_prune"](spark, DATA))
    filters = next(x for x in plan.splitlines() if "PartitionFilters" in x)
    assert "sales_month" in filters and "1995-03" in filters


def test_contract_checks_need_no_shuffle(spark):
    for name in ("schema_missing_columns", "schema_extra_columns", "split_by_extension"):
        assert "Exchange" not in plan_of(QUERIES[name](spark, DATA)), name


def test_nothing_runs_row_by_row_in_python(spark):
    """The header reader is the only Python step; no registered mart or join has one."""
    for name in ("salesperson_incentive", "customer_spend_segment", "union_by_name", "synth_sales"):
        plan = plan_of(QUERIES[name](spark, DATA))
        assert "Python" not in plan and "MapInArrow" not in plan, name


@pytest.fixture
def tiny_partitions(large):
    """Lets a test-sized hot key count as a large one."""
    settings = {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    }
    for name, value in settings.items():
        large.conf.set(name, value)
    yield large
    for name in settings:
        large.conf.unset(name)


def hot_sales(spark, count=60_000):
    """A third of the sales belong to customer 7, the rest spread over many."""
    n = F.col("id")
    return spark.range(0, count, 1, 8).select(
        F.when(n % 3 == 0, 7).otherwise(n % 5000).cast("bigint").alias("customer_id"),
        F.lit(1).cast("bigint").alias("store_id"),
        (n % 50).alias("sales_person_id"),
        F.date_add(F.lit("2023-03-01").cast("date"), (n % 28).cast("int")).alias("sales_date"),
        (n % 1000).cast("decimal(18,2)").alias("total_cost"),
    )


def test_a_hot_customer_is_split_in_joins(tiny_partitions):
    spark = tiny_partitions
    customers = spark.range(5000).select(
        F.col("id").alias("customer_id"),
        *[F.lit("x").alias(c) for c in ("first_name", "last_name", "address", "pincode", "phone_number")],
    )
    joined = enrich.join_customer(hot_sales(spark), customers)
    assert "skew=true" in final_plan(joined)
    assert joined.count() == 60_000
    totals = marts.salesperson_month_total(enrich.known_sales(hot_sales(spark), customers=customers))
    assert "skew=true" in final_plan(totals)
    assert totals.agg(F.sum("total_sales")).first()[0] == 60 * sum(range(1000))


def test_a_hot_group_is_split_beside_its_total(tiny_partitions):
    rows = hot_sales(tiny_partitions).select("customer_id", "total_cost")
    found = with_group_sum(rows, ["customer_id"], "total_cost", "total_sales")
    assert "skew=true" in final_plan(found)
    hot = found.where("customer_id = 7").agg(F.min("total_sales"), F.max("total_sales")).first()
    wanted = rows.where("customer_id = 7").agg(F.sum("total_cost")).first()[0]
    assert tuple(hot) == (wanted, wanted)


def test_the_customers_are_joined_to_narrow_sales(large):
    """The staff's texts are not in the shuffle by customer."""
    r = Retail(large, DATA)
    joined = enrich.enrich(r.sales(product=False), r.customers(), r.stores(), r.staff())
    keys = re.findall(r"SortMergeJoin \[(\w+?)#", plan_of(joined))
    assert keys[:3] == ["sales_person_id", "store_id", "customer_id"]
