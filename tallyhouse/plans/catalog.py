"""The registered queries, each over the whole of its tables; those of the load are in ``flows``."""

from pyspark.sql import DataFrame, functions as F, types as T

from tallyhouse import scratch
from tallyhouse.functions import calendar, text
from tallyhouse.operators import (
    contract,
    drift,
    enrich,
    ledger,
    marts,
    quality,
    synth,
    windows,
)
from tallyhouse.plans import flows  # noqa: F401  (registers its queries)
from tallyhouse.plans.registry import QUERIES, query  # noqa: F401
from tallyhouse.plans.retail import Retail
from tallyhouse.schemas import CONTRACT, FACT_COLUMNS
from tallyhouse.sinks import parquet
from tallyhouse.sources import landing, typed

READ_BACK_MONTH = "1995-03"


# Marts


@query
def salesperson_incentive(r: Retail) -> DataFrame:
    return marts.sales_team_mart(r.sales(product=False), *_dimensions(r))


@query
def customer_month_mart(r: Retail) -> DataFrame:
    return marts.customer_mart(r.sales(product=False), r.customers(), r.stores(), r.staff())


@query
def salesperson_month_total(r: Retail) -> DataFrame:
    return marts.salesperson_month_total(_known_sales(r))


@query
def salesperson_rank(r: Retail) -> DataFrame:
    return marts.salesperson_rank(marts.salesperson_month_total(_known_sales(r)))


@query
def top_performer(r: Retail) -> DataFrame:
    return marts.top_performer(marts.salesperson_month_total(_known_sales(r)))


def _known_sales(r: Retail) -> DataFrame:
    return enrich.known_sales(r.sales(product=False), *_dimensions(r))


def _customer_totals(r: Retail) -> DataFrame:
    return marts.customer_month_total(_known_sales(r))


@query
def customer_spend_trend(r: Retail) -> DataFrame:
    return marts.customer_spend_trend(_customer_totals(r))


@query
def customer_spend_segment(r: Retail) -> DataFrame:
    return marts.customer_spend_segment(_customer_totals(r))


@query
def window_sum_customer(r: Retail) -> DataFrame:
    rows = r.sales(store=False, product=False).select(
        "customer_id",
        calendar.month_start(F.col("sales_date")).alias("sales_date_month"),
        "total_cost",
    )
    return windows.with_group_sum(
        rows, ["customer_id", "sales_date_month"], "total_cost", "total_sales"
    )


@query
def window_sum_salesperson(r: Retail) -> DataFrame:
    rows = r.sales(product=False).select(
        "store_id",
        "sales_person_id",
        calendar.month_start(F.col("sales_date")).alias("sales_month"),
        "total_cost",
    )
    return windows.with_group_sum(
        rows, ["store_id", "sales_person_id", "sales_month"], "total_cost", "total_sales"
    )


@query
def distinct_rows(r: Retail) -> DataFrame:
    return r.sales(product=False).select("customer_id", "store_id").distinct()


# Joins


@query
def join_customer(r: Retail) -> DataFrame:
    return enrich.join_customer(r.sales(product=False), r.customers()).drop("price", "quantity")


@query
def join_store(r: Retail) -> DataFrame:
    return enrich.join_store(r.sales(product=False), r.stores()).drop("price", "quantity")


@query
def join_salesperson(r: Retail) -> DataFrame:
    return enrich.join_salesperson(r.sales(product=False), r.staff()).drop("price", "quantity")


@query
def join_product(r: Retail) -> DataFrame:
    return enrich.join_product(r.sales(), r.products()).select(
        "customer_id", "product_name", "sales_date", "total_cost", "product_id", "current_price"
    )


@query
def enrich_sales(r: Retail) -> DataFrame:
    return enrich.enrich(r.sales(product=False), r.customers(), r.stores(), r.staff())


@query
def orphan_sales(r: Retail) -> DataFrame:
    known = r.customers().where(F.col("last_name") == "HOUSEHOLD")
    lost = enrich.orphan_sales(r.sales(product=False), known, "customer_id", "customer_id")
    return lost.select("customer_id", "store_id", "sales_person_id", "sales_date", "total_cost")


# Projections and functions


@query
def project_fact(r: Retail) -> DataFrame:
    return drift.project_fact(r.sales())


@query
def customer_rows(r: Retail) -> DataFrame:
    sale = enrich.enrich(r.sales(product=False), *_dimensions(r)).alias("sale")
    return enrich.customer_rows(sale)


@query
def sales_rows(r: Retail) -> DataFrame:
    return enrich.sales_rows(enrich.enrich(r.sales(product=False), *_dimensions(r)))


def _dimensions(r: Retail) -> tuple[DataFrame, DataFrame, DataFrame]:
    return r.customers(), r.stores(), r.staff()


@query
def preview_limit(r: Retail) -> DataFrame:
    return r.sales().orderBy(*FACT_COLUMNS).limit(20)


@query
def month_bucket(r: Retail) -> DataFrame:
    date = F.col("o_orderdate").cast("date")
    return r.table("orders").select(
        "o_orderkey",
        calendar.month_start(date).alias("month_start"),
        calendar.month_start_from_text(date).alias("month_from_text"),
        calendar.month_label(date).alias("month_label"),
    )


@query
def drop_unknown_noop(r: Retail) -> DataFrame:
    return r.table("part").drop("p_size", "additional_column")


@query
def fold_extra_columns(r: Retail) -> DataFrame:
    """Orders with status F bring no extra column, the others two, some of them NULL."""
    orders = r.table("orders")
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    without = drift.fold_extras(orders.where(status == "F"), [], ["o_orderkey"])
    extras = orders.where(status != "F").select(
        "o_orderkey",
        F.when(status != "P", status).alias("status"),
        F.when(priority != "5-LOW", priority).alias("priority"),
    )
    return drift.union_by_name(
        [without, drift.fold_extras(extras, ["status", "priority"], ["o_orderkey"])]
    )


@query
def full_name_concat(r: Retail) -> DataFrame:
    customers, staff = r.customers(), r.staff()
    surname = F.when(F.col("last_name") != "HOUSEHOLD", F.col("last_name"))
    name = text.full_name(F.col("first_name"), F.col("last_name"))
    people = [
        customers.select(
            F.lit("customer").alias("role"),
            F.col("customer_id").alias("id"),
            text.full_name(F.col("first_name"), surname).alias("full_name"),
        ),
        staff.select(F.lit("staff").alias("role"), "id", name.alias("full_name")),
    ]
    return drift.union_by_name(people)


@query
def implicit_casts(r: Retail) -> DataFrame:
    """Integer beside double, void beside string, a date taken as text, 0 beside double."""
    parts = r.table("part")
    day = F.date_add(F.lit("2023-03-03").cast("date"), F.col("p_size"))
    sizes = parts.select(
        "p_partkey",
        F.col("p_size").alias("measure"),
        F.lit(None).alias("note"),
        F.substring(day, 1, 7).alias("month"),
    )
    prices = parts.select(
        "p_partkey",
        F.col("p_retailprice").alias("measure"),
        F.col("p_brand").alias("note"),
        F.substring(day, 1, 7).alias("month"),
    )
    both = drift.union_by_name([sizes, prices])
    return both.withColumn("share", F.when(F.col("measure") > 20, F.col("measure") * 0.5).otherwise(0))


@query
def rebase_path(r: Retail) -> DataFrame:
    url = F.col("url")
    return r.table("pages").select(
        "page_id",
        text.url_key(url).alias("url_key"),
        text.base_name(url).alias("base_name"),
        text.without_prefix(url, F.lit("https://")).alias("without_scheme"),
    )


@query
def total_cost_check(r: Retail) -> DataFrame:
    return quality.total_cost_check(
        r.sales(product=False, carry=("l_orderkey", "l_linenumber"))
    ).select("l_orderkey", "l_linenumber", "price", "quantity", "total_cost", "expected_cost", "matches")


@query
def quarantine_rows(r: Retail) -> DataFrame:
    rules = {
        "more than 40 pieces": F.col("quantity") > 40,
        "no customer": F.col("customer_id").isNull(),
        "returned": F.col("additional_columns").startswith("R"),
    }
    return quality.quarantined(quality.with_reason(r.sales(), rules))


# Contract and drift


def _headers_of_orders(r: Retail) -> DataFrame:
    """One file name per order; its header depends on the order's status.

    F lacks the store and brings a payment mode, O spells the customer differently and
    brings a note, P follows the contract.
    """
    layouts = {
        "F": [c for c in CONTRACT if c != "store_id"] + ["payment_mode"],
        "O": ["Customer_ID", *CONTRACT[1:], "note"],
    }
    header = F.array(*[F.lit(c) for c in CONTRACT])
    for status, names in layouts.items():
        header = F.when(
            F.col("o_orderstatus") == status, F.array(*[F.lit(c) for c in names])
        ).otherwise(header)
    file = F.concat(F.lit("sales_"), F.col("o_orderkey"), F.lit(".csv"))
    return r.table("orders").select(file.alias("file"), header.alias("columns"))


@query
def schema_missing_columns(r: Retail) -> DataFrame:
    missing = contract.missing_columns(F.col("columns"))
    return _headers_of_orders(r).select("file", F.explode(missing).alias("missing_column"))


@query
def schema_extra_columns(r: Retail) -> DataFrame:
    extra = contract.extra_columns(F.col("columns"))
    return _headers_of_orders(r).select("file", F.explode(extra).alias("extra_column"))


@query
def split_by_extension(r: Retail) -> DataFrame:
    """One landed path per order: .csv for status F, .CSV for O, a folder marker for P."""
    status = F.col("o_orderstatus")
    suffix = F.when(status == "F", ".csv").when(status == "O", ".CSV").otherwise("/")
    paths = r.table("orders").select(
        F.concat(F.lit("landing/sales_"), F.col("o_orderkey"), suffix).alias("path")
    )
    return landing.with_extension_verdict(paths)


@query
def empty_seed_union(r: Retail) -> DataFrame:
    return drift.union_by_name([drift.project_fact(r.sales())], drift.empty_sales(r.spark))


@query
def union_by_name(r: Retail) -> DataFrame:
    orders = r.table("orders")
    finished = F.col("o_orderstatus") == "F"
    whole = orders.where(finished).select(
        "o_orderkey", F.floor("o_totalprice").cast("int").alias("amount"), "o_orderpriority"
    )
    exact = orders.where(~finished).select(
        "o_orderpriority", F.col("o_totalprice").alias("amount"), "o_orderkey"
    )
    return drift.union_by_name([whole, exact])


@query
def synth_sales(r: Retail) -> DataFrame:
    return synth.synthesize(r.table("orders").select("o_orderkey"), "o_orderkey")


# Ledger


def _event_ledger(r: Retail) -> DataFrame:
    return r.table("events").select(
        F.col("user_id").alias("file_name"),
        F.col("event_type").alias("status"),
        F.col("ts").alias("at"),
        "event_id",
    )


@query
def ledger_latest_state(r: Retail) -> DataFrame:
    last = ledger.latest_state(_event_ledger(r), "file_name", ["at", "event_id"])
    return last.select("file_name", "status", "event_id")


@query
def ledger_unfinished(r: Retail) -> DataFrame:
    last = ledger.latest_state(_event_ledger(r), "file_name", ["at", "event_id"])
    listed = r.table("customer").select(F.col("c_custkey").alias("file_name"))
    return ledger.unfinished(last, listed, "file_name", F.col("status") == "error")


# Files: whole tables written to scratch and read back


def _orders(r: Retail) -> DataFrame:
    return r.table("orders").withColumn("o_orderdate", F.col("o_orderdate").cast("date"))


@query
def landing_inventory(r: Retail) -> DataFrame:
    """Bytes per monthly folder of the orders written as text."""
    folder = scratch.folder(r.spark, "landing")
    cents = (F.col("o_totalprice").cast("decimal(18,2)") * 100).cast("bigint").alias("cents")
    rows = _orders(r).select(
        "o_orderkey", "o_custkey", "o_orderstatus", cents, "o_orderdate", "o_orderpriority"
    )
    month = calendar.month_label(F.col("o_orderdate"))
    rows.withColumn("month", month).write.partitionBy("month").csv(folder)
    files = landing.inventory(r.spark, folder)
    return files.groupBy(F.regexp_extract("path", "month=([^/]+)/", 1).alias("month")).agg(
        F.sum("length").alias("total_bytes")
    )


@query
def header_signature(r: Retail) -> DataFrame:
    folder = scratch.folder(r.spark, "headers")
    for name, rows in flows.drops(r).items():
        flows.drop_csv(rows, f"{folder}/{name}")
    named = landing.headers(landing.inventory(r.spark, folder))
    return named.select(
        F.element_at(F.split("path", "/"), -2).alias("layout"),
        F.array_join("columns", ",").alias("signature"),
        F.size("columns").alias("n_columns"),
    ).distinct()


@query
def csv_typed_scan(r: Retail) -> DataFrame:
    folder = scratch.folder(r.spark, "csv")
    orders = _orders(r)
    flows.drop_csv(orders, folder)
    return typed.csv_rows(r.spark, folder, T.StructType(orders.schema.fields))


@query
def json_typed_scan(r: Retail) -> DataFrame:
    folder = scratch.folder(r.spark, "json")
    orders = _orders(r)
    orders.write.json(folder)
    return typed.json_rows(r.spark, folder, T.StructType(orders.schema.fields))


@query
def parquet_roundtrip(r: Retail) -> DataFrame:
    folder = scratch.folder(r.spark, "parquet")
    parquet.overwrite(r.sales(), folder)
    return r.spark.read.parquet(folder)


@query
def partitioned_write_prune(r: Retail) -> DataFrame:
    """All sales rows by month and store; one month is read back by its partitions."""
    folder = scratch.folder(r.spark, "partitioned")
    rows = enrich.sales_rows(enrich.enrich(r.sales(product=False), *_dimensions(r)))
    parquet.overwrite_partitions(rows, folder, ["sales_month", "store_id"])
    back = r.spark.read.schema(rows.schema).parquet(folder)
    month = back.where(F.col("sales_month") == READ_BACK_MONTH)
    return month.groupBy("sales_month", "store_id").agg(
        F.count(F.lit(1)).alias("n_sales"), F.sum("total_cost").alias("total_sales")
    )


@query
def versioned_publish(r: Retail) -> DataFrame:
    """Two versions, the first without its totals; the newer one is read."""
    base = scratch.folder(r.spark, "published")
    sales = r.sales()
    first = parquet.publish(sales.drop("total_cost"), base, epoch_ms=1)
    parquet.publish(sales, base, epoch_ms=first + 1)
    return parquet.latest(r.spark, base).select(*FACT_COLUMNS)
