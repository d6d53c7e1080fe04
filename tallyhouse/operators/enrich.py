"""Sales joined with customer, store, staff and product.

No join carries a hint. The optimizer broadcasts a dimension only below
``spark.sql.autoBroadcastJoinThreshold`` and sort-merges beyond it, where adaptive
execution splits a hot key of the sales side.
"""

from pyspark.sql import DataFrame, functions as F

from tallyhouse.functions.calendar import month_label
from tallyhouse.schemas import CUSTOMER_ROW_COLUMNS, SALES_ROW_COLUMNS, TOTAL


def staff_as_seller(staff: DataFrame) -> DataFrame:
    """The sales team under the names it has on a sale."""
    return staff.select(
        F.col("id").alias("sales_person_id"),
        F.col("first_name").alias("sales_person_first_name"),
        F.col("last_name").alias("sales_person_last_name"),
        "manager_id",
        "is_manager",
        F.col("address").alias("sales_person_address"),
        F.col("pincode").alias("sales_person_pincode"),
    )


def customer_columns(customers: DataFrame) -> DataFrame:
    return customers.select(
        "customer_id", "first_name", "last_name", "address", "pincode", "phone_number"
    )


def join_customer(sales: DataFrame, customers: DataFrame) -> DataFrame:
    return sales.join(customer_columns(customers), "customer_id")


def join_store(sales: DataFrame, stores: DataFrame) -> DataFrame:
    where = stores.select(F.col("id").alias("store_id"), "store_manager_name")
    return sales.join(where, "store_id")


def join_salesperson(sales: DataFrame, staff: DataFrame) -> DataFrame:
    return sales.join(staff_as_seller(staff), "sales_person_id")


def join_product(sales: DataFrame, products: DataFrame) -> DataFrame:
    """Left join by name. Names may repeat; the product with the lowest id stands for its name."""
    by_name = products.groupBy(F.col("name").alias("product_name")).agg(
        F.min(F.struct("id", "current_price")).alias("p")
    )
    priced = by_name.select(
        "product_name",
        F.col("p.id").alias("product_id"),
        F.col("p.current_price").alias("current_price"),
    )
    return sales.join(priced, "product_name", "left")


def enrich(
    sales: DataFrame, customers: DataFrame, stores: DataFrame, staff: DataFrame
) -> DataFrame:
    """The sale with all three dimensions; a sale missing one of them drops out.

    The customers, the largest dimension as a rule, come first: the shuffle by their key carries no text
    of another one, and stores and staff, where they are broadcast, need none. The columns stand as if
    they came last.
    """
    rows = sales.select(
        "customer_id", "store_id", "sales_person_id", "sales_date", "total_cost", "additional_columns"
    )
    joined = join_salesperson(join_store(join_customer(rows, customers), stores), staff)
    sold, texts = rows.columns[3:], customer_columns(customers).columns[1:]
    others = [c for c in joined.columns if c not in (*rows.columns, *texts)]
    return joined.select("customer_id", "sales_person_id", "store_id", *sold, *others, *texts)


#: What ``with_known_keys`` adds, one flag per dimension.
KNOWN = ["known_store", "known_seller", "known_customer"]


def with_known_keys(
    sales: DataFrame, customers: DataFrame, stores: DataFrame, staff: DataFrame
) -> DataFrame:
    """``sales`` with a flag for each dimension that has its key; no sale drops out."""
    keys = (stores, "id", "store_id"), (staff, "id", "sales_person_id"), (customers, "customer_id", "customer_id")
    for flag, (dimension, key, column) in zip(KNOWN, keys):
        known = dimension.select(F.col(key).alias(column), F.lit(True).alias(flag))
        sales = sales.join(known, column, "left")
    return sales.withColumns({flag: F.col(flag).isNotNull() for flag in KNOWN})


def dropped_sales(checked: DataFrame, by: list[str] | None = None) -> DataFrame:
    """How many sales an inner join with all dimensions loses, by what they lack (and ``by``), and
    their total."""
    lacking = ~(F.col(KNOWN[0]) & F.col(KNOWN[1]) & F.col(KNOWN[2]))
    return checked.where(lacking).groupBy(*KNOWN, *(by or [])).agg(
        F.count(F.lit(1)).alias("n_sales"), F.sum("total_cost").cast(TOTAL).alias("total_cost")
    )


def known_sales(
    sales: DataFrame,
    customers: DataFrame | None = None,
    stores: DataFrame | None = None,
    staff: DataFrame | None = None,
) -> DataFrame:
    """Sales whose keys exist in the given dimensions, with no column added."""
    for dimension, key, column in (
        (stores, "id", "store_id"),
        (staff, "id", "sales_person_id"),
        (customers, "customer_id", "customer_id"),
    ):
        if dimension is not None:
            keys = dimension.select(F.col(key).alias(column))
            sales = sales.join(keys, column, "left_semi")
    return sales


def orphan_sales(sales: DataFrame, dimension: DataFrame, key: str, column: str) -> DataFrame:
    """Sales an inner join with ``dimension`` would lose, NULL keys among them."""
    return sales.join(dimension.select(F.col(key).alias(column)), column, "left_anti")


def customer_rows(enriched: DataFrame, more: list[str] | None = None) -> DataFrame:
    """``more``: columns to keep beside the fixed ones."""
    return enriched.select(*CUSTOMER_ROW_COLUMNS, *(more or []))


def sales_rows(enriched: DataFrame, more: list[str] | None = None) -> DataFrame:
    """``more``: columns to keep beside the fixed ones."""
    month = month_label(F.col("sales_date")).alias("sales_month")
    return enriched.select(*SALES_ROW_COLUMNS, month, *(more or []))
