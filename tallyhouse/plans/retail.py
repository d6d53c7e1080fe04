"""The order tables seen as retail sales: a line item is a sale, its supplier the seller,
the supplier's nation the store.

Each dimension is a projection of one table, so its size is known when a join is planned.
"""

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tallyhouse.functions.money import money, unit_price
from tallyhouse.functions.text import overflow
from tallyhouse.sources.dimensions import Dimensions

_SCHEMAS: dict[str, T.StructType] = {}


class Retail:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def table(self, name: str) -> DataFrame:
        """A table by name. Finding out its schema takes a job, so that is done once."""
        path = f"{self.folder}/{name}.parquet"
        if path not in _SCHEMAS:
            _SCHEMAS[path] = self.spark.read.parquet(path).schema
        return self.spark.read.schema(_SCHEMAS[path]).parquet(path)

    def sales(
        self,
        store: bool = True,
        product: bool = True,
        carry: tuple[str, ...] = (),
    ) -> DataFrame:
        """The sales fact, one row per line item of an order.

        Without ``store`` or ``product`` the supplier or part table is not joined; each
        adds at most one match, so the rows stay the same. ``carry`` names line item columns
        to keep beside the fact.
        """
        orders = self.table("orders").select("o_orderkey", F.col("o_custkey").alias("customer_id"))
        rows = self.table("lineitem").join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        if product:
            parts = self.table("part").select("p_partkey", F.col("p_name").alias("product_name"))
            rows = rows.join(parts, F.col("l_partkey") == F.col("p_partkey"), "left")
        if store:
            rows = self._with_store(rows, "l_suppkey")
        total = money(F.col("l_extendedprice"))
        quantity = F.col("l_quantity").cast("int")
        return rows.select(
            "customer_id",
            *(["store_id"] if store else []),
            *(["product_name"] if product else []),
            F.col("l_shipdate").cast("date").alias("sales_date"),
            F.col("l_suppkey").alias("sales_person_id"),
            unit_price(total, quantity).alias("price"),
            quantity.alias("quantity"),
            total.alias("total_cost"),
            overflow(["l_returnflag", "l_linestatus"]).alias("additional_columns"),
            *carry,
        )

    def _with_store(self, rows: DataFrame, seller: str) -> DataFrame:
        sellers = self.table("supplier").select(
            "s_suppkey", F.col("s_nationkey").cast("bigint").alias("store_id")
        )
        return rows.join(sellers, F.col(seller) == F.col("s_suppkey"), "left")

    def customers(self) -> DataFrame:
        return self.table("customer").select(
            F.col("c_custkey").alias("customer_id"),
            F.col("c_name").alias("first_name"),
            F.col("c_mktsegment").alias("last_name"),
            F.concat(F.lit("nation "), F.col("c_nationkey")).alias("address"),
            F.col("c_nationkey").cast("string").alias("pincode"),
            F.col("c_custkey").cast("string").alias("phone_number"),
        )

    def stores(self) -> DataFrame:
        return self.table("nation").select(
            F.col("n_nationkey").cast("bigint").alias("id"),
            F.col("n_name").alias("address"),
            F.col("n_regionkey").cast("string").alias("store_pincode"),
            F.concat(F.lit("manager of "), F.col("n_name")).alias("store_manager_name"),
        )

    def staff(self) -> DataFrame:
        return self.table("supplier").select(
            F.col("s_suppkey").alias("id"),
            F.col("s_name").alias("first_name"),
            F.concat(F.lit("of nation "), F.col("s_nationkey")).alias("last_name"),
            F.col("s_nationkey").cast("bigint").alias("manager_id"),
            F.when(F.col("s_acctbal") < 0, "Y").otherwise("N").alias("is_manager"),
            F.concat(F.lit("nation "), F.col("s_nationkey")).alias("address"),
            F.col("s_nationkey").cast("string").alias("pincode"),
        )

    def products(self) -> DataFrame:
        return self.table("part").select(
            F.col("p_partkey").alias("id"),
            F.col("p_name").alias("name"),
            F.col("p_retailprice").cast("decimal(10,2)").alias("current_price"),
        )

    def dimensions(self) -> Dimensions:
        return Dimensions(self.customers(), self.stores(), self.staff())
