"""The dimensions of a sale: customer, store and staff, and the product on request."""

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyhouse import scratch
from tallyhouse.operators.quality import require_unique
from tallyhouse.schemas import CUSTOMER, PRODUCT, SALES_TEAM, STORE
from tallyhouse.sources.jdbc import Database, Split, scan, split_by

# The names of the dimension tables.
CUSTOMER_TABLE = "customer"
STORE_TABLE = "store"
STAFF_TABLE = "sales_team"
PRODUCT_TABLE = "product"

#: The customers' key and into how many parts their table is cut unless the caller says otherwise.
CUSTOMER_SPLIT = ("customer_id", 16)


@dataclass(frozen=True)
class Dimensions:
    customers: DataFrame
    stores: DataFrame
    staff: DataFrame
    products: DataFrame | None = None

    @classmethod
    def from_database(
        cls,
        spark: SparkSession,
        database: Database,
        splits: dict[str, Split] | None = None,
        products: bool = False,
    ) -> "Dimensions":
        """Each table is read once and kept: a kept table has a known size, a JDBC one has not.

        ``splits`` says by table name how a large table is cut, so that several tasks read it. The
        customers' is always cut, between the bounds the database tells if none are given.
        """
        cut = dict(splits or {})
        if CUSTOMER_TABLE not in cut:
            cut[CUSTOMER_TABLE] = split_by(spark, database, CUSTOMER_TABLE, *CUSTOMER_SPLIT)
        tables = [CUSTOMER_TABLE, STORE_TABLE, STAFF_TABLE] + [PRODUCT_TABLE] * products
        return cls(
            *[scratch.keep(scan(spark, database, table, cut.get(table)), table) for table in tables]
        )

    @classmethod
    def from_parquet(cls, spark: SparkSession, folder: str, products: bool = False) -> "Dimensions":
        """Tables below ``folder`` under the same names as in the database."""
        tables = [(CUSTOMER_TABLE, CUSTOMER), (STORE_TABLE, STORE), (STAFF_TABLE, SALES_TEAM)]
        tables += [(PRODUCT_TABLE, PRODUCT)] * products
        return cls(
            *[spark.read.schema(schema).parquet(f"{folder}/{table}") for table, schema in tables]
        )

    def require_unique_keys(self) -> None:
        """A repeated key would multiply sales."""
        require_unique(self.customers, "customer_id")
        require_unique(self.stores, "id")
        require_unique(self.staff, "id")

    def digest(self) -> str:
        """Another text once any row of any table is another one; the order of rows does not count."""
        tables = [self.customers, self.stores, self.staff, self.products]
        return " ".join("none" if table is None else _digest(table) for table in tables)


def _digest(table: DataFrame) -> str:
    row = F.xxhash64(F.to_json(F.struct("*"))).cast("decimal(20,0)")
    n, total = table.agg(F.count(F.lit(1)), F.sum(row)).first()
    return f"{n}:{total or 0}"
