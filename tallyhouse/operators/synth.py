"""Seeded sales in the shape of the daily files.

A sale is drawn from its key by whole-number arithmetic, so any engine can redo it and
a task that runs again yields the same rows.
"""

from datetime import date
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tallyhouse.schemas import MONEY

# Products with their prices, and three sellers for each store.
PRODUCTS = [
    ("quaker oats", Decimal("212")),
    ("sugar", Decimal("50")),
    ("maida", Decimal("20")),
    ("besan", Decimal("52")),
    ("refined oil", Decimal("110")),
    ("clinic plus", Decimal("1.5")),
    ("dantkanti", Decimal("100")),
    ("nutrella", Decimal("40")),
]
STORES = [121, 122, 123]
SELLERS_PER_STORE = 3
CUSTOMERS = 20
MOST_PIECES = 10
FIRST_DAY = date(2023, 3, 3)
LAST_DAY = date(2023, 8, 20)
PAYMENT_MODES = ["cash", "UPI"]


def draw(key: Column, factor: int, shift: int, choices: int) -> Column:
    """A number from 0 up to ``choices`` - 1 that depends on the key alone.

    Two remainders by different primes repeat together only after about 10**12 keys.
    """
    return ((key % 1000003) * factor + (key % 1000033) * (shift + 1)) % 999983 % choices


def _pick(values: list, place: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (place + 1).cast("int"))


def synthesize(
    keys: DataFrame, key: str, first: date = FIRST_DAY, last: date = LAST_DAY
) -> DataFrame:
    """One sale per row of ``keys``, with the extra column ``payment_mode``."""
    k = F.col(key).cast("bigint")
    days = (last - first).days + 1
    store = draw(k, 7919, 11, len(STORES))
    product = draw(k, 6101, 29, len(PRODUCTS))
    quantity = draw(k, 4507, 5, MOST_PIECES) + 1
    price = _pick([p for _, p in PRODUCTS], product).cast(MONEY)
    return keys.select(
        F.col(key),
        (draw(k, 3571, 3, CUSTOMERS) + 1).alias("customer_id"),
        _pick(STORES, store).cast("bigint").alias("store_id"),
        _pick([name for name, _ in PRODUCTS], product).alias("product_name"),
        F.date_add(F.lit(first), draw(k, 5477, 17, days).cast("int")).alias("sales_date"),
        (store * SELLERS_PER_STORE + draw(k, 8923, 7, SELLERS_PER_STORE) + 1).alias(
            "sales_person_id"
        ),
        price.alias("price"),
        quantity.cast("int").alias("quantity"),
        (price * quantity.cast("int")).cast(MONEY).alias("total_cost"),
        _pick(PAYMENT_MODES, draw(k, 2741, 13, len(PAYMENT_MODES))).alias("payment_mode"),
    )


def plain(sales: DataFrame) -> DataFrame:
    """A valid file: the contract and nothing else."""
    return sales.drop("payment_mode")


def lacking_store(sales: DataFrame) -> DataFrame:
    """A file to be rejected: no store."""
    return sales.drop("store_id")


def synth_sales(spark: SparkSession, rows: int, day: date | None = None) -> DataFrame:
    """``rows`` seeded sales, all on ``day`` if one is given."""
    keys = spark.range(rows).withColumnRenamed("id", "sale_no")
    return synthesize(keys, "sale_no", day or FIRST_DAY, day or LAST_DAY).drop("sale_no")
