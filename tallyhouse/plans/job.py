"""The whole load as one job.

    spark-submit --py-files tallyhouse.zip tallyhouse/plans/job.py \\
        --landing URI --store URI --out URI (--dimensions URI | --jdbc-url URL)

Credentials of the database come from SALES_DB_USER and SALES_DB_PASSWORD, its driver
class from SALES_DB_DRIVER.
"""

import argparse
import os

from pyspark.sql import SparkSession

from tallyhouse.plans.monthly import catch_up
from tallyhouse.session import split_hot_keys
from tallyhouse.sources.dimensions import CUSTOMER_SPLIT, CUSTOMER_TABLE, Dimensions
from tallyhouse.sources.jdbc import Database, split_by
from tallyhouse.streaming.ingest import ingest

PROPERTIES = {
    "user": "SALES_DB_USER",
    "password": "SALES_DB_PASSWORD",
    "driver": "SALES_DB_DRIVER",
}


def options(words: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description="Land sales files and publish the marts.")
    parser.add_argument("--landing", required=True, help="folder the daily files arrive in")
    parser.add_argument("--store", required=True, help="folder of the landed data")
    parser.add_argument("--out", required=True, help="folder of the published datasets")
    parser.add_argument("--archive", help="folder that loaded files are moved to")
    parser.add_argument("--files-per-batch", type=int, default=1000)
    parser.add_argument("--products", action="store_true", help="join products in the sales rows")
    column, parts = CUSTOMER_SPLIT
    parser.add_argument("--split-column", default=column, help="column the customer table is cut by")
    parser.add_argument("--split-parts", type=int, default=parts, help="tasks that read that table")
    tables = parser.add_mutually_exclusive_group(required=True)
    tables.add_argument("--dimensions", help="folder of the dimension tables in Parquet")
    tables.add_argument("--jdbc-url", help="database of the dimensions and the marts")
    return parser.parse_args(words)


def database_of(url: str) -> Database:
    found = {name: os.environ[key] for name, key in PROPERTIES.items() if key in os.environ}
    return Database(url, found)


def run(spark: SparkSession, chosen: argparse.Namespace) -> int:
    """Takes in new files and publishes; returns the epoch.

    Nothing is published if the newest version holds all batches and the dimension rows as they are,
    whichever run landed them; the database is filled again unless it was filled from that version.
    """
    split_hot_keys(spark)
    database = database_of(chosen.jdbc_url) if chosen.jdbc_url else None
    if database:
        cut = split_by(spark, database, CUSTOMER_TABLE, chosen.split_column, chosen.split_parts)
        dimensions = Dimensions.from_database(spark, database, {CUSTOMER_TABLE: cut}, chosen.products)
    else:
        dimensions = Dimensions.from_parquet(spark, chosen.dimensions, chosen.products)
    ingest(
        spark,
        chosen.landing,
        chosen.store,
        files_per_batch=chosen.files_per_batch,
        archive=chosen.archive,
    )
    return catch_up(spark, chosen.store, chosen.out, dimensions, database)


if __name__ == "__main__":
    run(SparkSession.builder.appName("tallyhouse").getOrCreate(), options())
