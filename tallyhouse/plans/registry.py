"""Where queries are registered."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tallyhouse.functions.money import as_double
from tallyhouse.plans.retail import Retail
from tallyhouse.session import split_hot_keys

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}


def query(build: Callable[[Retail], DataFrame]) -> Callable[[Retail], DataFrame]:
    """Registers ``build`` under its own name; money leaves as double."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        split_hot_keys(spark)
        return as_double(build(Retail(spark, folder)))

    QUERIES[build.__name__] = run
    return build
