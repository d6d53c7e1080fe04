"""Marts to JDBC tables."""

from pyspark.sql import DataFrame, functions as F, types as T

from tallyhouse.sources.jdbc import Database


def _in_cents(df: DataFrame) -> DataFrame:
    """Money rounded here, since databases differ in whether they round or cut."""
    return df.select(
        [
            F.round(F.col(f.name), 2).alias(f.name)
            if isinstance(f.dataType, T.DecimalType)
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def append(df: DataFrame, database: Database, table: str, connections: int = 8) -> None:
    """Adds rows and lets a failure raise. ``connections`` bounds the tasks that write."""
    _in_cents(df).write.option("numPartitions", connections).jdbc(
        database.url, table, mode="append", properties=database.properties
    )


def replace(df: DataFrame, database: Database, table: str, connections: int = 8) -> None:
    """Empties the table, keeps its definition, and writes all rows anew."""
    _in_cents(df).write.option("numPartitions", connections).option("truncate", True).jdbc(
        database.url, table, mode="overwrite", properties=database.properties
    )
