"""Text sources read with a given schema; nothing is inferred."""

from pyspark.sql import DataFrame, SparkSession, types as T


def csv_rows(spark: SparkSession, path: str | list[str], schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE").csv(path)


def json_rows(spark: SparkSession, path: str | list[str], schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).option("mode", "PERMISSIVE").json(path)
