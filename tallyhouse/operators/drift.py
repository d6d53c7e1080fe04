"""Bringing files of different layouts to one fact relation."""

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tallyhouse.functions.text import overflow
from tallyhouse.schemas import CONTRACT, FACT, OVERFLOW


def empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """No rows of ``schema``. The optimizer sees that it is empty and drops it from a union."""
    nothing = spark.range(1).where(F.lit(False))
    return nothing.select([F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])


def empty_sales(spark: SparkSession) -> DataFrame:
    return empty(spark, FACT)


def fold_extras(df: DataFrame, extras: list[str], keep: list[str] = CONTRACT) -> DataFrame:
    """``keep`` in that order plus the extra columns folded into one."""
    return df.select(*keep, overflow(extras).alias(OVERFLOW))


def union_by_name(frames: list[DataFrame], seed: DataFrame | None = None) -> DataFrame:
    """All rows of all frames, columns matched by name and types widened."""
    parts = frames if seed is None else [seed, *frames]
    return reduce(lambda a, b: a.unionByName(b), parts)


def project_fact(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(name) for name in FACT.names])
