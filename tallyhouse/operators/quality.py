"""Row checks and the quarantine."""

from pyspark.sql import Column, DataFrame, functions as F


def with_reason(rows: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Adds ``reason``: the names of all broken rules, NULL for a clean row.

    A rule is a condition that makes the row bad; an unknown (NULL) condition does not.
    """
    broken = F.concat_ws("; ", *[F.when(bad, F.lit(name)) for name, bad in rules.items()])
    return rows.withColumn("reason", F.when(broken != "", broken))


def quarantined(rows: DataFrame) -> DataFrame:
    return rows.where(F.col("reason").isNotNull())


def clean(rows: DataFrame) -> DataFrame:
    return rows.where(F.col("reason").isNull()).drop("reason")


def total_cost_check(sales: DataFrame) -> DataFrame:
    """Adds price times quantity and whether the total agrees with it."""
    expected = F.col("price") * F.col("quantity")
    return sales.withColumn("expected_cost", expected).withColumn(
        "matches", F.col("expected_cost") == F.col("total_cost")
    )


def repeated_keys(dimension: DataFrame, key: str) -> DataFrame:
    """Keys that occur more than once; a dimension has to have none."""
    return dimension.groupBy(key).agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")


def require_unique(dimension: DataFrame, key: str) -> None:
    """Stops a load whose dimension would multiply sales."""
    example = repeated_keys(dimension, key).limit(1).collect()
    if example:
        raise ValueError(f"{key} {example[0][key]} occurs {example[0]['copies']} times")
