"""Group totals beside every row."""

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tallyhouse.scratch import keep


def same(left: str, right: str, keys: list[str]) -> Column:
    """Equality of the key columns of two aliased frames, NULL equal to NULL."""
    return reduce(
        lambda a, b: a & b,
        [F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}")) for k in keys],
    )


def with_group_sum(df: DataFrame, keys: list[str], value: str, name: str) -> DataFrame:
    """The result of ``sum(value)`` over a window without order, one row per input row.

    A window sends each group to one task. Here the sum combines on the map side and is
    joined back, so a hot key only makes the join skewed, which adaptive execution splits.
    The rows are kept once for both sides, so what they come from is computed once.
    """
    df = keep(df, "group-rows")
    totals = df.groupBy(*keys).agg(F.sum(value).alias(name)).alias("group_total")
    return (
        df.alias("row")
        .join(totals, same("row", "group_total", keys))
        .select("row.*", f"group_total.{name}")
    )
