"""Rank, row number and ntile for groups too large for one task.

The rows are spread by range over (group, order), so a large group becomes several
slices in order. A row's position is its position inside the slice plus the weight of
the slices before it. Slices are numbered by the range partition they were written
from; writing them down first keeps the numbers the same for both uses, even when a
task has to run again.
"""

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyhouse import scratch
from tallyhouse.operators.windows import same


def with_weight_before(
    df: DataFrame, group: list[str], order: list[Column], weight: str
) -> DataFrame:
    """Adds ``before``, the weight that sorts ahead in the group, and ``in_group``, its total.

    ``order`` has to tell the rows of a group apart.
    """
    spread = df.repartitionByRange(*[F.col(g) for g in group], *order)
    placed = scratch.keep(spread.withColumn("slice", F.spark_partition_id()), "ranking")

    per_slice = placed.groupBy(*group, "slice").agg(F.sum(weight).alias("slice_weight"))
    slices = Window.partitionBy(*group).orderBy("slice")
    ahead = slices.rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_slice.select(
        *group,
        "slice",
        F.coalesce(F.sum("slice_weight").over(ahead), F.lit(0)).alias("slice_before"),
        F.sum("slice_weight").over(Window.partitionBy(*group)).alias("in_group"),
    )

    inside = (
        Window.partitionBy(*group, "slice")
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    local = placed.withColumn("local_before", F.coalesce(F.sum(weight).over(inside), F.lit(0)))
    return (
        local.alias("row")
        .join(offsets.alias("offset"), same("row", "offset", [*group, "slice"]))
        .select(
            *[f"row.{c}" for c in df.columns],
            (F.col("row.local_before") + F.col("offset.slice_before")).alias("before"),
            "offset.in_group",
        )
    )


def rank(df: DataFrame, group: list[str], value: str, name: str) -> DataFrame:
    """``rank()`` within ``group`` by ``value``, highest first and NULL last.

    Tied rows are counted before they are placed, so equal values need no common slice.
    The rows are used twice, so they are kept: what they come from runs once.
    """
    kept = scratch.keep(df, "ranked")
    counted = kept.groupBy(*group, value).agg(F.count(F.lit(1)).alias("tied"))
    positions = with_weight_before(counted, group, [F.col(value).desc()], "tied")
    return (
        kept.alias("row")
        .join(positions.alias("position"), same("row", "position", [*group, value]))
        .select("row.*", (F.col("position.before") + 1).cast("int").alias(name))
    )


def row_number(df: DataFrame, group: list[str], order: list[Column], name: str) -> DataFrame:
    """``row_number()``, and ``in_group``, the row count of the group."""
    single = df.withColumn("single", F.lit(1))
    placed = with_weight_before(single, group, order, "single")
    return placed.withColumn(name, F.col("before") + 1).drop("single", "before")


def ntile(
    df: DataFrame, group: list[str], order: list[Column], tiles: int, name: str
) -> DataFrame:
    """``ntile(tiles)``: sizes differ by one at most, the larger tiles come first."""
    numbered = row_number(df, group, order, "position")
    place = F.col("position") - 1
    larger = F.col("in_group") % tiles
    size = ((F.col("in_group") - larger) / tiles).cast("bigint")
    in_larger = larger * (size + 1)

    def whole(part: Column, unit: Column) -> Column:
        return ((part - part % unit) / unit).cast("bigint")

    tile = F.when(place < in_larger, whole(place, size + 1)).otherwise(
        larger + whole(place - in_larger, F.greatest(size, F.lit(1)))
    )
    return numbered.withColumn(name, (tile + 1).cast("int")).drop("position", "in_group")
