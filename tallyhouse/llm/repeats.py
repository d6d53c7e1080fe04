"""Numbers for rows that are equal, so that a hash can tell them apart."""

from pyspark.sql import DataFrame, functions as F

from tallyhouse.operators.ranking import row_number
from tallyhouse.operators.windows import same
from tallyhouse.scratch import keep


def with_number(rows: DataFrame, values: list[str]) -> DataFrame:
    """``rows`` with ``_nth``: 0 for a row whose ``values`` no other row has, else 1 to their number.

    A hash of ``values`` and ``_nth`` spreads even one row repeated without end. Values are counted with a
    map-side combine, and only repeated rows are placed by slices of a range. NULLs are equal.
    """
    repeated = rows.groupBy(*values).agg(F.count(F.lit(1)).alias("_times")).where("_times > 1")
    repeated = keep(repeated, "repeated")
    if repeated.isEmpty():
        return rows.withColumn("_nth", F.lit(0).cast("long"))
    joined = rows.alias("row").join(repeated.alias("more"), same("row", "more", values), "left")
    marked = keep(joined.select("row.*", "more._times"), "marked")
    single = marked.where("_times IS NULL").drop("_times").withColumn("_nth", F.lit(0).cast("long"))
    several = marked.where("_times IS NOT NULL").drop("_times").withColumn("_any", F.monotonically_increasing_id())
    several = row_number(several, values, [F.col("_any")], "_nth").drop("_any", "in_group")
    return single.unionByName(several.withColumn("_nth", F.col("_nth").cast("long")))
