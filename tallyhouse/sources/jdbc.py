"""Dimension tables behind JDBC."""

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Database:
    """Where the tables are. Credentials belong in ``properties``, from the caller."""

    url: str
    properties: dict[str, str] = field(default_factory=dict)


@dataclass(frozen=True)
class Split:
    """How a table is cut by a numeric column so that several tasks read it."""

    column: str
    lower: int
    upper: int
    parts: int


def split_by(spark: SparkSession, database: Database, table: str, column: str, parts: int) -> Split:
    """Cuts a table between the least and the largest value of ``column``, which the database finds."""
    bounds = f"(SELECT min({column}) AS least, max({column}) AS most FROM {table}) AS bounds"
    found = spark.read.jdbc(database.url, bounds, properties=database.properties).first()
    return Split(column, found["least"] or 0, found["most"] or 0, parts)


def scan(
    spark: SparkSession, database: Database, table: str, split: Split | None = None
) -> DataFrame:
    """The whole table. Without ``split`` one task reads it, which suits small tables only."""
    if split is None:
        return spark.read.jdbc(database.url, table, properties=database.properties)
    return spark.read.jdbc(
        database.url,
        table,
        column=split.column,
        lowerBound=split.lower,
        upperBound=split.upper,
        numPartitions=split.parts,
        properties=database.properties,
    )
