"""Facts kept by buckets of a key, so that a join on that key shuffles none of them.

A key's rows are spread over ``SALTS`` buckets by a salt from their other columns, since without a
shuffle nothing splits a hot key later; the other side of a join is repeated once per salt. Files are
written by insertion into a table over the folder, so each load adds its own and rewrites no other.
"""

from hashlib import sha256

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

SALTS = 8
SALT = "key_salt"


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def opened(spark: SparkSession, path: str, schema: T.StructType, key: str, buckets: int) -> str:
    """The name of the session's table over ``path``; it is made if the session has none yet."""
    name = f"bucketed_{sha256(path.encode()).hexdigest()[:16]}"
    if not spark.catalog.tableExists(name):
        columns = ", ".join(f"{_quoted(f.name)} {f.dataType.simpleString()}" for f in schema.fields)
        place = path.replace("'", "\\'")
        spark.sql(
            f"CREATE TABLE {name} ({columns}, {SALT} INT) USING parquet "
            f"CLUSTERED BY ({_quoted(key)}, {SALT}) INTO {buckets} BUCKETS LOCATION '{place}'"
        )
    return name


def add(rows: DataFrame, path: str, key: str, buckets: int) -> None:
    """Adds ``rows``; each bucket gets one file, as one task has all its rows."""
    name = opened(rows.sparkSession, path, rows.schema, key, buckets)
    others = [F.col(_quoted(c)) for c in rows.columns if c != key]
    salt = F.pmod(F.xxhash64(*others), F.lit(SALTS)).cast("int") if others else F.lit(0)
    salted = rows.withColumn(SALT, salt)
    salted.repartition(buckets, F.col(_quoted(key)), F.col(SALT)).write.insertInto(name)


def read(spark: SparkSession, path: str, schema: T.StructType, key: str, buckets: int) -> DataFrame:
    return spark.table(opened(spark, path, schema, key, buckets))


def join(facts: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """Inner join with ``dimension``, which is repeated for every salt; the facts stay where they are.

    Spark moves only the other side if there are at least as many buckets as shuffle partitions.
    """
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias(SALT)
    return facts.join(dimension.select("*", salts), [key, SALT]).drop(SALT)
