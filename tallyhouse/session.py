"""Session settings: two that jobs need, and a session for tests and the bench."""

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

_FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def split_hot_keys(spark: SparkSession) -> None:
    """Lets adaptive execution split a hot key even where that costs one more shuffle.

    Without it a join on a hot key stays in one task whenever the next step could reuse
    the join's partitioning.
    """
    spark.conf.set("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """What is executed inside deletes its shuffle files when it ends.

    Otherwise they stay until the driver collects its garbage, so that a chain of steps holds the shuffles of
    all of them. For writes: nothing reads their shuffles again. Spark before 4.1 does not know the setting.
    """
    before = spark.conf.get(_FREED, None)
    spark.conf.set(_FREED, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_FREED)
        else:
            spark.conf.set(_FREED, before)


def local_session(cpus: int = 8, app: str = "tallyhouse") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    split_hot_keys(spark)
    return spark
