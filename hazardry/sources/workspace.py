"""Where jobs put intermediate tables: the shared folder the cluster names.

``spark.checkpoint.dir`` is read from the session.  Only when it is unset and
driver and executors are one process (a laptop, a test) a temporary folder takes
its place; on a cluster executors would each write to a disk of their own, so
there the setting is required.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

ROWS_PER_TASK = 500_000

_LOCAL_FOLDERS: dict[str, str] = {}


def base_folder(spark: SparkSession) -> str:
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_FOLDERS:
        _LOCAL_FOLDERS[app] = tempfile.mkdtemp(prefix="hazardry-")
    return _LOCAL_FOLDERS[app]


def fresh_folder(spark: SparkSession, purpose: str) -> str:
    """A path nobody has used yet, below the shared folder."""
    return f"{base_folder(spark)}/hazardry/{purpose}-{uuid.uuid4().hex}"


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder; none there is no fault."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


class scratch:
    """A folder for tables that are needed during one piece of work; it is deleted at its end."""

    def __init__(self, spark: SparkSession, purpose: str):
        self.spark, self.path, self.tables = spark, fresh_folder(spark, purpose), 0

    def __enter__(self) -> scratch:
        return self

    def __exit__(self, *_) -> None:
        remove(self.spark, self.path)

    def staged(self, df: DataFrame) -> DataFrame:
        self.tables += 1
        path = f"{self.path}/{self.tables}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)


def staged(df: DataFrame, purpose: str) -> DataFrame:
    """Write once and read back: later steps start from files, not from this lineage."""
    path = fresh_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def range_tasks(rows: int) -> list[int]:
    """The number of ranges, for `repartitionByRange`, that gives a task at most about ROWS_PER_TASK of ``rows``
    to sort or add up in memory; left to Spark where one would do."""
    return [-(-rows // ROWS_PER_TASK)] if rows > ROWS_PER_TASK else []
