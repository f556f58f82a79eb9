"""Intermediate tables in the folder that all executors share.

Lineage is cut by written tables only: a lost executor costs a re-read, never a
recomputation of earlier rounds.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

ROW = "_gaugeworks_row"
#: holds the folders of all calls, below the shared one
FOLDER = "gaugeworks"


def shared_dir(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; a local one only where that is unset and the master is local."""
    context = spark.sparkContext
    found = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if not found:
        if not context.master.startswith("local[") and context.master != "local":
            raise RuntimeError("spark.checkpoint.dir has to name a folder that the driver and all executors share")
        context.setCheckpointDir(f"file://{tempfile.gettempdir()}/gaugeworks-shared")
        found = context.getCheckpointDir()
    path = context._jvm.org.apache.hadoop.fs.Path(found)
    full = path.getFileSystem(context._jsc.hadoopConfiguration()).makeQualified(path).toString()
    return "file:///" + full.removeprefix("file:").lstrip("/") if full.startswith("file:/") else full


def bound_batches(spark: SparkSession, size: str = "8m") -> None:
    """Arrow batches of a few megabytes, where the session leaves their size as it is by default."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key) in ("64MB", "67108864b", "67108864"):
        spark.conf.set(key, size)


class Workspace:
    """A folder of one call's tables, each written once and read back from there."""

    def __init__(self, spark: SparkSession, what: str):
        bound_batches(spark)
        self.spark = spark
        self.path = f"{shared_dir(spark).rstrip('/')}/{FOLDER}/{what}-{uuid.uuid4().hex}"

    def put(self, df: DataFrame, name: str) -> DataFrame:
        df.write.mode("overwrite").parquet(f"{self.path}/{name}")
        return self.get(df.schema, name)

    def numbered(self, df: DataFrame, name: str) -> DataFrame:
        """The table with a number of its own for each row, ROW, written once."""
        return self.put(df.withColumn(ROW, F.monotonically_increasing_id()), name)

    def get(self, schema, name: str) -> DataFrame:
        return self.spark.read.schema(schema).parquet(f"{self.path}/{name}")

    def drop(self, *names: str) -> None:
        """Free tables that no later step reads."""
        for name in names:
            _delete(self.spark, f"{self.path}/{name}")


def _delete(spark: SparkSession, path: str) -> None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def clear_workspaces(spark: SparkSession) -> None:
    """Delete the tables of all calls so far; results that still read them are lost with them."""
    _delete(spark, f"{shared_dir(spark).rstrip('/')}/{FOLDER}")
