"""Plans over streams: each micro-batch is summed by the batch engine.

A batch writes its exact sums under its number, so that a batch that is replayed writes
the same row again; totals over all batches follow by adding the sums.  Dialogues, whose
rows may lie in several batches, are summed in :mod:`gaugeworks.streaming.dialogues`.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from gaugeworks.errors import PlanError
from gaugeworks.operators.metric import added, metric_sums, valued
from gaugeworks.plans.contracts import MetricPlan


def metric_by_batch(plan: MetricPlan, sink: str, by: list[str] | None = None) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that writes a batch's sums under its number."""
    if plan.unit != "turn":
        raise PlanError("Units that span batches need start_dialogue_metric", unit=plan.unit)

    def write(batch: DataFrame, number: int) -> None:
        metric_sums(batch, plan, by).write.mode("overwrite").parquet(f"{sink}/batch={number}")

    return write


def batch_table(spark: SparkSession, plan: MetricPlan, sink: str, by: list[str] | None = None) -> DataFrame:
    """Coverage, value and violations of each batch."""
    keys = ["batch", *(by or [])]
    return valued(spark.read.parquet(sink), plan, keys)


def total_table(spark: SparkSession, plan: MetricPlan, sink: str, by: list[str] | None = None) -> DataFrame:
    """Coverage, value and violations over all batches: what the whole table would give."""
    return valued(added(spark.read.parquet(sink).drop("batch"), by), plan, by)


def scratch(spark: SparkSession, what: str) -> str:
    """A new folder below the one that ``spark.checkpoint.dir`` names; a local one only on a local master."""
    context = spark.sparkContext
    shared = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    if not shared:
        if not context.master.startswith("local[") and context.master != "local":
            raise RuntimeError("spark.checkpoint.dir has to name a folder that the driver and all executors share")
        shared = f"file://{tempfile.gettempdir()}/gaugeworks-streams"
    return f"{shared.rstrip('/')}/{what}-{uuid.uuid4().hex}"


def stream_files(spark: SparkSession, path: str) -> DataFrame:
    """A stream over the Parquet files of a folder, or over a single file, a file a batch."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    whole = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(p).isDirectory()
    reader = spark.readStream.schema(spark.read.parquet(path).schema).option("maxFilesPerTrigger", 1)
    return reader.parquet(path) if whole else reader.option("pathGlobFilter", p.getName()).parquet(p.getParent().toString())
