"""Metrics of dialogues over streams: a dialogue's rows may come in any batch and order.

Spark's state store holds a summary of each dialogue, keyed by the dialogue: the least and
greatest value of each source and of the weight, and three counts, whatever its length.
A batch merges its rows into the summaries of the dialogues that it touches.  Where that
changes a dialogue, its earlier share of the metric is taken back and its present one
added: both are rows of the batch's sums, so that the sums of all batches add up, exactly,
to those of the whole table.  A batch that is replayed writes the same sums again under
its number.

With ``event_time`` and ``hold`` a dialogue's summary is given up once the watermark has
passed its latest row by ``hold``; its share stays in the sums.  Rows behind the
watermark are left out by Spark; a dialogue whose rows lie further apart than ``hold`` and
the watermark's delay counts as several.  Without them summaries are kept for good.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery
from pyspark.sql.types import LongType, StructField, StructType

from gaugeworks.errors import PlanError
from gaugeworks.operators.metric import dialogue_rows, dialogue_summary, dialogue_units, unit_sums
from gaugeworks.plans.contracts import MetricPlan

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_COUNTS = ("n_w", "n", "broken")


class DialogueSummaries(StatefulProcessor):
    """Merges rows into a dialogue's summary and tells what it was and what it is."""

    def __init__(self, keys: list[str], fields: list[str], schema: StructType, hold_ms: int | None):
        self.keys, self.fields, self.schema, self.hold_ms = keys, fields, schema, hold_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.summary = handle.getValueState("summary", self.schema)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        before = self.summary.get() if self.summary.exists() else None
        now = dict(zip([*self.fields, "latest"], before)) if before is not None else dict.fromkeys(self.fields)
        for name in _COUNTS:
            now[name] = now[name] or 0
        latest = now.get("latest") or 0
        for batch in rows:
            for name in self.fields:
                if name in _COUNTS:
                    continue
                seen = [x for x in batch[name[:-4]].tolist() if not pd.isna(x)]
                pick = min if name.endswith("_min") else max
                now[name] = pick([*seen, *([] if now[name] is None else [now[name]])], default=None)
            now["n"] += len(batch)
            now["n_w"] += int(batch["w"].notna().sum())
            now["broken"] += int(batch["broken"].sum())
            if self.hold_ms is not None:
                latest = max(latest, int(batch["seen_ms"].max()))
        after = tuple(now[f] for f in self.fields)
        self.summary.update((*after, latest))
        if self.hold_ms is not None:
            for t in list(self.handle.listTimers()):
                self.handle.deleteTimer(t[0] if isinstance(t, tuple) else t)
            self.handle.registerTimer(latest + self.hold_ms)
        if before is None:
            yield self._told(key, [(1, after)])
        elif tuple(before)[:-1] != after:
            yield self._told(key, [(-1, tuple(before)[:-1]), (1, after)])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.summary.clear()
        yield from ()

    def _told(self, key, summaries: list[tuple[int, tuple]]) -> pd.DataFrame:
        rows = [(*key, sign, *s) for sign, s in summaries]
        return pd.DataFrame(rows, columns=[*self.keys, "sign", *self.fields], dtype=object)

    def close(self) -> None:
        pass


def summary_changes(stream: DataFrame, plan: MetricPlan, by: list[str] | None = None, event_time: str | None = None, hold: int | None = None) -> DataFrame:
    """A stream of (by, unit, sign, summary): -1 for a summary that no longer holds, 1 for the present one.

    ``stream`` has its watermark on ``event_time``, if that is given; ``hold`` is in seconds.
    """
    if plan.unit != "dialogue":
        raise PlanError("Only units that span rows need a state", unit=plan.unit)
    if (event_time is None) != (hold is None):
        raise PlanError("An event time and how long it is held go together")
    keys = [*(by or []), "unit"]
    rows = dialogue_rows(stream, plan, by, *([event_time] if event_time else []))
    # kinds of a summary follow from the aggregates over the same rows
    spark = stream.sparkSession
    like = spark.createDataFrame([], rows.schema).groupBy(*keys).agg(*dialogue_summary(plan)).schema
    fields = [f for f in like.fields if f.name not in keys]
    if event_time:
        rows = rows.withColumn("seen_ms", F.unix_millis(F.col(event_time).cast("timestamp")))
    state = StructType([StructField(f.name, f.dataType, True) for f in fields] + [StructField("latest", LongType(), True)])
    out = StructType([*(StructField(k, rows.schema[k].dataType, True) for k in keys), StructField("sign", LongType(), True), *(StructField(f.name, f.dataType, True) for f in fields)])
    return rows.groupBy(*keys).transformWithStateInPandas(
        statefulProcessor=DialogueSummaries(keys, [f.name for f in fields], state, None if hold is None else int(hold * 1000)),
        outputStructType=out, outputMode="Update", timeMode="EventTime" if event_time else "None")


def signed_sums(changes: DataFrame, plan: MetricPlan, by: list[str] | None = None) -> DataFrame:
    """Sums of what a batch adds, less the sums of what it takes back."""
    by = by or []
    sums = unit_sums(dialogue_units(changes, plan, [*by, "sign"]), plan, [*by, "sign"])
    kinds = {f.name: f.dataType for f in sums.schema.fields}
    return sums.select(*by, *((F.col(c) * F.col("sign")).cast(kinds[c]).alias(c) for c in sums.columns if c not in (*by, "sign")))


def start_dialogue_metric(
    stream: DataFrame, plan: MetricPlan, sink: str, checkpoint: str, by: list[str] | None = None, event_time: str | None = None, hold: int | None = None, **trigger
) -> StreamingQuery:
    """Start a query that writes each batch's signed sums below ``sink``; ``total_table`` adds them up."""
    changes = summary_changes(stream, plan, by, event_time, hold)

    def write(batch: DataFrame, number: int) -> None:
        signed_sums(batch, plan, by).write.mode("overwrite").parquet(f"{sink}/batch={number}")

    conf = stream.sparkSession.conf
    before = conf.get(_PROVIDER, None)
    conf.set(_PROVIDER, _ROCKS)  # the query keeps the setting that it starts with
    try:
        writer = changes.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint)
        return (writer.trigger(**trigger) if trigger else writer).start()
    finally:
        conf.unset(_PROVIDER) if before is None else conf.set(_PROVIDER, before)
