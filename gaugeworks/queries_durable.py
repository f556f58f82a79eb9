"""Queries of streams with state, releases, digest trees and ranges over whole tables, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from gaugeworks.operators import grouping, metric
from gaugeworks.queries import _CONVS, _DIGESTED, _dialogue_plan, _dialogues, _mean_sql, register, table
from gaugeworks.sources.releases import Releases
from gaugeworks.sources.sinks import FAN_OUT, frame_difference
from gaugeworks.streaming import scratch, total_table
from gaugeworks.streaming.dialogues import start_dialogue_metric


def _streamed(spark, sf, plan):
    """The metric over a stream whose batches cut through every dialogue, started twice over the same state."""
    folder, rows = scratch(spark, "dialogues"), _dialogues(spark, sf)
    rows.repartition(4, F.xxhash64("conv_id", "turn")).write.parquet(f"{folder}/in")
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
    for _ in range(2):
        start_dialogue_metric(stream, plan, f"{folder}/sums", f"{folder}/state", availableNow=True).awaitTermination()
    return total_table(spark, plan, f"{folder}/sums").drop(*metric.VIOLATIONS)


register(_mean_sql("s0::DOUBLE", _CONVS), "stream_dialogue_mean")(lambda spark, sf: _streamed(spark, sf, _dialogue_plan()).select(*_MEAN))
register(_mean_sql("s0::DOUBLE", _CONVS, "w0"), "stream_dialogue_weighted")(lambda spark, sf: _streamed(spark, sf, _dialogue_plan(weight="w")).select(*_MEAN))

_MEAN = ["total_units", "scored_units", "excluded_units", "weight_sum", "value"]


@register("SELECT doc_id, quality, toxic FROM labels WHERE quality = 1")
def release_current(spark, sf):
    """What a folder's readers see while a later run has staged its table but hasn't been released."""
    store, labels = Releases(spark, scratch(spark, "releases")), table(spark, sf, "labels")
    for kept in ("quality = 0", "quality = 1"):
        draft = store.begin()
        draft.put_table("labels", labels.filter(kept))
        draft.put_json("report.json", {"kept": kept})
        draft.commit()
    store.begin().put_table("labels", labels)
    return store.current().table(spark, "labels")


@register(f"""
SELECT DISTINCT '{_DIGESTED[2]}' AS column_name, o_orderkey // {FAN_OUT} * {FAN_OUT} AS first_row, o_orderkey // {FAN_OUT} * {FAN_OUT} + {FAN_OUT - 1} AS last_row FROM orders WHERE o_orderkey % 1777 = 5
UNION ALL SELECT DISTINCT '{_DIGESTED[0]}', o_orderkey // {FAN_OUT} * {FAN_OUT}, o_orderkey // {FAN_OUT} * {FAN_OUT} + {FAN_OUT - 1} FROM orders WHERE o_orderkey % 3001 = 7""")
def frame_difference_blocks(spark, sf):
    """Blocks of two tables that differ in a few cells, found from the roots of their digest trees down."""
    orders = table(spark, sf, "orders").select("o_orderkey", *_DIGESTED)
    changed = orders.withColumns({
        _DIGESTED[2]: F.when(F.col("o_orderkey") % 1777 == 5, None).otherwise(F.col(_DIGESTED[2])),
        _DIGESTED[0]: F.when(F.col("o_orderkey") % 3001 == 7, F.col(_DIGESTED[0]) + 1).otherwise(F.col(_DIGESTED[0]))})
    return frame_difference(orders, changed, "o_orderkey", list(_DIGESTED))


@register("""
WITH r AS (SELECT l_orderkey * 30 + l_linenumber AS r1, l_orderkey * 30 + l_linenumber + l_quantity::BIGINT AS r2 FROM lineitem),
s AS (SELECT *, CASE WHEN r1 > max(r2) OVER (ORDER BY r1, r2 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 1 ELSE 0 END AS new FROM r),
i AS (SELECT *, sum(new) OVER (ORDER BY r1, r2 ROWS UNBOUNDED PRECEDING) AS n FROM s)
SELECT min(r1) AS r1, max(r2) AS r2 FROM i GROUP BY n""")
def group_islands_all(spark, sf):
    """Ranges of one whole table, without a key that would part them."""
    r1 = F.col("l_orderkey") * 30 + F.col("l_linenumber")
    return grouping.merge_islands(table(spark, sf, "lineitem").select(r1.alias("r1"), (r1 + F.col("l_quantity").cast("long")).alias("r2")))
