"""Order-dependent building blocks that don't put all rows in one task.

Rows are ordered by a whole number.  Work is done within buckets of that number and
over one row for each bucket, so a task's share is bounded by the bucket.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

BUCKET = 1 << 16


def _bucketed(df: DataFrame, order: str, bucket: int) -> DataFrame:
    return df.withColumn("_bucket", F.floor(F.col(order) / bucket))


#: buckets of buckets; two cover 2^32 keys, three 2^48
LEVELS = 3


def carried(df: DataFrame, key: str, value: str, out: str, combine=F.max, partition: tuple[str, ...] = (), bucket: int = BUCKET, levels: int = LEVELS) -> DataFrame:
    """The aggregate (F.max or F.sum) of ``value`` over the rows of smaller ``key``, unique whole numbers within ``partition``.

    Buckets of keys are aggregated by themselves and carry over to the buckets after them,
    which are bucketed in turn: no task sees more than a bucket's rows.
    """
    b, t, own, above = (f"_{n}{levels}" for n in ("b", "t", "own", "above"))
    if levels == 1:  # as many rows as a bucket takes, and a key that isn't known to be constant
        alone = Window.partitionBy(*partition, F.expr(f"`{key}` div {1 << 62}")).orderBy(key).rowsBetween(Window.unboundedPreceding, -1)
        return df.withColumn(out, combine(value).over(alone))
    # never null, so that the join below filters neither of the two readers of the rows, and one exchange serves both
    rows = df.withColumn(b, F.coalesce(F.expr(f"`{key}` div {bucket}"), F.lit(0).cast("long")))
    inside = Window.partitionBy(*partition, b).orderBy(key).rowsBetween(Window.unboundedPreceding, -1)
    totals = rows.groupBy(*partition, b).agg(combine(value).alias(t))
    higher = carried(totals, b, t, above, combine, partition, bucket, levels - 1).select(*partition, b, above)
    joined = rows.join(higher, [*partition, b]).withColumn(own, combine(value).over(inside))
    both = F.greatest(own, above) if combine is F.max else F.coalesce(F.col(own) + F.col(above), own, above)
    return joined.withColumn(out, both).drop(b, own, above)


def forward_fill(df: DataFrame, value: str, order: str, out: str, bucket: int = BUCKET, partition: tuple[str, ...] = ()) -> DataFrame:
    """The latest non-null ``value`` up to each row, within ``partition``."""
    rows = _bucketed(df, order, bucket)
    inside = Window.partitionBy(*partition, "_bucket").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    seen = F.col(value).isNotNull()
    last = rows.groupBy(*partition, "_bucket").agg(F.max_by(F.when(seen, F.col(value)), F.when(seen, F.col(order))).alias("_last"))
    across = Window.partitionBy(*partition).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    carry = last.select(*partition, "_bucket", F.last("_last", ignorenulls=True).over(across).alias("_carry"))
    filled = rows.withColumn(out, F.last(value, ignorenulls=True).over(inside))
    return filled.join(carry, [*partition, "_bucket"], "left").withColumn(out, F.coalesce(out, "_carry")).drop("_bucket", "_carry")


def number_rows(df: DataFrame, order: str, out: str, bucket: int = BUCKET) -> DataFrame:
    """0-based numbers in the order of a unique whole number."""
    rows = _bucketed(df, order, bucket)
    sizes = rows.groupBy("_bucket").agg(F.count("*").alias("_n"))
    before = sizes.select("_bucket", F.coalesce(F.sum("_n").over(Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("_bucket").orderBy(order)
    return rows.join(before, "_bucket").withColumn(out, F.row_number().over(inside) - 1 + F.col("_before")).drop("_bucket", "_before")


def number_groups(df: DataFrame, key: str, order: str, out: str) -> DataFrame:
    """0-based group numbers by the first appearance of each key."""
    firsts = df.groupBy(key).agg(F.min(order).alias("_first"))
    numbered = number_rows(firsts, "_first", out).select(F.col(key).alias("_key"), out)
    return df.join(numbered, F.col(key).eqNullSafe(F.col("_key"))).drop("_key")
