"""Sharding: a Feistel permutation with cycle walking over global row numbers.

Rows are numbered in the order of (id, text checksum, size) over the whole table:
range-partitioned, numbered within each partition, and moved up by the sizes of
the partitions before it.  The permutation gives each row a place; place p is slot
p div n of shard p mod n.  Row counts of shards differ by one at most, the order is
reproducible from the key, and any row's place can be computed from its number.

Defined results: null ids sort first, null and empty texts have 8 bytes and
checksum 0, rows that are equal in id, size and checksum are interchangeable, an
empty table gives no rows.  Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from ._store import Workspace

SHARDS = 24
KEY = 20240611
ROUNDS = 6
_P = 2147483647


def round_keys(key: int = KEY, rounds: int = ROUNDS) -> list[tuple[int, int, int]]:
    """Multiplier and two addends of each round, from a multiplicative generator."""
    out, x = [], key % _P or 1
    for _ in range(rounds):
        row = []
        for _ in range(3):
            x = x * 48271 % _P
            row.append(x)
        out.append(tuple(row))
    return out


def half_bits(n: int) -> int:
    """Half of the bits of the smallest even-sized domain that holds n rows."""
    return max(1, -(-max(1, n - 1).bit_length() // 2))


def permute(numbers: np.ndarray, n: int, key: int = KEY) -> np.ndarray:
    """The places of row numbers 0..n-1; walks the cycle until a place is below n."""
    h = half_bits(n)
    mask, keys = (1 << h) - 1, round_keys(key)
    x = numbers.astype(np.int64)
    todo = np.arange(len(x))
    while len(todo):
        left, right = x[todo] >> h, x[todo] & mask
        for a, b, c in keys:
            t = (right % _P * a + b) % _P
            left, right = right, left ^ ((t * (t % 65521) + c) % _P & mask)
        x[todo] = (left << h) | right
        todo = todo[x[todo] >= n]
    return x


def place_rows(spark: SparkSession, rows: DataFrame, order: list[str], n_shards: int = SHARDS, key: int = KEY) -> DataFrame:
    """Add shard and slot to rows; ``order`` numbers them, ties are interchangeable."""
    ws = Workspace(spark, "sharding")
    names = rows.columns

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, pid = 0, TaskContext.get().partitionId()
        for b in batches:
            n = b.num_rows
            cols = [*b.columns[: len(names)], pa.array(np.full(n, pid, np.int32)), pa.array(np.arange(at, at + n))]
            yield pa.RecordBatch.from_arrays(cols, names=[*names, "_gaugeworks_part", "_gaugeworks_at"])
            at += n

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    # equal rows may fill more than one range: the scan's own numbers part them
    tied = rows.withColumn("_gaugeworks_tie", F.monotonically_increasing_id())
    ordered = tied.repartitionByRange(*order, "_gaugeworks_tie").sortWithinPartitions(*order, "_gaugeworks_tie")
    numbered = ws.put(ordered.mapInArrow(number, f"{kinds}, _gaugeworks_part int, _gaugeworks_at long"), "numbered")
    sizes = sorted((r["_gaugeworks_part"], r["n"]) for r in numbered.groupBy("_gaugeworks_part").agg(F.count("*").alias("n")).collect())  # a row a partition
    before, total = {}, 0
    for part, n in sizes:
        before[part] = total
        total += n

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            part, at = b.column(len(names)).to_numpy(), b.column(len(names) + 1).to_numpy()
            kinds_, where = np.unique(part, return_inverse=True)
            p = permute(at + np.array([before[k] for k in kinds_.tolist()], np.int64)[where], total, key)
            cols = [*b.columns[: len(names)], pa.array((p % n_shards).astype(np.int32)), pa.array(p // n_shards)]
            yield pa.RecordBatch.from_arrays(cols, names=[*names, "shard", "slot"])

    return numbered.mapInArrow(place, f"{kinds}, shard int, slot long")


def shard_documents(spark: SparkSession, docs: DataFrame, n_shards: int = SHARDS, key: int = KEY) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    return place_rows(spark, rows, ["doc_id", "text_crc32", "size"], n_shards, key)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract rows over all documents; the law is ``rows``."""
    placed = shard_documents(spark, spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return contract_rows(placed)


def contract_rows(placed: DataFrame) -> DataFrame:
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def _byte_steps() -> list[int]:
    """Checksum steps of a byte, by the rule for a bit."""
    out = list(range(256))
    for _ in range(8):
        out = [c >> 1 ^ (0xEDB88320 if c & 1 else 0) for c in out]
    return out


def _sql() -> str:
    body = "SELECT num, place >> h AS l, place & ((1::BIGINT << h) - 1) AS r, h, n FROM walk WHERE NOT done"
    for a, b, c in round_keys():
        t = f"((r % {_P} * {a} + {b}) % {_P})"
        body = f"SELECT num, r AS l, xor(l, ({t} * ({t} % 65521) + {c}) % {_P} & ((1::BIGINT << h) - 1)) AS r, h, n FROM ({body})"
    return rf"""
WITH RECURSIVE hexed AS (SELECT doc_id, hex(coalesce(text, '')) AS x FROM documents),
sized AS (
  SELECT doc_id, len(x) // 2 + 8 AS size,
         xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(len(x) // 2), lambda i: ('0x' || x[2 * i + 1:2 * i + 2])::BIGINT)),
             lambda c, b: xor(c >> 8, {_byte_steps()}[xor(c, b) % 256 + 1])), 4294967295) AS text_crc32
  FROM hexed),
rows_ AS (
  SELECT *, row_number() OVER (ORDER BY doc_id NULLS FIRST, text_crc32, size) - 1 AS num, count(*) OVER () AS n FROM sized),
halves AS (SELECT num, n, greatest(1, (length(bin(greatest(1, n - 1))) + 1) // 2) AS h FROM rows_),
walk AS (
  SELECT num, num AS place, false AS done, h, n FROM halves
  UNION ALL
  SELECT num, (l << h) | r AS place, ((l << h) | r) < n AS done, h, n FROM ({body}))
SELECT doc_id, size::BIGINT AS size, text_crc32::BIGINT AS text_crc32, 'rows' AS law, (place % {SHARDS})::INTEGER AS shard,
       (place // {SHARDS})::BIGINT AS slot, NULL::INTEGER AS grown_shard
FROM rows_ JOIN walk USING (num) WHERE done
"""


SQL = _sql()
