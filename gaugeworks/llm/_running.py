"""Running numbers and running hashes of a table in a global order.

Rows are dealt by ranges of (key, order), so a key of any size spreads over tasks.
A task numbers its own rows; what its first key had in earlier tasks is worked out
from one row a task and added afterwards.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from ._store import Workspace


def running(ws: Workspace, df: DataFrame, key: str, order: list[Column | str], keep: list[str], hashes: list[str], name: str) -> DataFrame:
    """``key``, ``keep``, pos (from 1 within the key) and, for each of ``hashes``, run_<hash>: the exclusive-or up to the row; written.

    ``key`` and the hashes are long and not null.
    """
    ordered = df.repartitionByRange(key, *order).sortWithinPartitions(key, *order).select(key, *keep, *(h for h in hashes if h not in keep))
    kinds = {c: t for c, t in ordered.dtypes}
    schema = ", ".join([f"{key} long", *(f"{c} {kinds[c]}" for c in keep), "pos long", *(f"run_{h} long" for h in hashes), "part int"])

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, count, carried = TaskContext.get().partitionId(), None, 0, [0] * len(hashes)
        for b in batches:
            n = b.num_rows
            if not n:
                continue
            keys = b[key].to_numpy()
            starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
            segment = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, n)))
            goes_on = last is not None and keys[0] == last
            pos = np.arange(n) - starts[segment] + 1
            first = segment == 0
            pos[first] += count if goes_on else 0
            runs = []
            for i, h in enumerate(hashes):
                total = np.bitwise_xor.accumulate(b[h].to_numpy())
                before = np.concatenate([[0], total])[starts]
                run = total ^ before[segment]
                if goes_on:
                    run[first] ^= carried[i]
                runs.append(run)
            last, count, carried = keys[-1], int(pos[-1]), [int(r[-1]) for r in runs]
            yield pa.RecordBatch.from_arrays(
                [b[key], *(b[c] for c in keep), pa.array(pos), *map(pa.array, runs), pa.array(np.full(n, part, np.int32))],
                names=[key, *keep, "pos", *(f"run_{h}" for h in hashes), "part"],
            )

    rows = ws.put(ordered.mapInArrow(number, schema), name)
    ends = rows.groupBy("part").agg(F.min(key).alias("lo"), F.max(F.struct(key, "pos", *(f"run_{h}" for h in hashes))).alias("top")).orderBy("part").collect()  # one row a task
    carries, now, sums = [], None, [0] * (1 + len(hashes))
    for r in ends:
        goes_on = now is not None and r["lo"] == now
        if goes_on:
            carries.append((r["part"], now, *sums))
        own = list(r["top"])[1:]
        if goes_on and r["top"][0] == now:
            sums = [sums[0] + own[0], *(a ^ b for a, b in zip(sums[1:], own[1:]))]
        else:
            now, sums = r["top"][0], own
    if not carries:
        return rows.drop("part")
    carry = rows.sparkSession.createDataFrame(carries, ", ".join(["part int", f"{key} long", "_pos long", *(f"_{h} long" for h in hashes)]))
    joined = rows.join(F.broadcast(carry), ["part", key], "left")
    zero = F.lit(0).cast("long")
    return joined.select(key, *keep, (F.col("pos") + F.coalesce("_pos", zero)).alias("pos"), *(F.col(f"run_{h}").bitwiseXOR(F.coalesce(F.col(f"_{h}"), zero)).alias(f"run_{h}") for h in hashes))
