"""Hard negatives by integer products over bit-slices.

Components become whole numbers and rows are packed in tiles of one label, as bit-planes
of two's complement.  A product with an anchor adds up planes, most significant first:
what the planes to come can add lies between the anchor's negative and positive sums
times their weight, so each plane halves the interval of a score, and rows whose interval
misses all that an anchor still looks for leave the comparison.  Dense rectangles of
anchors and rows are compared as matrices until few pairs are left, and pairs one by
one from there.

Anchors are the stated query set.  They go in blocks of a bounded size, each broadcast to
all tiles of all labels: first for the positives, the best of the anchor's own label,
then for the negatives, the best of other labels within the window that each positive
opens.  A task keeps the best so far of each anchor, which tightens what it looks for; all
tasks' best meet in a ranking that Spark limits before it shuffles.  Every pair is
compared, so the work grows with anchors times rows; each block is one scan for
positives and one for negatives.

Defined results: rows with a null label, a null vector or a null or non-finite component
take no part, nor do vectors whose products might not fit a long (largest component
squared times length of 2^62 or more); vectors of different length don't meet; rows that
repeat a vec_id are rows of their own, as anchors too; a null vec_id is no anchor and
sorts last; an anchor without rows of its label has no positives, and a positive whose window
is empty (any negative score) no negatives; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ._store import ROW, Workspace

SCALE, EVERY, BEST = 256, 100, 5
#: a negative's score is at least this share of the positive's
SHARE = (80, 100)
TILE_ROWS, SQUARE = 4096, 512
#: components of anchors that are broadcast at once, in bytes
BLOCK_BYTES = 16 << 20
#: share of a rectangle below which pairs go one by one
SPARSE = 1 / 16
NULL_ID = np.iinfo(np.int64).max
LOWEST = np.iinfo(np.int64).min


def whole(vectors: np.ndarray, scale: int = SCALE) -> np.ndarray:
    return np.floor(scale * vectors.astype(np.float64)).astype(np.int64)


def to_planes(x: np.ndarray) -> tuple[int, bytes]:
    """Bits of two's complement that the numbers take, and their planes, most significant first."""
    bits = 1 + max(int(x.max(initial=0)).bit_length(), int(-1 - x.min(initial=0)).bit_length())
    return bits, b"".join(np.packbits((x >> k) & 1).tobytes() for k in range(bits - 1, -1, -1))


def planes_of(packed: np.ndarray, bits: int, n: int, dim: int) -> np.ndarray:
    """Planes as numbers 0 and 1: bits x n x dim."""
    return np.unpackbits(packed.reshape(bits, -1), axis=1, count=n * dim).reshape(bits, n, dim)


def sliced_pairs(a: np.ndarray, planes: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs (row of a, row of the planes) whose product lies in one of the row's windows low..high, and the product."""
    bits, n, dim = planes.shape
    most = int(np.abs(a).sum(axis=1).max(initial=0)) << bits
    kind = np.float32 if most < 1 << 24 else np.float64 if most < 1 << 53 else np.int64  # each adds whole numbers exactly
    # bounds beyond what any product reaches may be rounded
    low, high = (np.clip(x, -most - 1, most + 1).astype(kind) for x in (low, high))
    up, down = np.maximum(a, 0).sum(axis=1).astype(kind), np.minimum(a, 0).sum(axis=1).astype(kind)
    given = a.astype(kind)
    rows, cols, score = np.arange(len(a)), np.arange(n), np.zeros((len(a), n), kind)
    i = j = s = None
    for k in range(bits):
        weight = -(1 << bits - 1) if k == 0 else 1 << bits - 1 - k
        rest = kind((1 << bits - 1 - k) - 1)
        if i is None:
            score += kind(weight) * (given[rows] @ planes[k][cols].astype(kind).T)
            below, above = score + (down * rest)[rows][:, None], score + (up * rest)[rows][:, None]
            open_ = np.zeros(score.shape, bool)
            for w in range(low.shape[1]):
                open_ |= (above >= low[rows, w][:, None]) & (below <= high[rows, w][:, None])
            if np.count_nonzero(open_) < SPARSE * open_.size:
                i, j = np.nonzero(open_)
                i, j, s = rows[i], cols[j], score[i, j]
                continue
            keep_r, keep_c = open_.any(axis=1), open_.any(axis=0)
            if keep_r.sum() < 0.8 * len(rows) or keep_c.sum() < 0.8 * len(cols):
                at = np.ix_(keep_r, keep_c)
                rows, cols, score, open_ = rows[keep_r], cols[keep_c], score[at], open_[at]
        elif len(i):
            s = s + kind(weight) * np.einsum("ij,ij->i", given[i], planes[k][j].astype(kind))
            open_ = (s + (up * rest)[i])[:, None] >= low[i]
            open_ = (open_ & ((s + (down * rest)[i])[:, None] <= high[i])).any(axis=1)
            i, j, s = i[open_], j[open_], s[open_]
    if i is None:
        i, j = np.nonzero(open_)
        i, j, s = rows[i], cols[j], score[i, j]
    return i, j, s.astype(np.int64)


class Best:
    """The best ``count`` scores of each slot so far, ties by smaller id; a slot looks within its window."""

    def __init__(self, low: np.ndarray, high: np.ndarray, count: int):
        self.windows, self.high, self.count = low.shape[1], high, count
        self.floor = low.copy()  # rises with the worst of a full slot
        self.slot, self.score, self.ids = (np.zeros(0, np.int64) for _ in range(3))
        self.low = low

    def add(self, i: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        inside = (score[:, None] >= self.floor[i]) & (score[:, None] <= self.high[i])
        r, w = np.nonzero(inside)
        if not len(r):
            return
        slot = np.concatenate([self.slot, i[r] * self.windows + w])
        score, ids = np.concatenate([self.score, score[r]]), np.concatenate([self.ids, ids[r]])
        order = np.lexsort((ids, -score, slot))
        slot, score, ids = slot[order], score[order], ids[order]
        first = np.searchsorted(slot, slot)
        rank = np.arange(len(slot)) - first
        keep = rank < self.count
        full = rank == self.count - 1
        self.floor.reshape(-1)[slot[full]] = np.maximum(self.low.reshape(-1)[slot[full]], score[full])
        self.slot, self.score, self.ids = slot[keep], score[keep], ids[keep]


def pack_tiles(ws: Workspace, rows: DataFrame, scale: int = SCALE, tile_rows: int = TILE_ROWS) -> DataFrame:
    """Rows (ROW, vec_id, label, embedding, dim) as tiles of one label and dimension, written."""

    def tile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for b in batches:
            label, dim = b["label"].to_numpy(), b["dim"].to_numpy()
            new = np.flatnonzero((label[1:] != label[:-1]) | (dim[1:] != dim[:-1])) + 1
            for i, j in zip([0, *new.tolist()], [*new.tolist(), b.num_rows]):
                while i < j:
                    full = sum(h.num_rows for h in held)
                    same = held and held[0]["label"][0].as_py() == label[i] and held[0]["dim"][0].as_py() == dim[i]
                    if held and (not same or full >= tile_rows):
                        yield _tile(held, scale)
                        held, full = [], 0
                    take = min(j - i, tile_rows - full)
                    held.append(b.slice(i, take))
                    i += take
        if held:
            yield _tile(held, scale)

    order = ["label", "dim", ROW]
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    return ws.put(dealt.select("label", "dim", ROW, "vec_id", "embedding").mapInArrow(tile, "label long, dim int, n int, bits int, rows binary, ids binary, planes binary"), "tiles")


def _tile(held: list[pa.RecordBatch], scale: int) -> pa.RecordBatch:
    t = pa.Table.from_batches(held).combine_chunks()
    dim = t["dim"][0].as_py()
    x = whole(t["embedding"].combine_chunks().flatten().to_numpy(zero_copy_only=False), scale).reshape(len(t), dim)
    bits, planes = to_planes(x)
    ids = t["vec_id"].combine_chunks().fill_null(NULL_ID)
    row = [t["label"][0].as_py(), dim, len(t), bits, t[ROW].to_numpy().astype("<i8").tobytes(), ids.to_numpy(zero_copy_only=False).astype("<i8").tobytes(), planes]
    kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip(row, kinds)], names=["label", "dim", "n", "bits", "rows", "ids", "planes"])


def _scan(tiles: DataFrame, block: dict, same: bool, count: int) -> DataFrame:
    """(anchor, window, score, id): each task's best of every anchor and window, from tiles of the anchor's label or of all others."""
    shared = tiles.sparkSession.sparkContext.broadcast(block)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = shared.value
        best = {dim: Best(g["low"], g["high"], count) for dim, g in block.items()}
        for b in batches:
            for r in range(b.num_rows):
                label, dim, n, bits = (b[c][r].as_py() for c in ("label", "dim", "n", "bits"))
                if dim not in block:
                    continue
                g, own = block[dim], best[dim]
                number, ids, packed = (np.frombuffer(b[c][r].as_buffer(), kind) for c, kind in (("rows", "<i8"), ("ids", "<i8"), ("planes", np.uint8)))
                planes = planes_of(packed, bits, n, dim)
                who = np.flatnonzero((g["label"] == label) == same)
                for p in range(0, len(who), SQUARE):
                    some = who[p:p + SQUARE]
                    for q in range(0, n, SQUARE):
                        i, j, score = sliced_pairs(g["x"][some], planes[:, q:q + SQUARE], own.floor[some], own.high[some])
                        i, j = some[i], j + q
                        other = g["row"][i] != number[j]
                        own.add(i[other], score[other], ids[j[other]])
        for dim, own in best.items():
            at = block[dim]["at"][own.slot // own.windows]
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array((own.slot % own.windows).astype(np.int32)), pa.array(own.score), pa.array(own.ids)], names=["anchor", "window", "score", "id"])

    return tiles.mapInArrow(scan, "anchor long, window int, score long, id long")


def _ranked(found: DataFrame, count: int) -> DataFrame:
    best = Window.partitionBy("anchor", "window").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= count)


def hard_negatives(
    spark: SparkSession, rows: DataFrame, every: int = EVERY, positives: int = BEST, negatives: int = BEST, share: tuple[int, int] = SHARE, scale: int = SCALE, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score for rows (vec_id, label, embedding).

    Anchors are rows whose vec_id is divisible by ``every``; a negative's score lies between
    share[0] / share[1] of the positive's and that itself.
    """
    ws = Workspace(spark, "hard-negatives")
    v = F.col("embedding").cast("array<double>")
    odd = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    largest = F.aggregate(v, F.lit(0.0), lambda m, x: F.greatest(m, F.abs(x))) * scale + 1
    rows = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), v.alias("embedding"), F.size(v).alias("dim")).filter("label is not null and embedding is not null")
    rows = rows.filter(~odd).filter(largest * largest * F.greatest(F.col("dim"), F.lit(1)) < float(1 << 62))
    rows = ws.numbered(rows, "rows")
    tiles = pack_tiles(ws, rows, scale)
    anchors = rows.filter(F.col("vec_id") % every == 0)
    total = anchors.agg(F.sum(F.col("dim") * 8 + 64)).first()[0] or 0
    n_blocks = max(1, -(-total // block_bytes))
    anchors = ws.put(anchors.withColumn("block", F.pmod(F.xxhash64(ROW), F.lit(n_blocks)).cast("int")), "anchors")
    outs = []
    for k in range(n_blocks):
        got = anchors.filter(F.col("block") == k).orderBy(ROW).select(ROW, "vec_id", "label", "dim", "embedding").toArrow()  # about block_bytes
        block = {}
        dims = got["dim"].to_numpy()
        for dim in np.unique(dims).tolist():
            at = np.flatnonzero(dims == dim)
            part = got.take(pa.array(at)).combine_chunks()
            x = whole(part["embedding"].combine_chunks().flatten().to_numpy(zero_copy_only=False), scale).reshape(len(at), dim)
            block[dim] = {"at": at, "row": part[ROW].to_numpy(), "label": part["label"].to_numpy(), "x": x, "low": np.full((len(at), 1), LOWEST), "high": np.full((len(at), 1), NULL_ID)}
        best = ws.put(_ranked(_scan(tiles, block, True, positives), positives), f"positives-{k}")
        # a positive is a window; slots without one look for nothing
        low, high, pos = np.full((len(dims), positives), NULL_ID), np.full((len(dims), positives), LOWEST), np.zeros((len(dims), positives), np.int64)
        found = best.select("anchor", "rank", "score", "id").toArrow()  # as many rows as the block's anchors have positives
        a, r, s = found["anchor"].to_numpy(), found["rank"].to_numpy() - 1, found["score"].to_numpy()
        low[a, r], high[a, r], pos[a, r] = [-(-share[0] * x // share[1]) for x in s.tolist()], s, found["id"].to_numpy()
        for g in block.values():
            g["low"], g["high"] = low[g["at"]], high[g["at"]]
        best = ws.put(_ranked(_scan(tiles, block, False, negatives), negatives), f"negatives-{k}")
        told = spark.createDataFrame(pa.table({
            "anchor": pa.array(a), "window": pa.array(r.astype(np.int32)), "positive_score": pa.array(s), "positive_id": pa.array(pos[a, r]), "anchor_id": got["vec_id"].take(pa.array(a))}))
        outs.append(best.join(F.broadcast(told), ["anchor", "window"]))
    null = lambda c: F.nullif(F.col(c), F.lit(NULL_ID)).alias(c)
    out = reduce(DataFrame.union, outs).withColumnRenamed("id", "negative_id").withColumnRenamed("score", "negative_score")
    return out.select("anchor_id", null("positive_id"), "rank", null("negative_id"), "positive_score", "negative_score")


def relabelled(rows: DataFrame) -> DataFrame:
    """The query's rows: a vec_id divisible by 7 moves its row to the next of ten labels."""
    label = F.col("label").cast("long")
    return rows.withColumn("label", F.when(F.col("vec_id") % 7 == 0, F.try_add(label, F.lit(1)) % 10).otherwise(label))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract rows: anchors are the rows whose vec_id is divisible by 100, against all rows."""
    return hard_negatives(spark, relabelled(spark.read.parquet(f"{sf_dir}/embeddings.parquet")))


SQL = """
WITH usable AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, a.label AS anchor_label, b.vec_id, b.label, list_dot_product(a.v, b.v)::BIGINT AS score
  FROM usable a JOIN usable b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)),
positives AS (
  SELECT anchor_id, anchor_label, vec_id AS positive_id, score AS positive_score FROM scored WHERE label = anchor_label
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, p.positive_id, (row_number() OVER best)::INTEGER AS rank, s.vec_id AS negative_id, p.positive_score, s.score AS negative_score
FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND s.label <> p.anchor_label AND 80 * p.positive_score <= 100 * s.score AND s.score <= p.positive_score
WINDOW best AS (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id)
QUALIFY row_number() OVER best <= 5
"""
