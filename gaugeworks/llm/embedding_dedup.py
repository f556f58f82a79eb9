"""Embedding near-dedup: PCA-ordered tiled comparison within a label.

Equal vectors of a label are one class.  Class vectors, scaled to length one, are
turned to the principal axes (of a bounded sample: any rotation keeps cosines),
ordered along the first axis and cut into tiles.  Two tiles of a label meet if
their ranges on that axis are close enough for the threshold.  A meeting adds up
products a few axes at a time, largest variance first; what the other axes can
still add is at most the product of the suffix norms, and rows and columns that
cannot reach the threshold leave the comparison.  A tile's memory is fixed and its rows
meet in squares of ``square`` rows, links are counted and joined within the meeting, and
no pair leaves it but the edges of a spanning forest.  Exactness has its price: tiles of a
label that lie close enough on the first axis all meet, so that meetings grow with the
square of a label's rows; the pairs of tiles of one label are listed by many tasks.

Defined results: vectors that are null, zero, or hold null or non-finite
components, and rows with a null label, link with nothing; vectors of different
length don't link; rows that repeat a vec_id count as vectors of
their own, but share their links if their vectors differ; a null
vec_id sorts last.  Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from ._components import components
from ._store import Workspace

THRESHOLD = 0.93
TILE_ROWS, SQUARE = 4096, 1024
#: tiles of a label that one task lists the pairs of
LISTED = 64
#: vectors that fit the principal axes
PCA_ROWS = 4096
STEP = 8
_SLACK = 1e-9


def scaled(x: np.ndarray) -> np.ndarray:
    """Rows times a power of two each, largest component about one: exact, and norms don't overflow."""
    return np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, keepdims=True))[1])


def principal_axes(sample: np.ndarray) -> np.ndarray:
    """Columns are axes by falling second moment of unit vectors."""
    sample = scaled(sample)
    unit = sample / np.linalg.norm(sample, axis=1, keepdims=True)
    values, axes = np.linalg.eigh(unit.T @ unit)
    return axes[:, np.argsort(-values)]


def _dense(vectors: pa.Array, dim: int) -> np.ndarray:
    return vectors.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim).astype(np.float64)


class _Turned:
    """Unit vectors on the principal axes, and the norms of what follows each axis."""

    def __init__(self, x: np.ndarray, axes: np.ndarray):
        self.given = x = scaled(x)
        self.on_axes = x / np.linalg.norm(x, axis=1, keepdims=True) @ axes
        self.tail = np.sqrt(np.maximum(0, np.cumsum((self.on_axes**2)[:, ::-1], axis=1)[:, ::-1]))


def close_pairs(a: np.ndarray, b: np.ndarray, axes: np.ndarray, threshold: float, square: int = SQUARE, same: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers of a and b whose cosine reaches the threshold; those of a pair's smaller row first if both are the same."""
    ta = _Turned(a, axes)
    tb = ta if same else _Turned(b, axes)
    reach = _reach(threshold)
    i, j = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for p in range(0, len(a), square):
        for q in range(p if same else 0, len(b), square):
            x, y = ta.on_axes[p:p + square, 0], tb.on_axes[q:q + square, 0]
            if x.min() > y.max() + reach or y.min() > x.max() + reach:
                continue
            r, c = _square_pairs(ta, tb, slice(p, p + square), slice(q, q + square), threshold)
            i.append(r + p)
            j.append(c + q)
    i, j = np.concatenate(i), np.concatenate(j)
    return (i[i < j], j[i < j]) if same else (i, j)


def _reach(threshold: float) -> float:
    """How far apart on an axis unit vectors of that cosine can be."""
    return float(np.sqrt(2 * (1 - threshold))) + 1e-9


def _square_pairs(turned_a: _Turned, turned_b: _Turned, at_a: slice, at_b: slice, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    a, b, ra, rb, ta, tb = turned_a.given[at_a], turned_b.given[at_b], turned_a.on_axes[at_a], turned_b.on_axes[at_b], turned_a.tail[at_a], turned_b.tail[at_b]
    dim = ra.shape[1]
    rows, cols = np.arange(len(a)), np.arange(len(b))
    partial = np.zeros((len(a), len(b)))
    for k in range(0, dim, STEP):
        partial += ra[rows, k:k + STEP] @ rb[cols, k:k + STEP].T
        to = k + STEP
        reach = partial + (np.outer(ta[rows, to], tb[cols, to]) if to < dim else 0)
        open_ = reach >= threshold - _SLACK
        keep_r, keep_c = open_.any(axis=1), open_.any(axis=0)
        if not keep_r.any():
            return rows[:0], cols[:0]
        if to < dim and (keep_r.sum() < 0.8 * len(rows) or keep_c.sum() < 0.8 * len(cols)):
            partial = partial[np.ix_(keep_r, keep_c)]
            rows, cols = rows[keep_r], cols[keep_c]
    i, j = np.nonzero(open_)
    i, j = rows[i], cols[j]
    x, y = a[i], b[j]  # decided on the vectors as given
    cos = np.einsum("ij,ij->i", x, y) / (np.sqrt(np.einsum("ij,ij->i", x, x)) * np.sqrt(np.einsum("ij,ij->i", y, y)))
    sure = cos >= threshold
    return i[sure], j[sure]


def local_roots(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The smallest node of each of n nodes' component under edges i-j."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[i], root[j])
        new = root.copy()
        np.minimum.at(new, root[i], low)
        np.minimum.at(new, root[j], low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def near_vectors(spark: SparkSession, rows: DataFrame, threshold: float = THRESHOLD, tile_rows: int = TILE_ROWS) -> DataFrame:
    """vec_id, n_links, component_id and kept of each vector."""
    ws = Workspace(spark, "embedding-dedup")
    kind = "float" if rows.schema["embedding"].dataType.simpleString() == "array<float>" else "double"  # components stay as exact as they are
    width = "<f4" if kind == "float" else "<f8"
    rows = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast(f"array<{kind}>").alias("embedding"), F.col("label").cast("long").alias("label"))
    v = F.col("embedding")
    odd = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    usable = F.col("label").isNotNull() & v.isNotNull() & F.exists(v, lambda x: x != 0) & ~F.exists(v, odd)
    zero = F.lit(0.0).cast(kind)
    same = F.transform(v, lambda x: F.when(x == 0, zero).otherwise(x))  # one zero
    digest = F.when(F.coalesce(usable, F.lit(False)), F.struct(F.xxhash64(F.lit(1), F.size(v), same).alias("x"), F.xxhash64(F.lit(2), F.size(v), same).alias("y")))
    seen = ws.put(rows.select("vec_id", "label", digest.alias("digest")), "seen")
    top = F.coalesce(F.col("vec_id"), F.lit(np.iinfo(np.int64).max))
    classes = ws.put(seen.filter("digest is not null").groupBy("label", "digest").agg(F.min(top).alias("class_id"), F.count("*").alias("copies")), "classes")
    member = ws.put(seen.filter("digest is not null").join(classes, ["label", "digest"]).select("vec_id", "label", "digest"), "member")
    named = rows.withColumn("class_id", top).withColumn("digest", digest).join(classes, ["label", "digest", "class_id"])
    heads = ws.put(named.groupBy("class_id", "label", "digest").agg(F.any_value("embedding").alias("embedding"), F.any_value("copies").alias("copies")).select("class_id", "label", "copies", "embedding", F.size("embedding").alias("dim")), "heads")

    axes = {}
    for (dim,) in heads.select("dim").distinct().collect():  # lengths of vectors, a few
        sample = heads.filter(F.col("dim") == dim).orderBy(F.xxhash64("class_id"), "class_id").limit(PCA_ROWS).select("embedding").collect()
        axes[dim] = principal_axes(np.array([r[0] for r in sample], np.float64))
    axes = spark.sparkContext.broadcast(axes)  # dim x dim each

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            dims = b["dim"].to_numpy()
            first = np.zeros(b.num_rows)
            for dim in np.unique(dims).tolist():
                at = np.flatnonzero(dims == dim)
                x = scaled(_dense(b["embedding"].take(pa.array(at)), dim))
                first[at] = (x / np.linalg.norm(x, axis=1, keepdims=True)) @ axes.value[dim][:, 0]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(first)], names=[*b.schema.names, "first"])

    def tile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seq = TaskContext.get().partitionId() << 32
        held: list[pa.RecordBatch] = []
        for b in batches:
            label, dim = b["label"].to_numpy(), b["dim"].to_numpy()
            new = np.flatnonzero((label[1:] != label[:-1]) | (dim[1:] != dim[:-1])) + 1
            for i, j in zip([0, *new.tolist()], [*new.tolist(), b.num_rows]):
                while i < j:
                    full = sum(h.num_rows for h in held)
                    same = held and held[0]["label"][0].as_py() == label[i] and held[0]["dim"][0].as_py() == dim[i]
                    if held and (not same or full >= tile_rows):
                        yield _tile(held, seq, width)
                        held, seq, full = [], seq + 1, 0
                    take = min(j - i, tile_rows - full)
                    held.append(b.slice(i, take))
                    i += take
        if held:
            yield _tile(held, seq, width)

    placed = ws.put(heads.mapInArrow(project, "class_id long, label long, copies long, embedding array<" + kind + ">, dim int, first double"), "placed")
    ordered = placed.repartitionByRange("label", "dim", "first", "class_id").sortWithinPartitions("label", "dim", "first", "class_id")
    tiles = ws.put(ordered.mapInArrow(tile, "tile long, label long, dim int, low double, high double, ids binary, copies binary, vectors binary"), "tiles")
    reach = _reach(threshold)
    head = tiles.select("tile", "label", "dim", "low", "high")
    # a label's tiles are dealt to lists; each tile meets the lists of its label
    lists = head.groupBy("label", "dim").agg(F.ceil(F.count("*") / LISTED).alias("lists"))
    other = head.join(lists, ["label", "dim"]).select(F.col("tile").alias("tile_b"), "label", "dim", F.col("low").alias("low_b"), F.col("high").alias("high_b"), F.pmod(F.xxhash64("tile"), "lists").alias("list"))
    each = head.join(lists, ["label", "dim"]).withColumn("list", F.explode(F.sequence(F.lit(0).cast("long"), F.col("lists") - 1)))
    near = (F.col("tile") <= F.col("tile_b")) & (F.col("low_b") <= F.col("high") + reach) & (F.col("high_b") >= F.col("low") - reach)
    pairs = ws.put(each.join(other, ["label", "dim", "list"]).filter(near).select(F.col("tile").alias("tile_a"), "tile_b"), "meetings")
    packed = tiles.select("tile", "dim", "ids", "copies", "vectors")
    side = lambda x: packed.select(*(F.col(c).alias(f"{c}_{x}") for c in packed.columns))
    met = pairs.join(side("a"), "tile_a").join(side("b"), "tile_b")

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in range(b.num_rows):
                out = _meeting({k: b[k][r] for k in b.schema.names}, axes.value, threshold, width)
                if out is not None:
                    yield out

    found = ws.put(met.mapInArrow(meet, "class_id long, links long, root long"), "found")
    links = found.groupBy("class_id").agg(F.sum("links").alias("links"))
    comp = components(spark, found.select(F.col("class_id").alias("a"), F.col("root").alias("b")), ws)
    told = ws.put(
        classes.join(links, "class_id", "left").join(comp.withColumnRenamed("node", "class_id"), "class_id", "left")
        .select("label", "digest", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "class_id").alias("component_id")), "told")
    alone = seen.filter("digest is null").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    top_id = F.lit(np.iinfo(np.int64).max)
    out = member.join(told, ["label", "digest"]).select("vec_id", "n_links", F.nullif(F.col("component_id"), top_id).alias("component_id")).union(alone)
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def _tile(held: list[pa.RecordBatch], tile: int, width: str) -> pa.RecordBatch:
    t = pa.Table.from_batches(held).combine_chunks()
    first = t["first"].to_numpy()
    vectors = t["embedding"].combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(width)
    ids, copies = (t[c].to_numpy().astype("<i8").tobytes() for c in ("class_id", "copies"))
    row = [tile, t["label"][0].as_py(), t["dim"][0].as_py(), float(first.min()), float(first.max()), ids, copies, vectors.tobytes()]
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.float64(), pa.float64(), pa.binary(), pa.binary(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip(row, kinds)], names=["tile", "label", "dim", "low", "high", "ids", "copies", "vectors"])


def _meeting(row: dict, axes: dict[int, np.ndarray], threshold: float, width: str) -> pa.RecordBatch | None:
    """Links and local roots of the classes of two tiles."""
    get = lambda c, kind: np.frombuffer(row[c].as_buffer(), kind)
    dim, same = row["dim_a"].as_py(), row["tile_a"].as_py() == row["tile_b"].as_py()
    ids, copies = get("ids_a", "<i8"), get("copies_a", "<i8")
    a = get("vectors_a", width).reshape(-1, dim).astype(np.float64)
    b = a if same else get("vectors_b", width).reshape(-1, dim).astype(np.float64)
    i, j = close_pairs(a, b, axes[dim], threshold, same=same)
    if not same:
        ids, copies, j = np.concatenate([ids, get("ids_b", "<i8")]), np.concatenate([copies, get("copies_b", "<i8")]), j + len(a)
    if not len(i):
        return None
    links = np.bincount(i, copies[j], len(ids)) + np.bincount(j, copies[i], len(ids))
    order = np.argsort(ids, kind="stable")
    rank = np.empty(len(ids), np.int64)
    rank[order] = np.arange(len(ids))
    root = ids[order][local_roots(len(ids), rank[i], rank[j])[rank]]
    at = np.flatnonzero(links)
    return pa.RecordBatch.from_arrays([pa.array(ids[at]), pa.array(links[at].astype(np.int64)), pa.array(root[at])], names=["class_id", "links", "root"])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract rows over all vectors."""
    return near_vectors(spark, spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


SQL = """
WITH RECURSIVE usable AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
  WHERE list_cosine_similarity(a.v, b.v) >= 0.93),
reach AS (
  SELECT vec_id, vec_id AS c FROM embeddings
  UNION SELECT links.b AS vec_id, reach.c FROM reach JOIN links ON links.a = reach.vec_id),
comp AS (SELECT vec_id, min(c) AS component_id FROM reach GROUP BY vec_id),
n AS (SELECT a AS vec_id, count(*) AS n_links FROM links GROUP BY a)
SELECT vec_id, coalesce(n_links, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept
FROM comp LEFT JOIN n USING (vec_id)
"""
