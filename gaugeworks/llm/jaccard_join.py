"""N-gram Jaccard join over parity sketches.

A document is the set of its ``size``-word shingles.  Documents of equal sets are one
class.  Sizes fall into bands; in a band, each shingle flips one bit of a sketch, so
the Hamming distance of two sketches never exceeds the sets' symmetric difference.
Sets that reach the threshold, the smaller of them in the band, differ by at most D
shingles; the sketch is cut in more than D words, so that two such sets
have one more word equal than each may leave out: empty words, and words of common
shingles whose key many sets share.  A set with more of those than that sends all.  A set joins its own band and, if small enough, the band below.

Word keys that occur once are sorted out by the sharded sketch of :mod:`._blocks`;
only sets with a repeated key go on.  Within a key, every set is verified against the
smallest id, and verified links are joined to components.  What is left are keys whose
sets fell into different components: those are compared tile by tile, by sketch and
across components only, once for all keys that the same sets share.  A comparison
tells which of its sets the sketches don't rule out; these meet again with their
shingles and are verified where they meet, and only links that join what no earlier
one has joined leave the task.  No stage emits all pairs of a group, and no link between
different texts is lost.  A family of sets that are all near the threshold, but in
components of their own, is still compared within itself, so that comparisons, though
not rows, grow with the square of such a family.

Defined results: null texts and texts without words have no shingles and link with
nothing; with fewer words than ``size`` the whole sequence is one shingle; rows that
repeat an id are one document if their texts are equal, and share a component if not;
a null id sorts last and comes back null.  Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ._blocks import Block, NULL_ID, binary_array, cut, each_block, id_array, make_blocks, repeated_keys, sketch_repeats, slice_of, slices_for
from ._components import components
from ._store import ROW, Workspace
from ._text import mix, release, window_hashes

#: bits of one sketch word
WORD_BITS = 1 << 16
TILE = 1024
#: log2 of the most bits that a whole set's sketch takes
SKETCH_BITS = 13
#: a key of more sets is left out by those that may
HOT = 32
_C = np.uint64(0x9E3779B97F4A7C15)
BLOCK_BYTES = 2 << 20
#: one comparison of two tiles of a key's sets
COMPARISON = ["key", "kind", "low", "high"]
#: bytes of shingles that a comparison's part has on average
PART_BYTES = 16 << 20


class Bands:
    """Size bands for a threshold of num/den."""

    def __init__(self, num: int, den: int):
        self.num, self.den = num, den

    @lru_cache(maxsize=None)
    def bounds(self, i: int) -> tuple[int, int]:
        """Smallest and largest size of band i; a band spans the square of the size ratio."""
        low = 1 if i == 0 else self.bounds(i - 1)[1] + 1
        return low, max(low, low * self.den * self.den // (self.num * self.num))

    def of(self, n: int) -> int:
        i = 0
        while self.bounds(i)[1] < n:
            i += 1
        return i

    def words(self, i: int) -> tuple[int, int]:
        """Sketch words of band i, and how many of them a set may leave out.

        At least one word more than may be left out is equal in two sets that reach
        the threshold.
        """
        low, high = self.bounds(i)
        most = high * (self.den - self.num) // self.num  # symmetric difference
        spare = 0
        for _ in range(4):  # empty words depend on the number of words
            n = most + 1 + spare
            empty = n * np.exp(-low / n)
            spare = int(np.ceil(empty + 3 * np.sqrt(empty))) + 1 + n // 10 if most else 0
        return most + 1 + spare, spare

    def joined(self, n: int) -> list[int]:
        """Bands that a set of n shingles joins."""
        i = self.of(n)
        below = i > 0 and n * self.num <= self.bounds(i - 1)[1] * self.den
        return [i - 1, i] if below else [i]


def word_keys(shingles: np.ndarray, bands: Bands) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys of the sketch words of one set, their bands, and how many more of a band it may leave out."""
    out, of, room = [], [], []
    for band in bands.joined(len(shingles)):
        n, spare = bands.words(band)
        word = ((shingles >> np.uint64(32)) * np.uint64(n)) >> np.uint64(32)
        # the parity of a word's bits, told by the sum of its flipped bits' marks: what is flipped twice cancels
        mark = mix((word << np.uint64(16)) | (shingles & np.uint64(WORD_BITS - 1)))
        order = np.argsort(word, kind="stable")
        at = np.flatnonzero(np.concatenate([[True], np.diff(word[order].astype(np.int64)) != 0]))
        parity = np.bitwise_xor.reduceat(mark[order], at)
        value = np.zeros(n, np.uint64)
        value[word[order][at].astype(np.int64)] = parity
        number = np.arange(n, dtype=np.uint64)
        full = value != 0
        left = spare - int(n - full.sum())
        keep = full if left >= 0 else np.ones(n, bool)
        out.append(mix(value[keep] ^ mix(number[keep] * _C + np.uint64(band + 1))))
        of.append(np.full(len(out[-1]), band, np.int32))
        room.append(np.full(len(out[-1]), left, np.int32))
    return np.concatenate(out), np.concatenate(of), np.concatenate(room)


def shingle_sets(block: Block, size: int, only: np.ndarray | None = None) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each document of a block, or of the numbered ones."""
    hashes = window_hashes(block.hashes(), size) if len(block.starts) else np.zeros(0, np.uint64)
    first, last = block.first[:-1], block.first[1:]
    if only is not None:
        first, last = first[only], last[only]
    out = []
    for a, b in zip(first.tolist(), last.tolist()):
        if b - a >= size:
            out.append(np.unique(hashes[a:b - size + 1]))
        elif b > a:
            out.append(np.frombuffer(hashlib.blake2b(block.bytes_of(a, b), digest_size=8).digest(), "<u8"))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def _digests(sets: list[np.ndarray]) -> np.ndarray:
    """128 bits of each set, equal for equal sets."""
    out = np.zeros((len(sets), 2), np.uint64)
    for i, s in enumerate(sets):
        out[i] = np.frombuffer(hashlib.blake2b(s.tobytes(), digest_size=16).digest(), "<u8")
    return out


def _keys(block: Block, size: int, bands: Bands) -> tuple[list[np.ndarray], tuple[np.ndarray, ...], np.ndarray]:
    """Sets, keys with bands and rooms of a block, and the number of keys of each document."""
    sets = shingle_sets(block, size)
    none = (np.zeros(0, np.uint64), np.zeros(0, np.int32), np.zeros(0, np.int32))
    each = [word_keys(s, bands) if len(s) else none for s in sets]
    return sets, tuple(np.concatenate([none[i], *(e[i] for e in each)]) for i in range(3)), np.array([len(e[0]) for e in each], np.int64)


def bit_sketch(shingles: np.ndarray) -> bytes:
    """One bit a shingle, flipped by each that falls on it; a power of two of bits, some four a shingle."""
    bits = 1 << int(np.clip((4 * len(shingles) - 1).bit_length(), 6, SKETCH_BITS))
    odd = np.bincount((mix(shingles) & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def folded(sketch: np.ndarray, words: int) -> np.ndarray:
    """A sketch of fewer 64-bit words, as if it had been made so."""
    return np.bitwise_xor.reduce(sketch.reshape(-1, words), axis=0)


def most_different(na, nb, num: int, den: int):
    """The largest symmetric difference of two sizes that reach the threshold."""
    return (na + nb) * (den - num) // (den + num)


def similar(a: np.ndarray, b: np.ndarray, num: int, den: int) -> bool:
    """Do two sorted sets reach the threshold?"""
    small, large = sorted((len(a), len(b)))
    if small * den < large * num:
        return False
    both = np.concatenate([a, b])
    both.sort(kind="stable")
    common = int(np.count_nonzero(both[1:] == both[:-1]))
    return common * den >= (len(both) - common) * num


def jaccard_groups(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5, threshold: tuple[int, int] = (80, 100)) -> DataFrame:
    """doc_id, n_shingles, class_id (equal sets) and component_id of every document, both the smallest doc_id of theirs."""
    ws = Workspace(spark, "jaccard-join")
    rows = ws.numbered(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")), "rows")
    ids = ws.put(rows.select(ROW, "doc_id"), "ids")
    grouped = row_groups(spark, ws, rows, size, threshold, done_with=("rows",))
    named = ws.put(ids.join(grouped, ROW).select("doc_id", "n_shingles", "class", "component"), "named")
    classes = ws.put(named.groupBy("component", "class").agg(F.min("doc_id").alias("class_id")), "named-classes")
    least = classes.groupBy("component").agg(F.min("class_id").alias("component_id"))
    told = classes.join(least, "component").select("class", "class_id", "component_id")
    return named.join(told, "class").select("doc_id", "n_shingles", "class_id", "component_id")


def row_groups(spark: SparkSession, ws: Workspace, rows: DataFrame, size: int, threshold: tuple[int, int], done_with: tuple[str, ...] = ()) -> DataFrame:
    """ROW, n_shingles, class and component (the smallest ROW of each) of rows (ROW, text); drops the tables ``done_with`` once it has read the rows."""
    num, den = threshold
    bands = Bands(num, den)
    blocks = make_blocks(ws, rows, ROW, "text", lower=True, block_bytes=BLOCK_BYTES)
    ws.drop(*done_with)
    n = blocks.agg(F.coalesce(F.sum("n_words"), F.lit(0))).first()[0]
    n_keys = max(1, int(n * min(1.0, 2 * (1 - num / den))))
    n_slices = slices_for(n)
    flags = sketch_repeats(ws, blocks, lambda b: _keys(b, size, bands)[1][0], n_keys, "flags").withColumn("kind", F.lit(0))

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in each_block(batches):
            d = _digests(shingle_sets(block, size))
            order, s, at = _dealt(d, n_slices)
            if len(s):
                parts = [np.concatenate([d[o].T.reshape(-1).view(np.uint8), block.ids[o].astype("<i8").view(np.uint8)]) for o in (order[i:j] for i, j in zip(at[:-1], at[1:]))]
                yield pa.RecordBatch.from_arrays([pa.array(s), pa.array(np.full(len(s), block.block_id)), binary_array(parts)], names=["slice", "block_id", "sets"])

    def heads(table: pa.Table) -> pa.Table:
        parts = [np.frombuffer(x.as_buffer(), "<u8").reshape(3, -1) for x in table["sets"]]
        hi, lo, ids = np.concatenate(parts, axis=1)
        ids = ids.view(np.int64)
        order = np.lexsort((ids, lo, hi))
        h, w = hi[order], lo[order]
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (w[1:] != w[:-1])
        head = np.empty(len(h), np.int64)
        head[order] = ids[order][np.flatnonzero(new)[np.cumsum(new) - 1]]
        at = np.cumsum([0, *(p.shape[1] for p in parts)])
        return pa.table({"block_id": table["block_id"], "slice": table["slice"], "bits": binary_array([head[i:j].astype("<i8").view(np.uint8) for i, j in zip(at[:-1], at[1:])])})

    def flagged(left: pa.Table, right: pa.Table) -> pa.Table:
        kind = np.array(right["kind"].to_pylist())
        slices, bits = np.array(right["slice"].to_pylist()), right["bits"].to_pylist()
        pick = lambda k: (slices[kind == k].tolist(), [bits[i] for i in np.flatnonzero(kind == k)])
        tables = []
        for b, n_docs, p in zip(left["block_id"].to_pylist(), left["n_docs"].to_pylist(), left["payload"]):
            block = Block.unpack(b, n_docs, p.as_py())
            sets, (keys, band, room), n_keys_of = _keys(block, size, bands)
            again = repeated_keys(keys, n_keys, *pick(0)) if len(keys) else np.zeros(0, bool)
            order, s, cuts = _dealt(_digests(sets), n_slices)
            got = dict(zip(*pick(1)))
            head = np.empty(n_docs, np.int64)
            for x, i, j in zip(s.tolist(), cuts[:-1], cuts[1:]):
                head[order[i:j]] = np.frombuffer(got[x], "<i8")
            sizes = np.array([len(x) for x in sets], np.int64)
            head[sizes == 0] = block.ids[sizes == 0]
            # the first row of a class's smallest id speaks for it, if any of its keys is repeated
            of = np.repeat(np.arange(n_docs), n_keys_of)
            speaks = (np.bincount(of, again, n_docs) > 0) & (head == block.ids)
            where = np.flatnonzero(speaks)
            speaks[np.setdiff1d(where, where[np.unique(head[where], return_index=True)[1]])] = False
            sent = again & speaks[of]
            at = np.concatenate([[0], np.cumsum(np.bincount(of[sent], minlength=n_docs))])
            entries = pa.StructArray.from_arrays([pa.array(keys[sent].view(np.int64)), pa.array(band[sent]), pa.array(room[sent])], names=["key", "band", "room"])
            tables.append(pa.table([
                pa.array(np.full(n_docs, b)), id_array(block.ids), pa.array(sizes), pa.array(head), pa.ListArray.from_arrays(pa.array(at, pa.int32()), entries),
                pa.array([bit_sketch(x) if y else None for x, y in zip(sets, speaks)], pa.binary()),
            ], names=["block_id", "doc_id", "n_shingles", "class_id", "keys", "sketch"]))
        del sets, keys, band, room, entries
        release()
        return pa.concat_tables(tables)

    sent = blocks.select("block_id", "n_docs", "payload").mapInArrow(send, "slice long, block_id long, sets binary")
    classes = ws.put(sent.groupBy("slice").applyInArrow(heads, "block_id long, slice long, bits binary"), "classes").withColumn("kind", F.lit(1))
    cols = ["block_id", "slice", "bits", "kind"]
    answers = flags.select(cols).union(classes.select(cols))
    met = blocks.select("block_id", "n_docs", "payload").groupBy("block_id").cogroup(answers.groupBy("block_id"))
    found = ws.put(met.applyInArrow(flagged, "block_id long, doc_id long, n_shingles long, class_id long, keys array<struct<key:long,band:int,room:int>>, sketch binary"), "found")
    ws.drop("flags", "classes")

    comp = _link(spark, ws, found, blocks, size, num, den)
    ws.drop("blocks")
    member = found.select(F.col("doc_id").alias(ROW), "n_shingles", F.col("class_id").alias("class"))
    out = member.join(comp.select(F.col("node").alias("class"), "component"), "class", "left")
    return out.select(ROW, "n_shingles", "class", F.coalesce("component", "class").alias("component"))


def _dealt(digests: np.ndarray, n_slices: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Documents in the order of their digests' slices, the slices, and where each begins."""
    s = slice_of(digests[:, 0], n_slices).astype(np.int64)
    order = np.argsort(s, kind="stable")
    return order, *cut(s[order])


def _link(spark: SparkSession, ws: Workspace, found: DataFrame, blocks: DataFrame, size: int, num: int, den: int) -> DataFrame:
    """(node, component) of the classes that have links."""
    top = F.lit(NULL_ID)
    heavy = found.filter("sketch is not null").withColumn("id", F.coalesce("doc_id", top))
    keys = _selective(ws, heavy.select("id", F.inline("keys")))
    hubs = ws.put(keys.groupBy("key").agg(F.min("id").alias("hub"), F.count("*").alias("n")).filter("n > 1"), "hubs")
    stars = ws.put(keys.join(hubs, "key").filter("id <> hub").select("id", F.col("hub").alias("other")).distinct(), "stars")
    sets = lambda ids: _sets(blocks, heavy, ids, size)
    links = _verified(ws, _near(ws, stars, heavy, num, den), sets, num, den, "links")
    comp = ws.put(components(spark, links, ws), "components")
    across = _across(ws, keys, hubs, comp, heavy, num, den)
    if across.isEmpty():
        return comp
    more = _joined(ws, across, sets, num, den)
    if more.isEmpty():
        return comp
    return components(spark, links.union(more), Workspace(spark, "jaccard-join-across"))


def _selective(ws: Workspace, keys: DataFrame) -> DataFrame:
    """(key, id) without keys of many sets, where a set has enough others.

    Such keys come from words that hold common shingles only.  Two similar sets have
    one more equal word than either may leave out, so a set with few such words is
    still found by another one; a set with too many keeps them all.
    """
    hot = ws.put(keys.groupBy("key").agg(F.count("*").alias("n")).filter(F.col("n") > HOT).select("key", F.lit(True).alias("hot")), "hot")
    marked = ws.put(keys.join(hot, "key", "left").withColumn("hot", F.coalesce("hot", F.lit(False))), "marked")
    spares = ws.put(marked.groupBy("id", "band").agg(F.count_if("hot").alias("n"), F.min("room").alias("room")).filter("n > 0 and n <= room").select("id", "band", F.lit(True).alias("spares")), "spares")
    kept = marked.join(spares, ["id", "band"], "left").filter(~(F.col("hot") & F.coalesce("spares", F.lit(False))))
    return ws.put(kept.select("key", "id"), "keys")


def _near(ws: Workspace, pairs: DataFrame, heavy: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs whose sketches don't rule them out."""
    side = lambda c, x: heavy.select(F.col("id").alias(c), F.col("n_shingles").alias(f"n_{x}"), F.col("sketch").alias(f"sketch_{x}"))

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ok = []
            for na, nb, x, y in zip(b["n_a"].to_pylist(), b["n_b"].to_pylist(), b["sketch_a"], b["sketch_b"]):
                x, y = (np.frombuffer(v.as_buffer(), "<u8") for v in (x, y))
                words = min(len(x), len(y))
                ok.append(int(np.bitwise_count(folded(x, words) ^ folded(y, words)).sum()) <= most_different(na, nb, num, den))
            yield b.select(["id", "other"]).filter(pa.array(ok, pa.bool_()))

    met = pairs.join(side("id", "a"), "id").join(side("other", "b"), "other")
    return ws.put(met.select("id", "other", "n_a", "n_b", "sketch_a", "sketch_b").mapInArrow(close, "id long, other long"), "near")


def _sets(blocks: DataFrame, heavy: DataFrame, ids: DataFrame, size: int) -> DataFrame:
    """(id, shingles) of the named sets, made anew from the blocks that hold any."""
    # a block's list is bounded by the block
    wanted = ids.join(heavy.select("id", "block_id"), "id").groupBy("block_id").agg(F.collect_list("id").alias("wanted"))

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b, n_docs, p, want in zip(batch["block_id"].to_pylist(), batch["n_docs"].to_pylist(), batch["payload"], batch["wanted"]):
                block = Block.unpack(b, n_docs, p.as_py())
                named = np.flatnonzero(np.isin(block.ids, want.values.to_numpy()))
                sets = [x.astype("<u8").view(np.uint8) for x in shingle_sets(block, size, named)]
                yield pa.RecordBatch.from_arrays([pa.array(block.ids[named]), binary_array(sets)], names=["id", "shingles"])
            release()

    return blocks.select("block_id", "n_docs", "payload").join(wanted, "block_id").mapInArrow(make, "id long, shingles binary")


def _verified(ws: Workspace, pairs: DataFrame, sets_of, num: int, den: int, name: str) -> DataFrame:
    """(a, b) of the pairs whose sets reach the threshold; only sets of some pair are made."""
    used = ws.put(sets_of(pairs.select("id").union(pairs.select("other")).distinct()), f"{name}-sets")
    side = lambda c, x: used.select(F.col("id").alias(c), F.col("shingles").alias(f"set_{x}"))

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ok = [similar(np.frombuffer(x.as_buffer(), "<u8"), np.frombuffer(y.as_buffer(), "<u8"), num, den) for x, y in zip(b["set_a"], b["set_b"])]
            yield b.select(["id", "other"]).rename_columns(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    met = pairs.join(side("id", "a"), "id").join(side("other", "b"), "other")
    links = ws.put(met.select("id", "other", "set_a", "set_b").mapInArrow(verify, "a long, b long"), name)
    ws.drop(f"{name}-sets")
    return links


def _across(ws: Workspace, keys: DataFrame, hubs: DataFrame, comp: DataFrame, heavy: DataFrame, num: int, den: int) -> DataFrame:
    """Sets that share a key with one of another component, neither of them its hub, and whose sketches come near.

    Keys that the same sets share are one.  A key's sets are dealt to tiles by id; each
    pair of its tiles is one comparison of sketches (key, kind, low, high), whose rows
    come back if they come near another one.
    """
    big = hubs.filter("n > 2").select("key", "hub", "n")
    named = ws.put(
        keys.join(big, "key").filter("id <> hub").join(comp.select(F.col("node").alias("id"), "component"), "id", "left")
        .select("key", "id", "n", F.coalesce("component", "id").alias("component")), "named")
    mark = lambda seed: F.bit_xor(F.xxhash64("id", F.lit(seed)))
    sizes = named.groupBy("key", "component").agg(F.count("*").alias("n"), mark(1).alias("x"), mark(2).alias("y"))
    keyed = sizes.groupBy("key").agg(
        F.max_by("component", F.struct("n", "component")).alias("major"), F.max("n").alias("most"), F.sum("n").alias("all"), F.count("*").alias("parts"),
        F.bit_xor("x").alias("x"), F.bit_xor("y").alias("y")).filter("parts > 1")
    once = keyed.groupBy("all", "x", "y").agg(F.min(F.struct("key", "major", "most")).alias("k")).select("k.*", "all")
    mixed = ws.put(once.select("key", "major", F.ceil(F.col("most") / TILE).alias("t_major"), F.ceil((F.col("all") - F.col("most")) / TILE).alias("t_other")), "mixed")
    rows = named.join(mixed, "key").withColumn("own", F.col("component") == F.col("major"))
    rows = rows.withColumn("tile", F.pmod(F.xxhash64("id"), F.when(F.col("own"), F.col("t_major")).otherwise(F.col("t_other"))))
    # the largest component meets the others, and the others meet each other
    each = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1)).alias("met")
    cols = ["key", "id", "component", "own", "tile"]
    inner = rows.filter("not own").select(*cols, each("t_other"), F.lit(0).alias("kind")).withColumn("low", F.least("tile", "met")).withColumn("high", F.greatest("tile", "met"))
    outer = rows.filter("own").select(*cols, each("t_other"), F.lit(1).alias("kind")).withColumn("low", F.col("met")).withColumn("high", F.col("tile"))
    outer = outer.union(rows.filter("not own").select(*cols, each("t_major"), F.lit(1).alias("kind")).withColumn("low", F.col("tile")).withColumn("high", F.col("met")))
    side = F.when(F.col("kind") == 1, F.when(F.col("own"), 2).otherwise(1)).otherwise(F.when(F.col("tile") == F.col("low"), 1).otherwise(0) + F.when(F.col("tile") == F.col("high"), 2).otherwise(0))
    dealt = ws.put(inner.union(outer).select("key", "kind", "low", "high", side.alias("side"), "id", "component"), "dealt")
    cols = [*COMPARISON, "side", "id", "component", "n_shingles"]

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t, starts in _whole_groups(batches, COMPARISON):
            sketches = _Sketches([np.frombuffer(x.as_buffer(), "<u8") for x in t["sketch"]])
            near = np.zeros(t.num_rows, bool)
            for x, y in _near_pairs(t, starts, sketches, t["component"].to_numpy(), num, den):
                near[x] = near[y] = True
            yield from t.select(cols).filter(pa.array(near)).combine_chunks().to_batches()

    met = dealt.join(heavy.select("id", "n_shingles", "sketch"), "id").repartition(*COMPARISON).sortWithinPartitions(*COMPARISON)
    close = met.mapInArrow(compare, "key long, kind int, low long, high long, side int, id long, component long, n_shingles long")
    return ws.put(close, "across")


def _joined(ws: Workspace, across: DataFrame, sets_of, num: int, den: int) -> DataFrame:
    """(a, b) of pairs within a comparison that reach the threshold: in each, as many as join its components.

    A comparison of more than PART_BYTES of shingles is done in parts, two at a time.
    """
    used = ws.put(sets_of(across.select("id").distinct()), "across-sets")
    parts = F.ceil(F.sum(F.col("n_shingles") * 8).over(Window.partitionBy(*COMPARISON)) / PART_BYTES)
    rows = across.withColumn("parts", parts).withColumn("part", F.pmod(F.xxhash64("id", F.lit(3)), "parts"))
    rows = rows.withColumn("met", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    rows = rows.withColumns({"part_low": F.least("part", "met"), "part_high": F.greatest("part", "met")})
    group = [*COMPARISON, "part_low", "part_high"]

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t, starts in _whole_groups(batches, group):
            yield _joining_links(t, starts, num, den)
            release()

    met = rows.select(*group, "part", "side", "id", "component", "n_shingles").join(used, "id").repartition(*group).sortWithinPartitions(*group)
    links = ws.put(met.mapInArrow(join, "a long, b long"), "links-across")
    ws.drop("across-sets")
    return links


def _whole_groups(batches: Iterator[pa.RecordBatch], group: list[str]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of whole groups of sorted rows, with where groups begin and, last, where the rows end."""
    held = None
    for b in batches:
        t = pa.table(b) if held is None else pa.concat_tables([held, pa.table(b)]).combine_chunks()
        starts = _group_starts(t, group)
        if len(starts):
            if starts[-1]:
                yield t.slice(0, starts[-1]), starts
            held = t.slice(starts[-1])
    if held is not None:
        yield held.combine_chunks(), np.array([0, held.num_rows])


def _group_starts(t: pa.Table, group: list[str]) -> np.ndarray:
    """Where the groups of a sorted table begin."""
    new = np.zeros(t.num_rows, bool)
    new[:1] = True
    for c in group:
        x = t[c].to_numpy()
        new[1:] |= x[1:] != x[:-1]
    return np.flatnonzero(new)


#: sketch words looked at first, and words that a step of a comparison holds
FIRST_WORDS, STEP_WORDS = 8, 1 << 21


def _near_pairs(t: pa.Table, starts: np.ndarray, sketches: _Sketches, comps: np.ndarray, num: int, den: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of a group's left and right rows (sides 1 and 2, or 3 for both) whose sketches come near, by place in the table.

    ``starts`` has where groups begin and, last, where the rows end.  Groups are worked
    on together, in steps of bounded size; pairs of one component are left out, as
    ``comps`` has them when a step begins.  A step's pairs go by their left rows.
    """
    ids, sizes, side = (t[c].to_numpy() for c in ("id", "n_shingles", "side"))
    group = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    order = np.lexsort((sizes, group))  # by size within a group, so that a row's partners are a run
    left, right = order[side[order] & 1 > 0], order[side[order] & 2 > 0]
    # partners of a row: the right rows of its group whose sizes the threshold allows
    width = int(sizes.max(initial=0)) + 2
    place = group[right] * width + sizes[right]
    low = -(-sizes[left] * num // den)
    begin = np.searchsorted(place, group[left] * width + low, side="left")
    end = np.searchsorted(place, group[left] * width + np.minimum(sizes[left] * den // num, width - 1), side="right")
    n = end - begin
    cuts = np.flatnonzero(np.diff(np.cumsum(n) // (STEP_WORDS // FIRST_WORDS))) + 1
    for rows in np.split(np.arange(len(left)), cuts):
        a = np.repeat(left[rows], n[rows])
        b = right[np.arange(n[rows].sum()) + np.repeat(begin[rows] - np.cumsum(n[rows]) + n[rows], n[rows])]
        # rows on both sides of one tile meet once
        ok = (comps[a] != comps[b]) & ((side[a] != 3) | (ids[a] < ids[b]))
        a, b = a[ok], b[ok]
        most = most_different(sizes[a], sizes[b], num, den)
        for words in (FIRST_WORDS, None):
            near = sketches.distance(a, b, words) <= most
            a, b, most = a[near], b[near], most[near]
        yield a, b


def _close_pairs(t: pa.Table, starts: np.ndarray, num: int, den: int) -> pa.RecordBatch:
    """The ids of all near pairs, for a look at a few."""
    sketches = _Sketches([np.frombuffer(x.as_buffer(), "<u8") for x in t["sketch"]])
    ids, pairs = t["id"].to_numpy(), list(_near_pairs(t, starts, sketches, t["component"].to_numpy(), num, den))
    return pa.RecordBatch.from_arrays([pa.array(ids[np.concatenate([p[i] for p in pairs])]) for i in range(2)], names=["id", "other"])


def _joining_links(t: pa.Table, starts: np.ndarray, num: int, den: int) -> pa.RecordBatch:
    """Verified links of the groups of a table, as many as join components that no link before has joined."""
    ids, sizes, part = (t[c].to_numpy() for c in ("id", "n_shingles", "part"))
    two_parts = t["part_low"].to_numpy() != t["part_high"].to_numpy()
    sets = [np.frombuffer(x.as_buffer(), "<u8") for x in t["shingles"]]
    comps = t["component"].to_numpy().copy()
    code = np.unique(np.concatenate(sets), return_inverse=True)[1]
    at = np.concatenate([[0], np.cumsum(sizes)])
    own = np.zeros(int(code.max()) + 1, bool)
    out_a, out_b = [], []
    for a, b in _near_pairs(t, starts, _Sketches([np.frombuffer(bit_sketch(x), "<u8") for x in sets]), comps, num, den):
        ok = ~two_parts[a] | (part[a] != part[b])  # pairs within a part meet in the group of that part alone
        a, b = a[ok], b[ok]
        for i, j in zip(*_runs(a)):
            x, others = a[i], b[i:j]
            others = others[comps[others] != comps[x]]
            if not len(others):
                continue
            own[code[at[x]:at[x + 1]]] = True
            n = sizes[others]
            common = np.add.reduceat(own[np.concatenate([code[at[y]:at[y + 1]] for y in others])], np.cumsum(n) - n, dtype=np.int64)
            own[code[at[x]:at[x + 1]]] = False
            for y in others[common * den >= (n + sizes[x] - common) * num]:
                if comps[x] != comps[y]:
                    out_a.append(ids[x])
                    out_b.append(ids[y])
                    comps[comps == comps[y]] = comps[x]
    return pa.RecordBatch.from_arrays([pa.array(out_a, pa.int64()), pa.array(out_b, pa.int64())], names=["a", "b"])


def _runs(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where runs of equal values begin and end."""
    edges = np.flatnonzero(np.diff(a)) + 1
    return (np.concatenate([[0], edges]), np.concatenate([edges, [len(a)]])) if len(a) else (edges, edges)


class _Sketches:
    """Sketches of different lengths, and as folded for a comparison."""

    def __init__(self, rows: list[np.ndarray]):
        self.rows = rows
        self.length = np.array([len(x) for x in self.rows], np.int64)
        self.made: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}

    def folded(self, length: int, words: int) -> tuple[np.ndarray, np.ndarray]:
        """Sketches of one length, folded to ``words``, and where each row's is."""
        if (length, words) not in self.made:
            at = np.flatnonzero(self.length == length)
            where = np.zeros(len(self.rows), np.int64)
            where[at] = np.arange(len(at))
            matrix = np.bitwise_xor.reduce(np.stack([self.rows[i] for i in at]).reshape(len(at), -1, words), axis=1)
            self.made[length, words] = matrix, where
        return self.made[length, words]

    def distance(self, a: np.ndarray, b: np.ndarray, most_words: int | None) -> np.ndarray:
        """Differing bits of each pair of rows, folded to the shorter sketch and to ``most_words``."""
        out = np.zeros(len(a), np.int64)
        la, lb = self.length[a], self.length[b]
        for x in np.unique(la).tolist():
            for y in np.unique(lb[la == x]).tolist():
                words = min(x, y, most_words or x)
                (ma, wa), (mb, wb) = self.folded(x, words), self.folded(y, words)
                pairs = np.flatnonzero((la == x) & (lb == y))
                for at in np.split(pairs, range(STEP_WORDS // words, len(pairs), STEP_WORDS // words)):
                    out[at] = np.bitwise_count(ma[wa[a[at]]] ^ mb[wb[b[at]]]).sum(axis=1)
        return out


def drop_similar(spark: SparkSession, docs: DataFrame, size: int = 5, threshold: tuple[int, int] = (80, 100)) -> DataFrame:
    """Documents, all columns: of each component the row of the smallest id stays.

    Of rows that repeat an id, each is judged by its text, and one of equal ones stays; a
    null id is the largest.
    """
    ws = Workspace(spark, "jaccard-gone")
    rows = ws.numbered(docs, "rows")
    groups = row_groups(spark, Workspace(spark, "jaccard-join"), rows.select(ROW, F.col("text").cast("string").alias("text")), size, threshold)
    named = ws.put(rows.select(ROW, "doc_id").join(groups, ROW).select(ROW, "doc_id", "component"), "named")
    first = named.groupBy("component").agg(F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", ROW)).alias("first")).select(F.col(f"first.{ROW}").alias(ROW))
    gone = ws.put(named.select(ROW).join(first, ROW, "left_anti"), "gone")
    ws.drop("named")
    return rows.join(gone, ROW, "left_anti").select(*docs.columns)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract rows over all documents: three-word shingles, 0.9."""
    groups = jaccard_groups(spark, spark.read.parquet(f"{sf_dir}/documents.parquet"), size=3, threshold=(90, 100))
    return groups.select("doc_id", "n_shingles", "component_id")


_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+')"


def groups_sql(size: int, num: int, den: int, source: str = "documents") -> str:
    """CTEs up to comp(doc_id, component_id) and sizes(doc_id, n_shingles)."""
    return rf"""
words AS (SELECT doc_id, {_WORDS} AS ws FROM {source}),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(ws[p:p + least(len(ws), {size}) - 1], ' ') AS s
  FROM (SELECT *, unnest(range(1, greatest(len(ws) - {size - 1}, 1) + 1)) AS p FROM words WHERE len(ws) > 0)),
sizes AS (SELECT doc_id, count(*) AS n_shingles FROM shingles GROUP BY doc_id),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE {den} * n >= {num} * (x.n_shingles + y.n_shingles - n)),
reach AS (
  SELECT doc_id, doc_id AS c FROM {source}
  UNION SELECT links.b AS doc_id, reach.c FROM reach JOIN links ON links.a = reach.doc_id),
comp AS (SELECT doc_id, min(c) AS component_id FROM reach GROUP BY doc_id)"""


SQL = f"""
WITH RECURSIVE {groups_sql(3, 90, 100)}
SELECT doc_id, coalesce(n_shingles, 0)::BIGINT AS n_shingles, component_id FROM comp LEFT JOIN sizes USING (doc_id)
"""
