"""Blocks of documents, and the exchange that tells which items repeat anywhere.

A block is a few megabytes of documents packed in one compressed row, so that
later passes move compressed rows and answers find their way back by block id.
Block ids are written down with the blocks: no pass relies on the layout of the
input files.

The exchange is a sharded count-min sketch.  Each block turns its items into
sketch cells (sparse: the cells it touches, with a mark where it touches one
twice), dealt by slice of the hash range; each slice merges the cells of all
blocks and answers, for each block, one bit a cell: is the merged count at least
two?  Counts are never too low, so no repeated item is missed; slices grow in
number with the input, so the share of false alarms and the memory of a task stay
as they are at any size, and nothing is broadcast or collected.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from ._store import Workspace
from ._text import SPACE, Words, pieces, release, split_words

BLOCK_BYTES = 4 << 20
#: items a slice of the sketch takes on average; it has 2^31 cells a row
SLICE_ITEMS = 1 << 18
NULL_ID = np.iinfo(np.int64).max
BLOCK_SCHEMA = "block_id long, n_docs long, n_words long, payload binary"


class Block(Words):
    """Documents of one block; a null id is held as NULL_ID and sorts last."""

    def __init__(self, block_id: int, ids: np.ndarray, counts: np.ndarray, buf: np.ndarray):
        super().__init__(buf, counts)
        self.block_id, self.ids = block_id, ids

    def pack(self) -> bytes:
        raw = self.ids.astype("<i8").tobytes() + self.counts.astype("<i8").tobytes() + self.buf.tobytes()
        return zstandard.ZstdCompressor(level=1).compress(raw)

    @classmethod
    def unpack(cls, block_id: int, n_docs: int, payload: bytes) -> Block:
        raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(payload), np.uint8)
        ids, counts = raw[: 8 * n_docs].view("<i8"), raw[8 * n_docs:16 * n_docs].view("<i8")
        return cls(block_id, ids, counts, raw[16 * n_docs:])


def id_array(ids: np.ndarray) -> pa.Array:
    return pa.array(ids, pa.int64(), mask=ids == NULL_ID)


def binary_array(parts: list[np.ndarray]) -> pa.Array:
    """One binary value for each array of bytes."""
    off = np.zeros(len(parts) + 1, np.int32)
    np.cumsum([len(p) for p in parts], out=off[1:])
    data = np.concatenate(parts) if parts else np.zeros(0, np.uint8)
    return pa.Array.from_buffers(pa.binary(), len(parts), [None, pa.py_buffer(off.tobytes()), pa.py_buffer(data.tobytes())])


def make_blocks(ws: Workspace, docs: DataFrame, id_col: str, text_col: str, lower: bool = False, name: str = "blocks", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Write documents as blocks of words that are split at white space."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seq = TaskContext.get().partitionId() << 32
        for batch in batches:
            for ids, texts in pieces(batch.columns, 1, block_bytes):
                words = split_words(texts, SPACE, lower)
                block = Block(seq, ids.fill_null(NULL_ID).to_numpy(zero_copy_only=False), words.counts, words.buf)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([seq]), pa.array([len(ids)]), pa.array([int(words.first[-1])]), pa.array([block.pack()], pa.binary())],
                    names=["block_id", "n_docs", "n_words", "payload"],
                )
                seq += 1

    picked = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return ws.put(picked.mapInArrow(pack, BLOCK_SCHEMA), name)


def each_block(batches: Iterator[pa.RecordBatch]) -> Iterator[Block]:
    for batch in batches:
        for b, n, p in zip(batch["block_id"].to_pylist(), batch["n_docs"].to_pylist(), batch["payload"]):
            yield Block.unpack(b, n, p.as_py())
        release()


def slices_for(n_items: int) -> int:
    return max(1, -(-n_items // SLICE_ITEMS))


def slice_of(keys: np.ndarray, n_slices: int) -> np.ndarray:
    """Slices are ranges of the upper half of a key."""
    return ((keys >> np.uint64(32)) * np.uint64(n_slices)) >> np.uint64(32)


def cells_of(keys: np.ndarray, n_slices: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A block's cells in slice order, whether it hits each more than once, and each key's cell."""
    cell = (slice_of(keys, n_slices) << np.uint64(31)) | (keys & np.uint64(0x7FFFFFFF))
    cells, where, times = np.unique(cell, return_inverse=True, return_counts=True)
    return cells, times > 1, where


def cut(slices: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values of a sorted array and where each begins and the last ends."""
    if not len(slices):
        return slices, np.zeros(1, np.int64)
    at = np.flatnonzero(np.concatenate([[True], slices[1:] != slices[:-1]]))
    return slices[at], np.append(at, len(slices))


def sketch_repeats(ws: Workspace, blocks: DataFrame, keys_of: Callable[[Block], np.ndarray], n_items: int, name: str) -> DataFrame:
    """Answers (block_id, slice, bits): for each cell of a block in order, does its merged count reach two?"""
    n_slices = slices_for(n_items)

    def sketch(batches):
        for block in each_block(batches):
            cells, twice, _ = cells_of(keys_of(block), n_slices)
            s, at = cut((cells >> np.uint64(31)).astype(np.int64))
            coded = ((cells & np.uint64(0x7FFFFFFF)) | (twice.astype(np.uint64) << np.uint64(31))).astype("<u4").view(np.uint8)
            if len(s):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(s), pa.array(np.full(len(s), block.block_id)), binary_array([coded[4 * a:4 * b] for a, b in zip(at[:-1], at[1:])])],
                    names=["slice", "block_id", "cells"],
                )

    def merge(table: pa.Table) -> pa.Table:
        parts = [np.frombuffer(x.as_buffer(), "<u4") for x in table["cells"]]
        coded = np.concatenate(parts)
        _, where, _ = np.unique(coded & 0x7FFFFFFF, return_inverse=True, return_counts=True)
        many = np.bincount(where, 1 + (coded >> 31))[where] >= 2
        at = np.cumsum([0, *map(len, parts)])
        bits = [np.packbits(many[a:b]) for a, b in zip(at[:-1], at[1:])]
        return pa.table({"block_id": table["block_id"], "slice": table["slice"], "bits": binary_array(bits)})

    sent = blocks.select("block_id", "n_docs", "payload").mapInArrow(sketch, "slice long, block_id long, cells binary")
    return ws.put(sent.groupBy("slice").applyInArrow(merge, "block_id long, slice long, bits binary"), name)


def answers_in_order(slices: list[int], values: list[bytes], expected: np.ndarray, at: np.ndarray) -> np.ndarray:
    """One boolean a cell from a block's answers; every slice the block sent must have answered."""
    got = dict(zip(slices, values))
    if set(got) != set(expected.tolist()):
        raise RuntimeError("a block's answers are incomplete")
    if not len(expected):
        return np.zeros(0, bool)
    return np.concatenate([np.unpackbits(np.frombuffer(got[s], np.uint8), count=b - a).astype(bool) for s, a, b in zip(expected.tolist(), at[:-1], at[1:])])


def repeated_keys(keys: np.ndarray, n_items: int, slices: list[int], values: list[bytes]) -> np.ndarray:
    """For each key of a block: does the merged sketch count it at least twice?"""
    cells, _, where = cells_of(keys, slices_for(n_items))
    s, at = cut((cells >> np.uint64(31)).astype(np.int64))
    return answers_in_order(slices, values, s, at)[where]
