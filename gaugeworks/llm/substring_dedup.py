"""Substring dedup: count-min prefilter, then exact grouping of the windows it flags.

Pass 1 sketches every window of ``size`` words (see :mod:`._blocks`); merged
partition sketches overestimate window counts and so miss no repeated window.
Pass 2 takes only windows whose estimate is at least two and groups them by a
128-bit digest of their words, each block sending its first occurrence of each.
Pass 3 removes the words that later occurrences cover.

Defined results: a null or empty text has no words and stays as it is; words are
compared as bytes; a null id sorts behind all others and comes back null; rows
that repeat an id count as one document written twice, so equal windows at equal
starts don't remove each other.  Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from ._blocks import Block, answers_in_order, binary_array, cut, id_array, make_blocks, repeated_keys, sketch_repeats, slice_of, slices_for
from ._store import Workspace
from ._text import mix, window_hashes

KEPT_SCHEMA = "doc_id long, n_words long, n_removed long, kept_text string, removed array<struct<start:long,end:long>>"


def _window_keys(block: Block, size: int) -> tuple[np.ndarray, np.ndarray]:
    at = np.flatnonzero(block.window_ok(size))
    return window_hashes(block.hashes(), size)[at], at


class _Candidates:
    """A block's flagged windows: digests, and the first occurrence of each in the block."""

    def __init__(self, block: Block, size: int, n_items: int, slices, bits):
        keys, at = _window_keys(block, size)
        flagged = repeated_keys(keys, n_items, slices, bits)
        self.at = at[flagged]
        raw, starts, ends = block.buf.tobytes(), block.starts, block.ends
        got = [hashlib.blake2b(raw[a:b], digest_size=16).digest() for a, b in zip(starts[self.at].tolist(), ends[self.at + size - 1].tolist())]
        both = np.frombuffer(b"".join(got), "<u8").reshape(-1, 2)
        hi, lo = both[:, 0], both[:, 1]
        doc = block.doc_of()[self.at]
        ids, pos = block.ids[doc], self.at - block.first[doc]
        order = np.lexsort((pos, ids, lo, hi))
        hi, lo, ids, pos, self.at = hi[order], lo[order], ids[order], pos[order], self.at[order]
        new = np.ones(len(hi), bool)
        new[1:] = (hi[1:] != hi[:-1]) | (lo[1:] != lo[:-1])
        group = np.cumsum(new) - 1
        self.first = np.flatnonzero(new)
        head = self.first[group]
        self.later = (ids != ids[head]) | (pos != pos[head])
        self.group = group
        self.hi, self.lo, self.ids, self.pos = hi[new], lo[new], ids[new], pos[new]


def dedup_substrings(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 20) -> DataFrame:
    """Documents without the words of windows that start earlier elsewhere.

    Returns doc_id, n_words, n_removed, kept_text (kept words, one space apart)
    and removed (ranges of word numbers).
    """
    ws = Workspace(spark, "substring-dedup")
    blocks = make_blocks(ws, docs, id_col, text_col)
    n = blocks.agg(F.coalesce(F.sum("n_words"), F.lit(0))).first()[0]
    n_slices = slices_for(n)
    flags = sketch_repeats(ws, blocks, lambda b: _window_keys(b, size)[0], n, "flags").withColumn("kind", F.lit(0))

    def send(left: pa.Table, right: pa.Table) -> pa.Table:
        out = {"slice": [], "block_id": [], "first": []}
        for b, n_docs, p in zip(left["block_id"].to_pylist(), left["n_docs"].to_pylist(), left["payload"]):
            c = _Candidates(Block.unpack(b, n_docs, p.as_py()), size, n, right["slice"].to_pylist(), right["bits"].to_pylist())
            s, at = cut(slice_of(c.hi, n_slices).astype(np.int64))
            for x, i, j in zip(s.tolist(), at[:-1], at[1:]):
                out["slice"].append(x)
                out["block_id"].append(b)
                out["first"].append(b"".join([c.hi[i:j].tobytes(), c.lo[i:j].tobytes(), c.ids[i:j].astype("<i8").tobytes(), c.pos[i:j].astype("<i8").tobytes()]))
        return pa.table({"slice": pa.array(out["slice"], pa.int64()), "block_id": pa.array(out["block_id"], pa.int64()), "first": pa.array(out["first"], pa.binary())})

    def settle(table: pa.Table) -> pa.Table:
        parts = [np.frombuffer(x.as_buffer(), "<u8").reshape(4, -1) for x in table["first"]]
        hi, lo, ids, pos = np.concatenate(parts, axis=1)
        ids, pos = ids.view(np.int64), pos.view(np.int64)
        order = np.lexsort((pos, ids, lo, hi))
        h, w = hi[order], lo[order]
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (w[1:] != w[:-1])
        head = order[np.flatnonzero(new)[np.cumsum(new) - 1]]
        later = np.empty(len(h), bool)
        later[order] = (ids[order] != ids[head]) | (pos[order] != pos[head])
        at = np.cumsum([0, *(p.shape[1] for p in parts)])
        bits = [np.packbits(later[a:b]) for a, b in zip(at[:-1], at[1:])]
        return pa.table({"block_id": table["block_id"], "slice": table["slice"], "bits": binary_array(bits)})

    def keep(left: pa.Table, right: pa.Table) -> pa.Table:
        kind = np.array(right["kind"].to_pylist())
        slices, bits = np.array(right["slice"].to_pylist()), right["bits"].to_pylist()
        pick = lambda k: (slices[kind == k].tolist(), [bits[i] for i in np.flatnonzero(kind == k)])
        out = []
        for b, n_docs, p in zip(left["block_id"].to_pylist(), left["n_docs"].to_pylist(), left["payload"]):
            block = Block.unpack(b, n_docs, p.as_py())
            c = _Candidates(block, size, n, *pick(0))
            s, at = cut(slice_of(c.hi, n_slices).astype(np.int64))
            later = answers_in_order(*pick(1), s, at)[c.group] | c.later
            out.append(_without(block, c.at[later], size))
        return pa.concat_tables(out) if out else pa.table({k: pa.array([], t) for k, t in zip(_COLUMNS, _TYPES)})

    right = ["block_id", "slice", "bits", "kind"]
    sent = _with_answers(blocks, flags.select(right)).applyInArrow(send, "slice long, block_id long, first binary")
    firsts = ws.put(sent.groupBy("slice").applyInArrow(settle, "block_id long, slice long, bits binary"), "firsts").withColumn("kind", F.lit(1))
    return _with_answers(blocks, flags.select(right).union(firsts.select(right))).applyInArrow(keep, KEPT_SCHEMA)


def _with_answers(blocks: DataFrame, answers: DataFrame):
    return blocks.select("block_id", "n_docs", "payload").groupBy("block_id").cogroup(answers.groupBy("block_id"))


_SPAN = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
_COLUMNS, _TYPES = ["doc_id", "n_words", "n_removed", "kept_text", "removed"], [pa.int64(), pa.int64(), pa.int64(), pa.string(), _SPAN]


def _without(block: Block, starts: np.ndarray, size: int) -> pa.Table:
    """The block's documents without the windows that begin at ``starts``."""
    n = len(block.starts)
    step = np.zeros(n + 1, np.int64)
    np.add.at(step, starts, 1)
    np.add.at(step, starts + size, -1)
    gone = np.cumsum(step[:-1]) > 0
    before = np.concatenate([[0], np.cumsum(gone)])
    removed = before[block.first[1:]] - before[block.first[:-1]]
    kept = block.buf[np.repeat(~gone, block.ends - block.starts + 1)]
    size_of = np.where(gone, 0, block.ends - block.starts + 1)
    upto = np.concatenate([[0], np.cumsum(size_of)])[block.first]
    raw = kept.tobytes()
    texts = [raw[a:max(a, b - 1)] for a, b in zip(upto[:-1].tolist(), upto[1:].tolist())]
    spans = []
    for d, r in enumerate(removed.tolist()):
        if not r:
            spans.append([])
            continue
        edge = np.diff(np.concatenate([[0], gone[block.first[d]:block.first[d + 1]].view(np.int8), [0]]))
        spans.append([{"start": int(a), "end": int(b)} for a, b in zip(np.flatnonzero(edge == 1), np.flatnonzero(edge == -1))])
    text = pa.array(texts, pa.binary()).cast(pa.string())
    return pa.table([id_array(block.ids), pa.array(block.counts), pa.array(removed), text, pa.array(spans, _SPAN)], names=_COLUMNS)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract rows over all documents."""
    out = dedup_substrings(spark, spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


SQL = r"""
WITH docs AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
starts AS (SELECT doc_id, ws, unnest(range(1, len(ws) - 18)) AS p FROM docs WHERE len(ws) >= 20),
hashed AS (SELECT doc_id, p, array_to_string(ws[p:p + 19], ' ') AS win FROM starts),
later AS (SELECT doc_id, p, row_number() OVER (PARTITION BY win ORDER BY doc_id, p) AS nth FROM hashed),
gone AS (SELECT DISTINCT doc_id, unnest(range(p, p + 20)) AS w FROM later WHERE nth > 1),
by_doc AS (SELECT doc_id, list(w) AS ws_gone FROM gone GROUP BY doc_id),
kept AS (
  SELECT d.doc_id, len(d.ws) AS n_words, coalesce(len(g.ws_gone), 0) AS n_removed,
         CASE WHEN g.doc_id IS NULL THEN d.ws
              ELSE list_filter(d.ws, lambda x, i: NOT list_contains(g.ws_gone, i)) END AS left_over
  FROM docs d LEFT JOIN by_doc g USING (doc_id))
SELECT doc_id, n_words::BIGINT AS n_words, n_removed::BIGINT AS n_removed,
       sha256(coalesce(array_to_string(left_over, ' '), '')) AS kept_sha256 FROM kept
"""
