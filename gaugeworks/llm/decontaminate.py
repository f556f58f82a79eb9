"""Benchmark decontamination: a broadcast hash set of normalised test n-grams.

Training texts are scanned window by window; a hashed window that may be in the set
is verified byte by byte.  The set is broadcast in parts of at most ``part_bytes`` of item
text (an item that is longer has a part of its own): the parts' sizes are measured before
any is collected, and a larger benchmark takes several scans, whose hits are united by
document.  A part is a few flat arrays, some ten times as large as its text.

Defined results: null texts, and texts without words, have no windows and are never
hit; an item of fewer than ``size`` words (but not none) is one window of its own
length; items that share an id count as one; a null item id is written 'null'.
Repeated documents are judged one by one, and texts of any length whole; a null document
id comes back null; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from gaugeworks.operators.ordering import carried

from ._store import ROW, Workspace, bound_batches
from ._text import NON_ALNUM, pieces, release, split_words, window_hashes

SIZE = 13
PART_BYTES = 8 << 20
_SIEVE_BITS = 22
HITS_SCHEMA = "row long, n_words long, n_hit long, spans array<struct<start:long,end:long>>, items array<string>"
_SPAN = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


class Grams:
    """Windows of benchmark items by length, in flat arrays: hashes, a bit sieve, places in the items' words, and items."""

    def __init__(self, ids: list, texts: list, size: int = SIZE):
        words = split_words(pa.array(texts, pa.string()), NON_ALNUM, lower=True)
        self.buf = words.buf
        self.names = ["null" if i is None else str(i) for i in ids]
        hashes, doc = words.hashes(), words.doc_of()
        self.by_length: dict[int, _Windows] = {}
        for n in sorted({size, *(c for c in words.counts.tolist() if 0 < c < size)}):
            whole = words.counts >= size if n == size else words.counts == n
            at = np.flatnonzero(words.window_ok(n) & whole[doc])
            if len(at):
                self.by_length[n] = _Windows(window_hashes(hashes, n)[at], words.starts[at], words.ends[at + n - 1], doc[at], self.buf)

    def scan(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, list, list]:
        """Word counts, hit counts, hit spans and items of each text."""
        words = split_words(texts, NON_ALNUM, lower=True)
        hashes, n_docs = words.hashes(), len(words.counts)
        step = np.zeros(len(words.starts) + 1, np.int64)
        items: dict[int, set] = {}
        for n, windows in self.by_length.items():
            if len(hashes) < n:
                continue
            h = window_hashes(hashes, n)
            at = np.flatnonzero(windows.sieve[h >> np.uint64(64 - _SIEVE_BITS)] & words.window_ok(n))
            low, high = (np.searchsorted(windows.hash, h[at], side=x) for x in ("left", "right"))
            found = np.flatnonzero(low < high)
            doc = np.searchsorted(words.first, at[found], side="right") - 1
            for d, i, a, b in zip(doc.tolist(), at[found].tolist(), low[found].tolist(), high[found].tolist()):
                w = windows.same(words.buf[words.starts[i]:words.ends[i + n - 1]], a, b, self.buf)
                if w is not None:
                    step[i] += 1
                    step[i + n] -= 1
                    items.setdefault(d, set()).add((n, w))
        hit = np.cumsum(step[:-1]) > 0
        upto = np.concatenate([[0], np.cumsum(hit)])
        n_hit = upto[words.first[1:]] - upto[words.first[:-1]]
        spans = [[]] * n_docs
        for d in np.flatnonzero(n_hit).tolist():
            edge = np.diff(np.concatenate([[0], hit[words.first[d]:words.first[d + 1]].view(np.int8), [0]]))
            spans[d] = [{"start": a, "end": b} for a, b in zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist())]
        return words.counts, n_hit, spans, [self._named(items.get(d, ())) for d in range(n_docs)]

    def _named(self, hits) -> list[str]:
        """Names of the items that hold any of the windows, sorted."""
        if not hits:
            return []
        own = np.unique(np.concatenate([self.by_length[n].items(w) for n, w in hits]))
        return sorted({self.names[i] for i in own.tolist()})


class _Windows:
    """Distinct windows of one length by hash: where their words stand, and the items that hold them."""

    def __init__(self, hashes: np.ndarray, starts: np.ndarray, ends: np.ndarray, item: np.ndarray, buf: np.ndarray):
        order = np.lexsort((item, hashes))
        h, s, e = hashes[order], starts[order], ends[order]
        new = np.ones(len(h), bool)
        new[1:] = h[1:] != h[:-1]
        first = np.flatnonzero(new)[np.cumsum(new) - 1]
        # windows of one hash are one but by a rare chance: what differs from its hash's first is set apart
        apart = np.array([i for i in np.flatnonzero(~new).tolist() if not np.array_equal(buf[s[i]:e[i]], buf[s[first[i]]:e[first[i]]])], np.int64)
        group = np.cumsum(new) - 1
        if len(apart):
            group, new = _by_bytes(h, s, e, buf)
            order = order[np.argsort(group, kind="stable")]
            h, s, e, group = hashes[order], starts[order], ends[order], np.sort(group)
            new = np.concatenate([[True], group[1:] != group[:-1]])
        at = np.flatnonzero(new)
        self.hash, self.start, self.end = h[at], s[at], e[at]
        # each item once a window
        own = item[order]
        once = new | np.concatenate([[True], own[1:] != own[:-1]])
        self.item = own[once].astype(np.int32)
        self.begin = np.append(np.searchsorted(group[once], np.arange(len(at))), int(once.sum()))
        self.sieve = np.zeros(1 << _SIEVE_BITS, bool)
        self.sieve[self.hash >> np.uint64(64 - _SIEVE_BITS)] = True

    def same(self, window: np.ndarray, low: int, high: int, buf: np.ndarray) -> int | None:
        """The window among numbers low..high-1 that has these bytes."""
        return next((w for w in range(low, high) if np.array_equal(buf[self.start[w]:self.end[w]], window)), None)

    def items(self, window: int) -> np.ndarray:
        return self.item[self.begin[window]:self.begin[window + 1]]


def _by_bytes(h: np.ndarray, s: np.ndarray, e: np.ndarray, buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of distinct windows, in the order of their hashes; for hashes that several share."""
    seen: dict[tuple[int, bytes], int] = {}
    keys = [(x, buf[a:b].tobytes()) for x, a, b in zip(h.tolist(), s.tolist(), e.tolist())]
    for k in sorted(set(keys)):
        seen[k] = len(seen)
    group = np.array([seen[k] for k in keys], np.int64)
    return group, np.zeros(0, bool)


def item_parts(spark: SparkSession, benchmark: DataFrame, part_bytes: int = PART_BYTES) -> tuple[DataFrame, list[int]]:
    """Items (id, text, part) and the parts' numbers; no part is larger than ``part_bytes`` but for one item alone."""
    size = F.octet_length("text") + 64
    items = benchmark.select(F.col("item_id").alias("id"), F.col("text").cast("string").alias("text")).filter("text is not null")
    total = items.agg(F.coalesce(F.sum(size), F.lit(0))).first()[0]
    if total <= part_bytes:
        return items.withColumn("part", F.lit(0)), [0]
    # rows are dealt by the bytes of the rows before them, so that half a part and one item more, of half a part at most, go together
    rows = Workspace(spark, "benchmark").numbered(items.withColumn("size", size.cast("long")), "rows")
    half = max(1, part_bytes // 2)
    small = carried(rows.filter(F.col("size") <= half).select(ROW, "size"), ROW, "size", "before", F.sum)
    dealt = small.select(ROW, F.expr(f"coalesce(before, 0L) div {half}").alias("part"))
    # a larger item is a part of its own
    alone = rows.filter(F.col("size") > half).select(ROW, (-1 - F.col(ROW)).alias("part"))
    placed = Workspace(spark, "benchmark").put(rows.join(dealt.union(alone), ROW).select("id", "text", "part"), "placed")
    return placed, sorted(r["part"] for r in placed.select("part").distinct().collect())  # as many as parts


def find_hits(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SIZE, part_bytes: int = PART_BYTES) -> DataFrame:
    """doc_id, n_words, n_hit, spans (word numbers) and items of each document."""
    bound_batches(spark)
    items, parts = item_parts(spark, benchmark, part_bytes)
    picked = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    if len(parts) > 1:  # rows are numbered once, so that the scans' hits meet again
        picked = Workspace(spark, "decontaminate").put(picked.withColumn("row", F.monotonically_increasing_id()), "rows")
    found = None
    for p in parts:
        rows = items.filter(F.col("part") == p).collect()  # part_bytes at most, or one item
        grams = spark.sparkContext.broadcast(Grams([r["id"] for r in rows], [r["text"] for r in rows], size))

        def scan(batches: Iterator[pa.RecordBatch], grams=grams) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for ids, texts, *row in pieces(b.columns, 1):
                    n, hit, spans, who = grams.value.scan(texts)
                    yield pa.RecordBatch.from_arrays(
                        [ids, pa.array(n, pa.int64()), pa.array(hit, pa.int64()), pa.array(spans, _SPAN), pa.array(who, pa.list_(pa.string())), *row],
                        names=["doc_id", "n_words", "n_hit", "spans", "items", *(["row"] if row else [])],
                    )
                release()

        schema = "doc_id long, n_words long, n_hit long, spans array<struct<start:long,end:long>>, items array<string>"
        hits = picked.mapInArrow(scan, schema + (", row long" if len(parts) > 1 else ""))
        found = hits if found is None else found.union(hits)
    return found if len(parts) == 1 else _united(found)


def _united(hits: DataFrame) -> DataFrame:
    """One row a document from the rows of several scans."""
    spans = F.array_sort(F.flatten(F.collect_list("spans")))
    one = hits.groupBy("row", "doc_id", "n_words").agg(spans.alias("all"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))

    def merge(acc, x):
        last = F.element_at(acc, -1)
        grown = F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(F.struct(last["start"].alias("start"), F.greatest(last["end"], x["end"]).alias("end"))))
        return F.when((F.size(acc) > 0) & (F.try_element_at(acc, F.lit(-1))["end"] >= x["start"]), grown).otherwise(F.concat(acc, F.array(x)))

    merged = F.aggregate("all", F.filter("all", lambda x: F.lit(False)), merge)
    one = one.withColumn("spans", merged)
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda a, x: a + x["end"] - x["start"])
    return one.select("doc_id", "n_words", n_hit.alias("n_hit"), "spans", "items")


def is_contaminated():
    return (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))


def drop_contaminated(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """Documents, all columns, without those a twentieth of whose words are hit.

    Rows are judged one by one, whether their ids are null, repeated or neither.
    """
    ws = Workspace(spark, "decontaminated")
    rows = ws.numbered(docs, "rows")
    bad = find_hits(spark, rows, benchmark, id_col=ROW, **options).filter(is_contaminated()).select(F.col("doc_id").alias(ROW))
    return rows.join(ws.put(bad, "bad"), ROW, "left_anti").select(*docs.columns)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract rows over all documents and all items."""
    hits = find_hits(spark, spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return hits.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"), is_contaminated().alias("contaminated"),
    )


_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
SQL = rf"""
WITH items AS (SELECT item_id, {_WORDS} AS ws FROM benchmark),
grams AS (
  SELECT DISTINCT item_id, least(len(ws), {SIZE}) AS n, array_to_string(ws[p:p + least(len(ws), {SIZE}) - 1], ' ') AS win
  FROM (SELECT *, unnest(range(1, greatest(len(ws) - {SIZE - 1}, 1) + 1)) AS p FROM items WHERE len(ws) > 0)),
sizes AS (SELECT DISTINCT n FROM grams),
docs AS (SELECT doc_id, {_WORDS} AS ws FROM documents),
windows AS (
  SELECT doc_id, n, p, array_to_string(ws[p:p + n - 1], ' ') AS win
  FROM (SELECT doc_id, ws, n, unnest(range(1, len(ws) - n + 2)) AS p FROM docs, sizes WHERE len(ws) >= n)),
hits AS (SELECT doc_id, n, p, item_id FROM windows JOIN grams USING (n, win)),
words_hit AS (SELECT doc_id, count(DISTINCT w) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + n)) AS w FROM hits) GROUP BY doc_id),
items_hit AS (
  SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS joined
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS i FROM hits) GROUP BY doc_id)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(joined, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated
FROM docs LEFT JOIN words_hit USING (doc_id) LEFT JOIN items_hit USING (doc_id)
"""
