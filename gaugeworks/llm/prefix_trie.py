"""The trie of conversation prefixes, and totals over its subtrees by leaf peeling.

A node is a distinct sequence of the first d turns (role and text) of some conversation,
named by 128 bits: the exclusive-or of its turns' hashes, each mixed with its place.
Prefixes so come from a running hash in a global order, and no task holds a conversation.

Leaf peeling passes messages: a node holds a counter of the children it still waits
for, and the exclusive-or of their names.  A node that waits for none is complete and
sends its subtree's totals to its parent; when only the root is left to complete, all is
told.  A node that waits for one child knows its name by the exclusive-or, adds what
that child has gathered and waits for the child's own last child instead: long unbranched
stretches halve in each round, and rounds grow with the logarithm of the trie, not
with the longest conversation.

The conversations that end in a node are digested in order of their ids: ids are dealt by
range, so that a node of any size is put into text by many tasks; a node that
spans tasks then has its pieces of text hashed one after another, as the digest asks.

Defined results: turns are ordered by turn (null first), then role, then text; a null
role or text is empty; rows that repeat are turns of their own; rows with a null
conv_id belong to no conversation and are left out; without conversations there is
no node; texts of any length are hashed whole; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ._running import running
from ._store import Workspace

#: ids of one piece of text that goes into a digest
PIECE_IDS = 1 << 16
#: most turns that conversations share in the query, less one, and conversations that share them
SHARED, FAMILY = 6, 100
NOTHING = hashlib.sha256().hexdigest()


def ordered_turns(ws: Workspace, conversations: DataFrame) -> DataFrame:
    """conv_id, pos (from 1 in the conversation's order), two hashes of role and text, and the text's code points."""
    empty = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), "turn", empty("role").alias("role"), empty("text").alias("text")).filter("conv_id is not null")
    hashed = rows.select("*", F.xxhash64(F.lit(1), "role", "text").alias("h1"), F.xxhash64(F.lit(2), "role", "text").alias("h2"), F.char_length("text").cast("long").alias("chars"))
    return running(ws, hashed, "conv_id", ["turn", "role", "text"], ["h1", "h2", "chars"], [], "turns").withColumnRenamed("conv_id", "own")


def placed_turns(ws: Workspace, conversations: DataFrame, shared: Column | None = None, family: int = FAMILY) -> tuple[DataFrame, DataFrame]:
    """Turns (conv_id, depth, m1, m2, chars, ends) and conversations (conv_id, n_turns) of the sequences that the trie is of.

    With ``shared``, a column of conv_id, a conversation's first ``shared`` turns are those of
    the first conversation of its family, as many as that has; its own follow after as many.
    """
    turns = ordered_turns(ws, conversations)
    own = turns.groupBy(F.col("own").alias("conv_id")).agg(F.max("pos").alias("n")).withColumn("h", F.lit(0).cast("long") if shared is None else shared.cast("long"))
    own = ws.put(own.withColumn("base", F.col("conv_id") - F.col("conv_id") % family), "own")
    firsts = own.filter("conv_id = base").select("base", F.col("n").alias("n_base"))
    taken = F.least("h", F.coalesce("n_base", F.lit(0)))
    convs = ws.put(own.join(firsts, "base", "left").select("conv_id", "base", "h", taken.alias("taken"), (taken + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("n_turns")), "convs")
    cols = ["conv_id", "depth", "h1", "h2", "chars", (F.col("depth") == F.col("n_turns")).cast("long").alias("ends")]
    tail = turns.withColumnRenamed("own", "conv_id").join(convs, "conv_id").filter("pos > h").withColumn("depth", F.col("pos") - F.col("h") + F.col("taken")).select(*cols)
    if shared is not None:
        # a family's first turns, SHARED - 1 at most of each, meet the family
        head = turns.filter(F.col("own") % family == 0).withColumnRenamed("own", "base").filter(F.col("pos") < SHARED)
        heads = convs.filter("taken > 0").join(head, "base").filter("pos <= taken").withColumn("depth", F.col("pos")).select(*cols)
        tail = tail.union(heads)
    mixed = tail.select("conv_id", "depth", F.xxhash64("h1", "depth").alias("m1"), F.xxhash64("h2", "depth", F.lit(2)).alias("m2"), "chars", "ends")
    return mixed, convs.select("conv_id", "n_turns")


def prefix_trie(ws: Workspace, turns: DataFrame, convs: DataFrame) -> DataFrame:
    """One row a node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens and ends_sha256."""
    path = running(ws, turns, "conv_id", ["depth"], ["depth", "m1", "m2", "chars", "ends"], ["m1", "m2"], "path")
    path = path.select("conv_id", "depth", F.col("run_m1").alias("k1"), F.col("run_m2").alias("k2"), F.col("run_m1").bitwiseXOR(F.col("m1")).alias("p1"), F.col("run_m2").bitwiseXOR(F.col("m2")).alias("p2"), "chars", "ends")
    inner = path.groupBy("k1", "k2").agg(*(F.min(c).alias(c) for c in ("p1", "p2", "depth", "chars", "conv_id")), F.count("*").alias("n_convs"))
    zero, none = F.lit(0).cast("long"), F.lit(None).cast("long")
    root = convs.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")).filter("n_convs > 0")
    root = root.select(zero.alias("k1"), zero.alias("k2"), none.alias("p1"), none.alias("p2"), zero.alias("depth"), zero.alias("chars"), "conv_id", "n_convs")
    nodes = ws.put(inner.unionByName(root), "nodes")

    kids = nodes.filter("p1 is not null").groupBy(F.col("p1").alias("k1"), F.col("p2").alias("k2")).agg(F.count("*").alias("n_children"), F.bit_xor("k1").alias("o1"), F.bit_xor("k2").alias("o2"))
    tree = ws.put(nodes.join(kids, ["k1", "k2"], "left").withColumns({"n_children": F.coalesce("n_children", zero), "o1": F.coalesce("o1", zero), "o2": F.coalesce("o2", zero)}), "tree")
    totals = peel(ws, tree.select("k1", "k2", "p1", "p2", F.col("n_children").alias("waits"), "o1", "o2", (F.col("n_children") == 0).cast("long").alias("leaves"), ((F.col("n_convs") - 1) * F.col("chars")).alias("saved")))
    above = tree.select(F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv_id").alias("parent_conv_id"))
    ends = path.filter("ends = 1").select("k1", "k2", "conv_id").union(convs.filter("n_turns = 0").select(zero.alias("k1"), zero.alias("k2"), "conv_id"))
    out = tree.join(totals, ["k1", "k2"]).join(digest_ids(ws, ends), ["k1", "k2"], "left").join(above, ["p1", "p2"], "left")
    return out.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"), F.coalesce("sha", F.lit(NOTHING)).alias("ends_sha256"))


def peel(ws: Workspace, live: DataFrame) -> DataFrame:
    """(k1, k2, leaves, saved) over each node's subtree.

    ``live``: a node's name k1, k2, its parent's p1, p2 (null for the root), ``waits``, the
    children it waits for, o1, o2, the exclusive-or of their names, and its own share.
    """
    live, done, round_no = ws.put(live, "live-0"), [], 0
    while True:
        ready = live.filter("waits = 0").select("k1", "k2", "p1", "p2", "leaves", "saved")
        done.append(ready.select("k1", "k2", "leaves", "saved"))
        left = live.filter("waits > 0")
        if left.isEmpty():
            return reduce(DataFrame.union, done)
        # nodes that wait for several children get one message, the sum of what completed children send
        sent = ready.groupBy(F.col("p1").alias("k1"), F.col("p2").alias("k2")).agg(F.count("*").alias("n"), F.bit_xor("k1").alias("x1"), F.bit_xor("k2").alias("x2"), F.sum("leaves").alias("more_leaves"), F.sum("saved").alias("more_saved"))
        many = left.filter("waits > 1").join(sent, ["k1", "k2"], "left")
        # those that wait for one look whether it is complete
        told = ready.select(F.col("k1").alias("o1"), F.col("k2").alias("o2"), F.lit(1).cast("long").alias("n"), F.col("k1").alias("x1"), F.col("k2").alias("x2"), F.col("leaves").alias("more_leaves"), F.col("saved").alias("more_saved"))
        one = left.filter("waits = 1").join(told, ["o1", "o2"], "left")
        cols = ["k1", "k2", "p1", "p2", "waits", "o1", "o2", "leaves", "saved"]
        add = lambda c, more: (F.col(c) + F.coalesce(more, F.lit(0))).alias(c)
        less = lambda c, x: F.col(c).bitwiseXOR(F.coalesce(x, F.lit(0).cast("long"))).alias(c)
        got = many.select("k1", "k2", "p1", "p2", *cols[4:], "n", "x1", "x2", "more_leaves", "more_saved").unionByName(one)
        got = ws.put(got.select("k1", "k2", "p1", "p2", (F.col("waits") - F.coalesce("n", F.lit(0))).alias("waits"), less("o1", "x1"), less("o2", "x2"), add("leaves", "more_leaves"), add("saved", "more_saved")), f"got-{round_no}")
        # of two nodes in a row that wait for one each, the upper takes over what the lower has and waits for
        waiting = got.filter("waits = 1")
        lower = waiting.select(F.col("k1").alias("o1"), F.col("k2").alias("o2"), F.col("o1").alias("n1"), F.col("o2").alias("n2"), F.col("leaves").alias("more_leaves"), F.col("saved").alias("more_saved"))
        moved = waiting.join(lower, ["o1", "o2"], "left").select("k1", "k2", "p1", "p2", "waits", F.coalesce("n1", "o1").alias("o1"), F.coalesce("n2", "o2").alias("o2"), add("leaves", "more_leaves"), add("saved", "more_saved"))
        round_no += 1
        live = ws.put(moved.union(got.filter("waits <> 1").select(*cols)), f"live-{round_no}")
        ws.drop(f"got-{round_no - 1}")


def digest_ids(ws: Workspace, ends: DataFrame) -> DataFrame:
    """(k1, k2, sha): SHA-256 of each node's ids, ascending and comma-joined, of ``ends`` (k1, k2, conv_id)."""
    order = ["k1", "k2", "conv_id"]

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, node, ids, seq, first, rows = TaskContext.get().partitionId(), None, [], 0, True, []

        def close(last: bool) -> None:
            """A node that lies within this task and one piece is done; others leave pieces."""
            text = ",".join(map(str, ids))
            whole = not (first or last or seq)
            rows.append((*node, part, seq, None if whole else text, hashlib.sha256(text.encode()).hexdigest() if whole else None))

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], names=["k1", "k2", "part", "seq", "text", "sha"])

        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.string(), pa.string()]
        for b in batches:
            k1, k2, conv = (b[c].to_numpy() for c in order)
            starts = np.flatnonzero(np.concatenate([[True], (k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1])])) if len(k1) else []
            for i, j in zip(starts, [*starts[1:], len(k1)]):
                if node is not None and node != (k1[i], k2[i]):
                    close(last=False)
                    ids, seq, first = [], 0, False
                node = (k1[i], k2[i])
                for at in range(i, j, PIECE_IDS):
                    ids += conv[at:min(at + PIECE_IDS, j)].tolist()
                    if len(ids) >= PIECE_IDS:
                        rows.append((*node, part, seq, ",".join(map(str, ids)), None))
                        ids, seq = [], seq + 1
            if rows:
                yield out()
                rows.clear()
        if node is not None and (ids or not seq):
            close(last=True)
            yield out()

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, sha = None, None
        for b in batches:
            done = []
            for k1, k2, text in zip(b["k1"].to_pylist(), b["k2"].to_pylist(), b["text"]):
                text = text.as_py()
                if node != (k1, k2):
                    if node is not None:
                        done.append((*node, sha.hexdigest()))
                    node, sha = (k1, k2), hashlib.sha256(text.encode())
                elif text:
                    sha.update(b"," + text.encode())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done)], names=["k1", "k2", "sha"])
        if node is not None:
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (*node, sha.hexdigest())], names=["k1", "k2", "sha"])

    dealt = ends.repartitionByRange(*order).sortWithinPartitions(*order)
    pieces = ws.put(dealt.mapInArrow(join, "k1 long, k2 long, part int, seq long, text string, sha string"), "pieces")
    spread = pieces.filter("sha is null").repartition("k1", "k2").sortWithinPartitions("k1", "k2", "part", "seq")
    return pieces.filter("sha is not null").select("k1", "k2", "sha").union(spread.select("k1", "k2", "text").mapInArrow(digest, "k1 long, k2 long, sha string"))


def conversation_trie(spark: SparkSession, conversations: DataFrame, shared: Column | None = None) -> DataFrame:
    """Nodes of the trie of ``conversations`` (conv_id, turn, role, text), see :func:`placed_turns` and :func:`prefix_trie`."""
    ws = Workspace(spark, "prefix-trie")
    return prefix_trie(ws, *placed_turns(ws, conversations, shared))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract rows: conversations share the first turns of their hundred's first."""
    shared = F.crc32(F.col("conv_id").cast("string").cast("binary")) % SHARED
    return conversation_trie(spark, spark.read.parquet(f"{sf_dir}/conversations.parquet"), shared)


def _checksum(text: str) -> str:
    """SQL of the CRC-32 of ASCII text, bit by bit."""
    step = "c"
    for _ in range(8):
        step = f"list_transform([{step}], lambda y: xor(y >> 1, (y & 1) * {0xEDB88320}))[1]"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split({text}, ''), lambda s: ascii(s)::BIGINT)), lambda a, s: list_transform([xor(a, s)], lambda c: {step})[1]), 4294967295)"


SQL = f"""
WITH own AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
sizes AS (
  SELECT conv_id, n, conv_id - conv_id % {FAMILY} AS base, {_checksum("conv_id::VARCHAR")} % {SHARED} AS h
  FROM (SELECT conv_id, count(*) AS n FROM own GROUP BY conv_id)),
rebuilt AS (
  SELECT s.conv_id, o.pos AS depth, role, text FROM sizes s JOIN own o ON o.conv_id = s.base AND o.pos <= s.h
  UNION ALL
  SELECT s.conv_id, o.pos - s.h + least(s.h, coalesce(b.n, 0)), role, text
  FROM own o JOIN sizes s ON o.conv_id = s.conv_id AND o.pos > s.h LEFT JOIN sizes b ON b.conv_id = s.base),
told AS (SELECT conv_id, depth, length(text) AS chars, dense_rank() OVER (ORDER BY role, text) AS t FROM rebuilt),
lists AS (
  SELECT conv_id, coalesce(l, []) AS l FROM sizes LEFT JOIN (SELECT conv_id, list(t ORDER BY depth) AS l FROM told GROUP BY conv_id) USING (conv_id)),
steps AS (SELECT conv_id, l, unnest(range(len(l) + 1)) AS depth FROM lists),
path AS (SELECT conv_id, depth, len(l) = depth AS ends, l[1:depth] AS node, min(conv_id) OVER (PARTITION BY l[1:depth]) AS top FROM steps),
nodes AS (
  SELECT top, depth, count(*) AS n_convs, coalesce(string_agg(CASE WHEN ends THEN conv_id::VARCHAR END, ',' ORDER BY conv_id), '') AS ended
  FROM path GROUP BY top, depth),
links AS (SELECT DISTINCT a.top AS parent, a.depth, b.top AS child FROM path a JOIN path b ON a.conv_id = b.conv_id AND b.depth = a.depth + 1),
full_ AS (
  SELECT n.*, coalesce(k.n_children, 0) AS n_children, (n.n_convs - 1) * coalesce(t.chars, 0) AS saved
  FROM nodes n LEFT JOIN (SELECT parent, depth, count(*) AS n_children FROM links GROUP BY ALL) k ON k.parent = n.top AND k.depth = n.depth
  LEFT JOIN told t ON t.conv_id = n.top AND t.depth = n.depth),
below AS (
  SELECT DISTINCT a.top, a.depth, b.top AS low, b.depth AS low_depth FROM path a JOIN path b ON a.conv_id = b.conv_id AND b.depth >= a.depth),
sums AS (
  SELECT b.top, b.depth, count(*) FILTER (n_children = 0) AS n_leaves, sum(saved) AS saved_tokens
  FROM below b JOIN full_ f ON f.top = b.low AND f.depth = b.low_depth GROUP BY ALL)
SELECT f.top AS conv_id, f.depth::BIGINT AS depth, l.parent AS parent_conv_id, f.n_convs::BIGINT AS n_convs, f.n_children::BIGINT AS n_children,
       s.n_leaves::BIGINT AS n_leaves, s.saved_tokens::BIGINT AS saved_tokens, sha256(f.ended) AS ends_sha256
FROM full_ f JOIN sums s ON s.top = f.top AND s.depth = f.depth LEFT JOIN links l ON l.child = f.top AND l.depth = f.depth - 1
"""
