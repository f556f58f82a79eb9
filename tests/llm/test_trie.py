"""The trie of conversations against brute force, with all that is odd about the table."""

import hashlib
import random
import zlib

import pytest

from gaugeworks.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string, depth string, k1 int"  # extra columns with clashing names


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)


def brute(rows, shared=True):
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, (role or "").encode(), (text or "").encode()))
    own = {c: [(r, t) for _, _, r, t in sorted(x)] for c, x in own.items()}
    built = {}
    for c, x in own.items():
        h = zlib.crc32(str(c).encode()) % 6 if shared else 0
        built[c] = own.get(c - c % 100, [])[:h] + x[h:]
    nodes = {}
    for c, x in built.items():
        for d in range(len(x) + 1):
            nodes.setdefault(tuple(x[:d]), []).append(c)
    kids = {k: set() for k in nodes}
    for k in nodes:
        if k:
            kids[k[:-1]].add(k)
    leaves, saved = {}, {}
    for k in sorted(nodes, key=len, reverse=True):
        leaves[k] = sum(leaves[x] for x in kids[k]) + (not kids[k])
        saved[k] = sum(saved[x] for x in kids[k]) + ((len(nodes[k]) - 1) * len(k[-1][1].decode()) if k else 0)
    out = set()
    for k, members in nodes.items():
        ends = ",".join(map(str, sorted(c for c in members if len(built[c]) == len(k))))
        out.add((min(members), len(k), min(nodes[k[:-1]]) if k else None, len(members), len(kids[k]), leaves[k], saved[k], hashlib.sha256(ends.encode()).hexdigest()))
    return out


def got(df):
    rows = [tuple(r[c] for c in ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def conversations(seed):
    rnd = random.Random(seed)
    rows = []
    for c in [0, 1, 2, 3, 4, 7, 99, 100, 101, 150, 205, 206, 207, 300, 1234567]:
        rows += [(c, t if rnd.random() < 0.9 else None, rnd.choice(["user", "assistant", None]), rnd.choice(["a", "b", "ü€😀", "", None])) for t in range(rnd.randint(1, 8))]
    rows += [(301, 5, "user", "tie"), (301, 5, "user", "tie"), (301, 5, "assistant", "tie"), (301, None, "user", "z"), (301, None, "user", "a")]
    rows += [(400, t, "user", "same") for t in range(70)]  # long conversations that share most of their turns
    rows += [(401, t, "user", "same") for t in range(70)]
    rows += [(402, t, "user", "same" if t < 40 else "other") for t in range(64)]
    rows += [(403, 1, "user", "x" * 30_000), (None, 1, "user", "nobody"), (None, None, None, None)]
    rnd.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_trie_matches_brute_force(spark, seed):
    rows = conversations(seed)
    shared = prefix_trie.F.crc32(prefix_trie.F.col("conv_id").cast("string").cast("binary")) % 6
    assert got(prefix_trie.conversation_trie(spark, frame(spark, rows), shared)) == brute(rows)


def test_trie_of_conversations_as_they_are(spark):
    rows = conversations(3)
    assert got(prefix_trie.conversation_trie(spark, frame(spark, rows).repartition(5))) == brute(rows, shared=False)


def test_copies_fill_a_node_and_span_tasks(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "PIECE_IDS", 16)
    rows = [(c, t, "user", f"turn {t}") for c in range(0, 300) for t in range(2)] + [(c, 0, "user", f"own {c}") for c in range(300, 340)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "7")
    try:
        assert got(prefix_trie.conversation_trie(spark, frame(spark, rows))) == brute(rows, shared=False)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "3")


def test_turnless_conversations_end_in_the_root(spark):
    # the family's first conversation is absent, and own turns are fewer than those that are taken over
    rows = [(c, 1, "user", "only") for c in range(501, 520)]
    shared = prefix_trie.F.crc32(prefix_trie.F.col("conv_id").cast("string").cast("binary")) % 6
    assert got(prefix_trie.conversation_trie(spark, frame(spark, rows), shared)) == brute(rows)


def test_empty_table_has_no_node(spark):
    assert got(prefix_trie.conversation_trie(spark, frame(spark, []))) == set()
    assert got(prefix_trie.conversation_trie(spark, frame(spark, [(None, 1, "user", "x")]))) == set()
