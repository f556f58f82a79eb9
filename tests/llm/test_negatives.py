"""Hard negatives against brute force, and the products over bit-slices."""

import math
from collections import Counter

import numpy as np
import pytest

from gaugeworks.llm import hard_negatives as hn

SCHEMA = "vec_id long, embedding array<double>, label int, rank string, window string"  # extra columns with clashing names


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA)


def brute(rows, every=100, best=5):
    use = [(i, [math.floor(256 * x) for x in v], label) for i, v, label in rows if label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    order = lambda x: (-x[0], (x[1] is None, x[1] or 0))
    out = Counter()
    for n, (i, v, label) in enumerate(use):
        if i is None or i % every:
            continue
        scored = [(sum(p * q for p, q in zip(v, w)), j, other == label) for m, (j, w, other) in enumerate(use) if m != n and len(v) == len(w)]
        for p, pid, _ in sorted((s for s in scored if s[2]), key=order)[:best]:
            fit = sorted((s for s in scored if not s[2] and 80 * p <= 100 * s[0] <= 100 * p), key=order)[:best]
            out.update((i, pid, k + 1, nid, p, s) for k, (s, nid, _) in enumerate(fit))
    return out


def got(df):
    return Counter(tuple(r[c] for c in ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")) for r in df.collect())


def vectors(seed, n=400, dim=6):
    rnd = np.random.RandomState(seed)
    rows = [(i, rnd.normal(0, 0.4, dim).tolist(), int(rnd.choice([0, 1, 2], p=[0.6, 0.3, 0.1]))) for i in range(n)]
    rows += [(i, [0.5, 0.25, 0.0, 0.0, 0.5, 0.1], i % 2) for i in range(1000, 1030)]  # ties
    rows += [(100, [0.3] * dim, 0), (100, [0.3] * dim, 0), (200, [0.1] * dim, 1), (None, [0.4] * dim, 0), (None, [0.4] * dim, 1)]
    rows += [(300, None, 1), (301, [0.1] * dim, None), (400, [0.1, None, 0.2, 0.3, 0.1, 0.1], 1), (500, [float("nan")] + [0.1] * 5, 1), (600, [float("inf")] + [0.1] * 5, 0)]
    rows += [(700, [0.0] * dim, 0), (800, [1.0, 2.0], 0), (801, [2.0, 1.0], 0), (802, [1.5, 1.0], 1), (900, [], 0), (901, [], 0), (902, [], 1)]
    rows += [(1100, [3e4, -2e4, 1.0, 0.0, 0.0, 5e3], 0), (1101, [3e4, -2e4, 2.0, 0.0, 0.0, 5e3], 0), (1102, [3e4, -2e4, 1.5, 0.0, 0.0, 4e3], 1), (1200, [5.0] * dim, 77)]
    return rows


@pytest.mark.parametrize("tile, square", [(4096, 512), (32, 16)])
def test_hard_negatives_match_brute_force(spark, monkeypatch, tile, square):
    monkeypatch.setattr(hn, "SQUARE", square)
    monkeypatch.setattr(hn.pack_tiles, "__defaults__", (hn.SCALE, tile))
    rows = vectors(1)
    expected = brute(rows)
    assert len(expected) > 50
    assert got(hn.hard_negatives(spark, frame(spark, rows).repartition(3))) == expected


def test_many_blocks_of_anchors(spark):
    rows = vectors(2, n=150)
    assert got(hn.hard_negatives(spark, frame(spark, rows), every=5, block_bytes=2048)) == brute(rows, every=5)


def test_sliced_pairs_are_exact():
    rnd = np.random.RandomState(5)
    for top in (3, 300, 1 << 20, 1 << 27):
        a, b = rnd.randint(-top, top, (20, 9)), rnd.randint(-top, top, (50, 9))
        bits, packed = hn.to_planes(b)
        full = a @ b.T
        low, high = np.percentile(full, [90, 40], axis=1).astype(np.int64).T, np.percentile(full, [97, 45], axis=1).astype(np.int64).T
        i, j, s = hn.sliced_pairs(a, hn.planes_of(np.frombuffer(packed, np.uint8), bits, 50, 9), low, high)
        inside = ((full[:, :, None] >= low[:, None]) & (full[:, :, None] <= high[:, None])).any(axis=2)
        assert set(zip(i.tolist(), j.tolist())) == set(zip(*(x.tolist() for x in np.nonzero(inside)))) and (full[i, j] == s).all()


def test_vectors_beyond_a_long_take_no_part(spark):
    rows = [(0, [1e30, 1.0], 0), (1, [1e30, 1.0], 0), (100, [1.0, 1.0], 0), (101, [1.0, 1.0], 0), (102, [0.9, 1.0], 1)]
    assert got(hn.hard_negatives(spark, frame(spark, rows))) == brute(rows[2:])


def test_empty_table(spark):
    assert got(hn.hard_negatives(spark, frame(spark, []))) == Counter()
    assert got(hn.hard_negatives(spark, hn.relabelled(frame(spark, [(1, [1.0], 0), (7, None, 1)])))) == Counter()


def test_relabelled(spark):
    rows = [(7, [1.0], 9), (8, [1.0], 9), (None, [1.0], 3), (14, [1.0], None)]
    assert [r["label"] for r in hn.relabelled(frame(spark, rows)).collect()] == [0, 9, 3, None]
