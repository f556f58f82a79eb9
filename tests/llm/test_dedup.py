"""Substring dedup, Jaccard join and embedding dedup against brute force."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest

from gaugeworks.llm import embedding_dedup, jaccard_join, substring_dedup
from gaugeworks.llm._components import components
from gaugeworks.llm._store import Workspace

DOCS = "doc_id long, text string, n_words long, slice string, keys int"  # extra columns with clashing names


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def near_copies(seed=3):
    rnd = random.Random(seed)
    vocab = [f"w{i}" for i in range(60)] + ["Über", "naïve"]
    base = [[rnd.choice(vocab) for _ in range(n)] for n in (30, 45, 60, 5, 90)]
    rows = [(100, None), (101, ""), (102, " \t\n"), (103, "one two"), (104, "ONE two"), (105, "x")]
    for i in range(60):
        b = list(rnd.choice(base))
        for _ in range(rnd.randint(0, 3)):
            b[rnd.randrange(len(b))] = rnd.choice(vocab)
        rows.append((i, rnd.choice([" ", "  ", "\n"]).join(b)))
    rows += [(7, rows[20][1]), (7, rows[20][1])]  # repeated rows
    rows.append((200, " ".join(rnd.choice(vocab) for _ in range(4000))))  # a very long text
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(i, t, 1, "s", 2) for i, t in rows], DOCS)


def test_substring_dedup_removes_what_starts_earlier(spark):
    rows = [r for r in near_copies() if r[0] != 7] + [(None, "a b c d e f g h " * 3)]
    size = 6
    top = 1 << 62
    first = {}
    for i, t in rows:
        w = words(t)
        for p in range(len(w) - size + 1):
            k, at = tuple(w[p:p + size]), (top if i is None else i, p)
            first[k] = min(first.get(k, at), at)
    expected = {}
    for i, t in rows:
        w, gone = words(t), set()
        for p in range(len(w) - size + 1):
            if first[tuple(w[p:p + size])] < (top if i is None else i, p):
                gone.update(range(p, p + size))
        expected[i] = (len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone))
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_text"]) for r in substring_dedup.dedup_substrings(spark, frame(spark, rows), size=size).collect()}
    assert got == expected
    spans = {r["doc_id"]: r["removed"] for r in substring_dedup.dedup_substrings(spark, frame(spark, rows), size=size).select("doc_id", "removed").collect()}
    assert all(sum(s["end"] - s["start"] for s in spans[i]) == expected[i][1] for i in expected)


def test_substring_dedup_of_repeated_rows_and_empty_tables(spark):
    t = " ".join(f"v{i}" for i in range(25))
    got = substring_dedup.dedup_substrings(spark, frame(spark, [(1, t), (1, t), (2, t)])).select("doc_id", "n_removed").collect()
    assert sorted(map(tuple, got)) == [(1, 0), (1, 0), (2, 25)]
    assert substring_dedup.dedup_substrings(spark, frame(spark, [])).count() == 0


def brute_groups(rows, size, num, den):
    lower = lambda t: re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
    sets = []
    for _, t in rows:
        w = words(lower(t))
        sets.append({tuple(w[p:p + size]) for p in range(max(1, len(w) - size + 1))} if w else set())
    ids = sorted({i for i, _ in rows})
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and den * len(sets[a] & sets[b]) >= num * len(sets[a] | sets[b]):
                x, y = find(rows[a][0]), find(rows[b][0])
                root[max(x, y)] = min(x, y)
    return sorted((i, len(s), find(i)) for (i, _), s in zip(rows, sets))


@pytest.mark.parametrize("size,num,hot", [(3, 90, 32), (2, 60, 2), (5, 80, 1)])
def test_jaccard_groups_lose_no_link(spark, monkeypatch, size, num, hot):
    monkeypatch.setattr(jaccard_join, "HOT", hot)
    monkeypatch.setattr(jaccard_join, "TILE", 4)
    rows = [r for r in near_copies(size) if r[0] != 7] + [(7, "q r s t u v"), (7, "q r s t u v")]
    got = jaccard_join.jaccard_groups(spark, frame(spark, rows), size=size, threshold=(num, 100)).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted(map(tuple, got)) == brute_groups(rows, size, num, 100)


def test_jaccard_of_null_ids_and_empty_tables(spark):
    got = jaccard_join.jaccard_groups(spark, frame(spark, [(None, "a b c d e f"), (3, "a b c d e f"), (4, None)])).collect()
    assert sorted((r["doc_id"] is None, r["component_id"]) for r in got) == [(False, 3), (False, 4), (True, 3)]
    assert jaccard_join.jaccard_groups(spark, frame(spark, [])).count() == 0


def row_components(rows, size, num):
    """Each row's smallest id reachable by links; rows are nodes, ids are only names."""
    sets = []
    for _, t in rows:
        w = words((t or "").lower())
        sets.append({tuple(w[p:p + size]) for p in range(len(w) - size + 1)} or ({tuple(w)} if w else set()))
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= num * len(sets[a] | sets[b]):
                root[find(a)] = find(b)
    least = {}
    for k, (i, _) in enumerate(rows):
        r = find(k)
        least[r] = min((x for x in (least.get(r), i) if x is not None), default=None)
    return sorted(((i, len(sets[k]), least[find(k)]) for k, (i, _) in enumerate(rows)), key=repr)


@pytest.mark.parametrize("parts", [1, 7])
def test_repeated_and_null_ids_are_linked_by_their_texts(spark, parts):
    rnd = random.Random(4)
    text = lambda seed, n=60: [f"w{random.Random(seed * 1000 + k).randint(0, 400)}" for k in range(n)]
    near = lambda w: " ".join([*w[:20], f"new{rnd.randint(0, 99)}", *w[21:]])
    x, y, z = text(1), text(2), text(3)
    rows = [(5, " ".join(x)), (5, " ".join(y)), (9, near(y)), (7, near(x)), (3, " ".join(z)), (None, near(z)), (None, near(y)), (None, " ".join(text(4))), (None, near(text(4)))]
    rows += [(5, " ".join(y)), (11, None), (11, "  "), (12, "one two"), (12, "ONE  two"), (4, " ".join(text(5)))] + [(20 + k, " ".join(text(6 + k))) for k in range(30)]
    got = jaccard_join.jaccard_groups(spark, frame(spark, rows).repartition(parts), size=3, threshold=(80, 100)).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted(map(tuple, got), key=repr) == row_components(rows, 3, 80)
    kept = jaccard_join.drop_similar(spark, frame(spark, [(1, "a b c d e f"), (2, "a b c d e f"), (3, "")]))
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 3] and kept.columns == ["doc_id", "text", "n_words", "slice", "keys"]


def test_two_similar_sets_share_a_word_that_neither_leaves_out():
    rnd = np.random.RandomState(1)
    for num in (60, 80, 90):
        bands = jaccard_join.Bands(num, 100)
        for n in (1, 2, 3, 9, 40, 300, 2500):
            a = np.unique(rnd.randint(0, 1 << 62, n).astype(np.uint64))
            most = int(n * (100 - num) / num)
            b = np.unique(np.concatenate([a, rnd.randint(0, 1 << 62, most).astype(np.uint64)]))
            if jaccard_join.similar(a, b, num, 100):
                ka, ba, ra = jaccard_join.word_keys(a, bands)
                kb, bb, rb = jaccard_join.word_keys(b, bands)
                same = np.intersect1d(ka, kb)
                assert len(same)
                room = {i: r for i, r in zip(ba.tolist(), ra.tolist())}
                assert max((np.isin(ka[ba == i], kb).sum() - max(room[i], 0)) for i in room) >= 1
            x, y = (np.frombuffer(jaccard_join.bit_sketch(s), "<u8") for s in (a, b))
            w = min(len(x), len(y))
            apart = int(np.bitwise_count(jaccard_join.folded(x, w) ^ jaccard_join.folded(y, w)).sum())
            assert apart <= len(np.setxor1d(a, b))


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(50, 90)] + [(1, i) for i in range(2, 20)] + [(300, 200), (200, 300), (5, 5)]
    got = components(spark, spark.createDataFrame(edges, "a long, b long"), Workspace(spark, "test")).collect()
    exp = {i: 50 for i in range(50, 91)} | {i: 1 for i in range(1, 20)} | {200: 200, 300: 200}
    assert {r["node"]: r["component"] for r in got} == exp
    assert components(spark, spark.createDataFrame([], "a long, b long"), Workspace(spark, "test")).count() == 0


def test_embedding_dedup_matches_brute_force(spark):
    rnd = np.random.RandomState(5)
    base = rnd.randn(8, 12)
    rows = []
    for i in range(150):
        v = base[rnd.randint(8)] + rnd.randn(12) * rnd.choice([0.0, 0.1, 0.25, 0.6])
        rows.append((i, v.astype(np.float32).tolist(), int(rnd.randint(3))))
    rows += [(900, None, 1), (901, [0.0] * 12, 1), (902, [float("nan")] + [1.0] * 11, 1), (903, [float("inf")] + [1.0] * 11, 0), (904, [None] + [1.0] * 11, 0),
             (905, rows[0][1], None), (906, rows[3][1], rows[3][2]), (907, rows[3][1], rows[3][2]), (908, [1.0, 2.0], 1), (909, [], 1)]
    ok = lambda v: v and all(x is not None and np.isfinite(x) for x in v) and any(v)
    good = [r for r in rows if ok(r[1]) and r[2] is not None]
    links = {r[0]: set() for r in rows}
    for a in good:
        for b in good:
            if a[0] != b[0] and a[2] == b[2] and len(a[1]) == len(b[1]):
                x, y = np.array(a[1], float), np.array(b[1], float)
                if x @ y / np.sqrt((x @ x) * (y @ y)) >= 0.93:
                    links[a[0]].add(b[0])
    comp = {}
    for i in links:
        seen, todo = {i}, [i]
        while todo:
            for j in links[todo.pop()] - seen:
                seen.add(j)
                todo.append(j)
        comp[i] = min(seen)
    df = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<float>, label int, links int")
    got = embedding_dedup.near_vectors(spark, df, tile_rows=16).collect()
    assert sorted(map(tuple, got)) == sorted((i, len(links[i]), comp[i], comp[i] == i) for i in links)
    assert embedding_dedup.near_vectors(spark, df.limit(0)).count() == 0


def test_squares_of_a_tile_meet_once():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(70, 6))
    x[35:] = x[:35] + rng.normal(scale=0.1, size=(35, 6))
    axes = embedding_dedup.principal_axes(x)
    x = x[np.argsort((x / np.linalg.norm(x, axis=1, keepdims=True) @ axes)[:, 0])]
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    whole = {(i, j) for i, j in zip(*np.nonzero(u @ u.T >= 0.9)) if i < j}
    for square in (16, 1024):
        i, j = embedding_dedup.close_pairs(x, x, axes, 0.9, square=square, same=True)
        assert whole and len(i) == len(whole) and set(zip(i.tolist(), j.tolist())) == whole


def test_doubles_stay_doubles(spark):
    """Components that a float can't hold apart, and beyond its range."""
    rows = [(1, [1e300, 0.0], 0), (2, [2e300, 0.0], 0), (3, [1.0, 1e-300], 0), (4, [0.0, 1e-300], 0), (5, [0.0, 2e-300], 0)]
    got = {r["vec_id"]: r["component_id"] for r in embedding_dedup.near_vectors(spark, spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()}
    assert got[5] == 4 and got[3] == 3 or got[3] == 1


def test_a_rotation_keeps_cosines():
    rnd = np.random.RandomState(2)
    a = rnd.randn(40, 9)
    b = np.concatenate([a[:5] + 0.01, rnd.randn(30, 9)])
    i, j = embedding_dedup.close_pairs(a, b, embedding_dedup.principal_axes(a), 0.9)
    cos = (a / np.linalg.norm(a, axis=1, keepdims=True)) @ (b / np.linalg.norm(b, axis=1, keepdims=True)).T
    assert sorted(zip(i, j)) == sorted(zip(*np.nonzero(cos >= 0.9)))




def test_close_pairs_are_those_of_a_double_loop():
    """Groups of both kinds, sizes and sketches of several lengths, in one call and over batch borders."""
    rng = np.random.default_rng(4)
    rows = []
    for key in range(40):
        base = rng.integers(0, 1 << 62, 400).astype(np.uint64)
        for _ in range(int(rng.integers(1, 12))):
            own = np.unique(np.concatenate([base[: int(rng.integers(5, 400))], rng.integers(0, 1 << 62, int(rng.integers(0, 9))).astype(np.uint64)]))
            kind = key % 2
            rows.append((key, kind, 0, key % 3, 3 if not kind and key % 3 == 0 else int(rng.integers(1, 3)), len(rows), int(rng.integers(0, 4)), len(own), jaccard_join.bit_sketch(own)))
    names = ["key", "kind", "low", "high", "side", "id", "component", "n_shingles", "sketch"]
    t = pa.table({n: list(c) for n, c in zip(names, zip(*rows))})
    starts = np.append(jaccard_join._group_starts(t, names[:4]), t.num_rows)
    got = {tuple(sorted(p)) for p in zip(*jaccard_join._close_pairs(t, starts, 80, 100).to_pydict().values())}
    expected = set()
    for i, a in enumerate(rows):
        for b in rows[i + 1:]:
            sides = (a[4] == b[4] == 3) or a[4] + b[4] == 3
            if a[:4] != b[:4] or a[6] == b[6] or not sides or min(a[7], b[7]) * 100 < max(a[7], b[7]) * 80:
                continue
            x, y = (np.frombuffer(s[8], "<u8") for s in (a, b))
            n = min(len(x), len(y))
            if np.bitwise_count(jaccard_join.folded(x, n) ^ jaccard_join.folded(y, n)).sum() <= jaccard_join.most_different(a[7], b[7], 80, 100):
                expected.add((a[5], b[5]))
    assert expected and got == expected


def family(n, rnd):
    """Sets that all reach 0.8 with each other, but not with the first, which is their keys' hub."""
    base = [f"w{i}" for i in range(150)]
    cut = lambda at, k: " ".join([*base[:at], *(f"x{rnd.random()}" for _ in range(k)), *base[at + k:]])
    return [(0, cut(60, 24))] + [(i, cut(rnd.randrange(10, 136), 4)) for i in range(1, n)]


def test_links_of_a_family_join_it_in_parts(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "PART_BYTES", 3000)
    docs = family(60, random.Random(2))
    got = jaccard_join.jaccard_groups(spark, frame(spark, docs)).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted(map(tuple, got)) == brute_groups(docs, 5, 80, 100)


def test_joining_links_are_a_forest_of_the_similar_pairs():
    rnd = np.random.RandomState(4)
    base = np.unique(rnd.randint(0, 1 << 62, 200).astype(np.uint64))
    sets = [np.unique(np.concatenate([rnd.permutation(base)[d:], rnd.randint(0, 1 << 62, d).astype(np.uint64)])) for d in rnd.randint(0, 30, 40)]
    n, zero = len(sets), np.zeros(len(sets), np.int64)
    t = pa.table({"id": np.arange(n), "component": np.arange(n), "n_shingles": [len(x) for x in sets], "side": zero + 3, "part": zero, "part_low": zero, "part_high": zero,
                  "shingles": pa.array([x.tobytes() for x in sets], pa.binary())})
    got = list(zip(*jaccard_join._joining_links(t, np.array([0, n]), 80, 100).to_pydict().values()))
    root = list(range(n))

    def find(x):
        return x if root[x] == x else find(root[x])

    for a, b in got:
        assert jaccard_join.similar(sets[a], sets[b], 80, 100) and find(a) != find(b)
        root[find(a)] = find(b)
    assert all(find(a) == find(b) for a in range(n) for b in range(a) if jaccard_join.similar(sets[a], sets[b], 80, 100))
    assert 0 < len(got) < n
