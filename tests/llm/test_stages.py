"""The pipeline's stages against brute force, and on null, empty, long, repeated and oddly named input."""

import random
import re
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest

from gaugeworks.llm import mixing, sharding, toxicity
from gaugeworks.llm._text import NON_ALNUM, split_words

corpus_pipeline = pytest.importorskip("corpus_pipeline")
SF = Path("/root/testdata/sf0.001")
STAGES = dict(corpus_pipeline.STAGES)
#: columns of documents, and names that operators use themselves
COLUMNS = ("doc_id long, text string, lang string, source string, n_chars long, row string, id string, score double, label string, component_id string, "
           "n_hit string, spans string, n_tokens string, rate string, copies string, shard string, slot string, size string, block_id string, payload string")
WIDTH = COLUMNS.count(",") + 1
lower = lambda t: re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


def plain_toxic(text, weights, bias):
    _, bucket = toxicity.features(split_words(pa.array([text or ""]), NON_ALNUM, lower=True), len(weights).bit_length() - 1)
    return bias + sum(float(weights[b]) for b in set(bucket.tolist())) >= 0


def plain_gone(rows, size=5):
    """Ids that have a smaller one in their component of five-word sets of 0.8 or more."""
    sets = {}
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", lower(t))
        sets[i] = {tuple(w[p:p + size]) for p in range(max(1, len(w) - size + 1))} if w else set()
    least = {i: i for i in sets}
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and 10 * len(sets[a] & sets[b]) >= 8 * len(sets[a] | sets[b])]
    for _ in sets:
        before = dict(least)
        for a, b in links:
            least[a] = least[b] = min(least[a], least[b])
        if before == least:
            break
    return {i for i, m in least.items() if m != i}


def plain_hit(text, items, size=13):
    word = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    w, hit = re.findall(word, lower(text)), set()
    for item in items:
        g = re.findall(word, lower(item))
        n = min(size, len(g))
        grams = {tuple(g[p:p + n]) for p in range(len(g) - n + 1)} if n else set()
        for p in range(len(w) - n + 1):
            if tuple(w[p:p + n]) in grams:
                hit.update(range(p, p + n))
    return bool(hit) and 20 * len(hit) >= len(w)


@pytest.mark.skipif(not SF.exists(), reason="no tables")
def test_run_matches_brute_force(spark):
    docs, labels, bench = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels", "benchmark"))
    weights, bias = toxicity.learn(spark, docs, labels)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    rows = [(i, t) for i, t in rows if not plain_toxic(t, weights, bias)]
    gone = plain_gone(rows)
    items = [r["text"] for r in bench.collect()]
    rows = [(i, t) for i, t in rows if i not in gone and not plain_hit(t, items)]
    assert gone and len(rows) < docs.count() - len(gone)
    kept = docs.filter(docs["doc_id"].isin([i for i, _ in rows]))
    model = mixing.fit_rates(spark, kept, mixing.quality_domains(labels).filter("domain <> 'toxic'"), corpus_pipeline.TARGETS, least=1.0)
    _, margins = model.margins(pa.array([t for _, t in rows], pa.string()))
    rates = [1.0] * len(rows)
    for i, p in enumerate(model.posteriors(margins)):
        for g, length in model.steps:
            rates[i] = max(1.0, rates[i] - length * (sum((x - s) * y for x, s, y in zip(p, model.wanted, g)) + model.weight * (rates[i] - 1)))
    times = mixing.n_copies(np.array(rates), pa.array([i for i, _ in rows]))
    mixed = [r for r, n in zip(rows, times.tolist()) for _ in range(n)]
    described = sorted((i, zlib.crc32((t or "").encode()), len((t or "").encode()) + 8) for i, t in mixed)
    places = sharding.permute(np.arange(len(described)), len(described)).tolist()
    expected = sorted((i, size, crc, p % 24, p // 24) for (i, crc, size), p in zip(described, places))
    got = corpus_pipeline.run(spark, str(SF)).select("doc_id", "size", "text_crc32", "shard", "slot").collect()
    assert sorted(map(tuple, got)) == expected


@pytest.fixture(scope="module")
def odd(spark, tmp_path_factory):
    """Tables with nulls in every column, empty and very long texts, repeated rows and clashing names."""
    rnd = random.Random(12)
    text = lambda n: " ".join(f"w{rnd.randrange(5000)}" for _ in range(n))
    item, once, long = text(30), text(50), text(250_000)
    texts = [(i, text(40)) for i in range(40)]
    texts += [(50, None), (51, ""), (52, " \n"), (None, None), (None, once), (53, once), (53, once), (54, long), (55, long + " x"), (56, "y" * 1_500_000), (57, item), (None, item)]
    fill = lambda i, t: (i, t, *(None if i is None or i % 2 else 1.5 if c == 7 else len(t or "") if c == 4 else "s" for c in range(2, WIDTH)))
    rows = [fill(i, t) for i, t in texts]
    path = str(tmp_path_factory.mktemp("odd"))
    spark.createDataFrame(rows, COLUMNS).write.parquet(f"{path}/documents.parquet")
    labels = [(i, i % 2, 0) for i in range(30)] + [(None, None, None), (None, 1, 1), (3, None, None), (999, 1, 0), (4, 0, 0)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(1, item), (1, item), (None, None), (2, "")], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path, rows, once, item


def written(spark, df, path):
    df.write.parquet(path)
    return [tuple(r) for r in spark.read.parquet(path).collect()]


@pytest.mark.parametrize("name", list(STAGES))
def test_stage_on_odd_input(spark, odd, tmp_path, name):
    path, rows, once, item = odd
    docs = spark.read.parquet(f"{path}/documents.parquet")
    out = STAGES[name](spark, docs, path)
    got = written(spark, out, f"{tmp_path}/out")
    if name == "sharding":
        assert Counter((r[0], r[1]) for r in got) == Counter((i, len((t or "").encode()) + 8) for i, t, *_ in rows)
        return
    assert out.columns == docs.columns
    expected = Counter(rows)
    if name == "near_duplicates":
        # of equal texts the smallest id stays, a null one last; of equal rows one; texts without words all stay
        for r in [r for r in rows if (r[0], r[1]) == (None, once) or r[0] in (55,) or (r[0], r[1]) == (None, item)]:
            del expected[r]
        expected[next(r for r in rows if r[0] == 53)] = 1
    if name == "decontamination":
        expected = Counter({r: n for r, n in expected.items() if r[1] != item})
    if name == "mixing":
        assert set(got) == set(expected) and all(n >= expected[r] for r, n in Counter(got).items())
    else:
        assert Counter(got) == expected


@pytest.mark.parametrize("name", list(STAGES))
def test_stage_on_empty_tables(spark, odd, tmp_path, name):
    path = odd[0]
    for t in ("labels", "benchmark"):
        spark.read.parquet(f"{path}/{t}.parquet").limit(0).write.parquet(f"{tmp_path}/{t}.parquet")
    docs = spark.read.parquet(f"{path}/documents.parquet")
    for i, sf_dir in enumerate((path, str(tmp_path))):
        assert written(spark, STAGES[name](spark, docs.limit(0), sf_dir), f"{tmp_path}/none-{i}") == []
    few = docs.filter("doc_id < 40")
    got = written(spark, STAGES[name](spark, few, str(tmp_path)), f"{tmp_path}/few")
    assert sorted(r[0] for r in got) == list(range(40))  # nothing learnt, nothing listed: all stay, once
