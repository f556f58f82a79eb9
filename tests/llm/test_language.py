"""Language identification: held-out accuracy, the network against loops, and odd rows."""

import zlib
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest

from gaugeworks.llm import language_id as li

SF = Path("/root/testdata/sf0.001")
SCHEMA = "doc_id long, text string, lang string, lang_pred string, id int"  # extra columns with clashing names
SAMPLES = {"aa": ["the", "of", "and", "thing", "that", "shore"], "bb": ["der", "ünd", "schön", "ist", "groß", "ein"], "cc": ["que", "ñino", "los", "ción", "por", "está"]}


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)


def texts(n=240, seed=5):
    rnd = np.random.RandomState(seed)
    names = sorted(SAMPLES)
    return [(i, " ".join(rnd.choice(SAMPLES[names[i % 3]], rnd.randint(1, 60))), names[i % 3]) for i in range(n)]


def test_held_out_accuracy_and_odd_rows(spark):
    odd = [(1000, None, "aa"), (1001, "", "aa"), (1002, " 12 ?! \n", "bb"), (1003, "the thing " * 20_000, "aa"), (1004, "THE THING AND SHORE", None), (None, "schön ünd groß ist", "bb"), (5, "ünd ist groß der", "bb"), (5, "ünd ist groß der", "bb")]
    rows = texts() + odd
    out = li.identify(spark, frame(spark, rows), epochs=1).collect()
    assert len(out) == len(rows)
    assert all(r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in out)
    assert all(0 <= r["score"] <= 1 for r in out)
    by = {r["doc_id"]: r for r in out}
    assert all((by[i]["lang_pred"], by[i]["score"]) == ("und", 0) for i in (1000, 1001, 1002))
    assert (by[1003]["lang_pred"], by[1004]["lang_pred"], by[None]["lang_pred"]) == ("aa", "aa", "bb")
    held = [i for i, _, _ in texts() if by[i]["held_out"]]
    assert len(held) > 30 and np.mean([by[i]["lang_pred"] == rows[i][2] for i in held]) >= 0.9


def test_labels_of_held_out_rows_are_not_learnt(spark):
    rows = texts(120)
    changed = [(i, t, "zz" if zlib.crc32(str(i).encode()) % 4 == 2 else x) for i, t, x in rows]
    told = [sorted((r["doc_id"], r["lang_pred"], round(r["score"], 6)) for r in li.identify(spark, frame(spark, x)).collect()) for x in (rows, changed)]
    assert told[0] == told[1]


def test_nothing_to_learn_from(spark):
    assert li.identify(spark, frame(spark, [])).collect() == []
    assert [(r["lang_pred"], r["score"]) for r in li.identify(spark, frame(spark, [(1, "text", None), (2, None, "aa")])).collect()] == [("und", 0)] * 2


def test_windows_cover_whole_texts():
    given = pa.array(["", None, "Ab1", "x" * li.WINDOW, "é" * 200, "Straße 5"])
    off, data = li.plain_bytes(given)
    start, end, text = li.cut_windows(off)
    w = li.fill_windows(data, start, end)
    for i, t in enumerate(given.to_pylist()):
        whole = bytes(b if 97 <= b <= 122 or b >= 128 else 32 for b in (t or "").lower().encode())
        assert b"".join(x[: li.WINDOW].tobytes() for x in w[text == i]).rstrip(b"\0") == whole
        own = w[text == i]
        assert all((a[li.WINDOW:] == b[: li._WIDE - 1]).all() for a, b in zip(own[:-1], own[1:]))


def test_network_matches_loops(monkeypatch):
    monkeypatch.setattr(li, "LEAST_STEPS", 3)
    rnd = np.random.RandomState(1)
    windows = rnd.randint(0, 256, (40, li.WINDOW + li._WIDE - 1)).astype(np.uint8)
    net = li.fit(windows, rnd.randint(0, 3, 40), ("a", "b", "c"), epochs=1)
    got = net.log_probabilities(windows[:3])
    for n in range(3):
        peak = []
        for f in range(len(li.WIDTHS) * li.FILTERS):
            width = li.WIDTHS[f // li.FILTERS]
            assert not net.filters[width * li.DIM:, f].any()
            y = [sum(net.byte[windows[n, p + j]] @ net.filters[j * li.DIM:(j + 1) * li.DIM, f] for j in range(width)) for p in range(li.WINDOW)]
            peak.append(max(0, max(y) + net.shift[f]))
        z = np.array(peak) @ net.out + net.bias
        assert np.allclose(got[n], z - np.log(np.exp(z).sum()), atol=1e-4)


@pytest.mark.skipif(not SF.exists(), reason="no tables")
def test_held_out_accuracy_of_the_query(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    rows = li.query(spark, str(SF)).filter("held_out").join(docs, "doc_id").collect()
    assert np.mean([r["lang_pred"] == r["lang"] for r in rows]) >= 0.9
