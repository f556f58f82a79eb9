"""Language identification by a convolutional network over bytes.

A text is lower-cased, what is no letter becomes a space, and its bytes are cut into windows
of a fixed length that cover it whole; a window also sees the few bytes behind it, so that
no sequence is lost at a cut.  Each byte is a short vector; filters of several widths
slide over them, the largest response of each filter in a window counts, and a softmax
over these tells the language.  A text's prediction adds up the windows' log-probabilities
by their bytes.

The network is trained in numpy, in one task, from a bounded sample of labelled texts:
``per_language`` texts of each of the ``max_languages`` most frequent languages, those of
smallest hashed id, one text an id, and some windows of each.  Windows are cut short at
random, so that short texts are learnt too.  The network has a fixed size and is broadcast;
every text is then predicted whole.

Defined results: a null text, an empty one and one without a letter is ``und`` with score
0; rows without a language, and null ids, are not learnt from; of rows that repeat an id
the smallest text is learnt from; without rows to learn from every text is ``und``, an empty table
gives no rows; equal texts get equal predictions, ties go to the first language by
name; texts of any length are read window by window; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ._store import bound_batches
from ._text import offsets_and_data, pieces, release, utf8

WINDOW, DIM, WIDTHS, FILTERS = 96, 8, (2, 3, 4, 5), 12
PER_LANGUAGE, MAX_LANGUAGES = 2048, 256
#: windows of a text that are learnt from, and windows in all
PER_TEXT, MAX_WINDOWS = 8, 1 << 16
#: bytes of text that are learnt from
MAX_BYTES = 64 << 20
EPOCHS, BATCH, RATE = 6, 256, 4e-3
#: small tables are passed over until so many batches are learnt
LEAST_STEPS = 400
#: windows that are worked on at a time
STEP = 64
PIECE_BYTES = 1 << 20
UNKNOWN = "und"
_WIDE = max(WIDTHS)
#: ASCII that is no letter becomes a space
_PLAIN = np.array([b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256)], np.uint8)


@dataclass
class Network:
    """A vector a byte (none for the padding, byte 0), filters of all widths in one matrix, and the softmax over their peaks."""

    languages: tuple[str, ...]
    byte: np.ndarray  # 256 x DIM
    filters: np.ndarray  # _WIDE * DIM x all filters; narrow ones have zeros behind
    shift: np.ndarray
    out: np.ndarray  # all filters x languages
    bias: np.ndarray

    def peaks(self, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The largest response of each filter in each window, and where it is."""
        n = len(windows)
        x = self.byte[windows].reshape(n, -1)
        slid = np.lib.stride_tricks.sliding_window_view(x, _WIDE * DIM, axis=1)[:, ::DIM]
        y = np.ascontiguousarray(slid).reshape(-1, _WIDE * DIM) @ self.filters
        y = y.reshape(n, -1, y.shape[1])
        return np.maximum(y.max(axis=1) + self.shift, 0), y

    def log_probabilities(self, windows: np.ndarray) -> np.ndarray:
        z = self.peaks(windows)[0] @ self.out + self.bias
        z -= z.max(axis=1, keepdims=True)
        return z - np.log(np.exp(z).sum(axis=1, keepdims=True))


def plain_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and bytes of the texts in lower case, anything in ASCII but letters as spaces."""
    off, data = offsets_and_data(utf8(pc.utf8_lower(texts)))
    return off, _PLAIN[data]


def cut_windows(off: np.ndarray, length: int = WINDOW) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each window of each text: where it begins, where its text ends, and the text's number."""
    n = -(-np.diff(off) // length)
    text = np.repeat(np.arange(len(n)), n)
    k = np.arange(len(text)) - np.repeat(np.cumsum(n) - n, n)
    return off[:-1][text] + k * length, off[1:][text], text


def fill_windows(data: np.ndarray, start: np.ndarray, end: np.ndarray, length: int = WINDOW) -> np.ndarray:
    """Windows with the bytes behind them that filters reach; what lies beyond the text is 0."""
    at = start[:, None] + np.arange(length + _WIDE - 1)
    inside = at < end[:, None]
    return np.where(inside, data[np.where(inside, at, 0)], 0) if len(data) else np.zeros(at.shape, np.uint8)


def fit(windows: np.ndarray, labels: np.ndarray, languages: tuple[str, ...], epochs: int = EPOCHS, seed: int = 7) -> Network:
    """A network trained by Adam on cross-entropy; only the place of a filter's peak takes its gradient."""
    rnd = np.random.RandomState(seed)
    n_all, k = len(WIDTHS) * FILTERS, len(languages)
    open_ = np.zeros((_WIDE * DIM, n_all), np.float32)
    for i, w in enumerate(WIDTHS):
        open_[: w * DIM, i * FILTERS:(i + 1) * FILTERS] = 1
    normal = lambda *shape, scale: rnd.normal(0, scale, shape).astype(np.float32)
    net = Network(languages, normal(256, DIM, scale=0.5), normal(_WIDE * DIM, n_all, scale=0.2) * open_, np.zeros(n_all, np.float32), normal(n_all, k, scale=0.2), np.zeros(k, np.float32))
    net.byte[0] = 0
    params = [net.byte, net.filters, net.shift, net.out, net.bias]
    first, second, t = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
    each = -(-len(labels) // BATCH)
    epochs = max(epochs, -(-LEAST_STEPS // each))
    total = epochs * each
    for _ in range(epochs):
        for at in np.array_split(rnd.permutation(len(labels)), each):
            x, y = windows[at].copy(), labels[at]
            short = np.flatnonzero(rnd.rand(len(at)) < 0.4)  # texts may be a word long
            x[short[:, None], np.arange(x.shape[1])] *= np.arange(x.shape[1]) < rnd.randint(4, WINDOW, len(short))[:, None]
            peak, y_all = net.peaks(x)
            where = y_all.argmax(axis=1)  # window x filter
            z = peak @ net.out + net.bias
            p = np.exp(z - z.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(at)), y] -= 1
            p /= len(at)
            d = (p @ net.out.T) * (peak > 0)
            seen = x[np.arange(len(at))[:, None, None], where[:, :, None] + np.arange(_WIDE)]  # bytes under each peak
            under = net.byte[seen].reshape(len(at), n_all, -1)
            grad_filters = np.einsum("bf,bfk->kf", d, under, optimize=True) * open_
            back = (d[:, :, None] * net.filters.T).reshape(-1, DIM)
            seen = seen.reshape(-1)
            grad_byte = np.stack([np.bincount(seen, back[:, c], 256) for c in range(DIM)], axis=1).astype(np.float32)
            grad_byte[0] = 0
            t += 1
            rate = RATE * min(1, 2 * (1 - (t - 1) / total))
            for q, g, m, v in zip(params, [grad_byte, grad_filters, d.sum(axis=0), peak.T @ p, p.sum(axis=0)], first, second):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                q -= (rate / (1 - 0.9**t)) * m / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return net


def train(spark: SparkSession, rows: DataFrame, per_language: int = PER_LANGUAGE, max_languages: int = MAX_LANGUAGES, max_windows: int = MAX_WINDOWS, max_bytes: int = MAX_BYTES, epochs: int = EPOCHS) -> Network | None:
    """A network from ``rows`` (id, text, lang), learnt in one task from a bounded sample."""
    bound_batches(spark)
    rows = rows.select("id", F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang")).filter("id is not null and text is not null and lang is not null")
    known = rows.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(max_languages).collect()  # max_languages rows at most
    languages = tuple(sorted(r["lang"] for r in known))
    if not languages:
        return None
    hashed = F.xxhash64("id")
    ids = rows.filter(F.col("lang").isin(*languages)).groupBy("id").agg(F.min("lang").alias("lang"))
    ids = ids.withColumn("place", F.row_number().over(Window.partitionBy("lang").orderBy(hashed, "id"))).filter(F.col("place") <= per_language)
    picked = rows.join(F.broadcast(ids.select("id", "lang")), ["id", "lang"]).groupBy("id", "lang").agg(F.min("text").alias("text"))  # languages x per_language ids
    ordered = picked.repartition(1).sortWithinPartitions(hashed, "id").select("text", "lang")

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rnd = np.random.RandomState(3)
        number = {x: i for i, x in enumerate(languages)}
        windows, labels, seen = [], [], 0
        for b in batches:
            for texts, langs in pieces(b.columns, 0, PIECE_BYTES):
                if seen >= max_bytes:
                    break
                off, data = plain_bytes(texts)
                start, end, text = cut_windows(off)
                order = rnd.permutation(len(text))
                order = order[np.argsort(text[order], kind="stable")]  # windows of a text in random order
                at = order[np.arange(len(order)) - np.searchsorted(text[order], text[order]) < PER_TEXT]
                windows.append(fill_windows(data, start[at], end[at]))
                labels.append(np.array([number[x] for x in langs.to_pylist()], np.int64)[text[at]])
                seen += len(data)
        windows, labels = np.concatenate(windows), np.concatenate(labels)
        at = rnd.permutation(len(labels))[:max_windows]
        net = fit(windows[at], labels[at], languages, epochs) if len(at) else None
        flat = np.concatenate([x.reshape(-1) for x in (net.byte, net.filters, net.shift, net.out, net.bias)]) if net else np.zeros(0)
        yield pa.RecordBatch.from_arrays([pa.array([flat.astype(np.float64)], pa.list_(pa.float64()))], names=["weights"])
        del windows, labels
        release()

    got = ordered.mapInArrow(learn, "weights array<double>").collect()  # one row: the network
    if not got or not got[0][0]:
        return None
    n, k = len(WIDTHS) * FILTERS, len(languages)
    shapes = [(256, DIM), (_WIDE * DIM, n), (n,), (n, k), (k,)]
    parts = np.split(np.array(got[0][0], np.float32), np.cumsum([np.prod(s) for s in shapes])[:-1])
    return Network(languages, *(p.reshape(s) for p, s in zip(parts, shapes)))


def _predict(texts: pa.Array, net: Network) -> tuple[pa.Array, pa.Array]:
    off, data = plain_bytes(texts)
    start, end, text = cut_windows(off)
    total = np.zeros((len(texts), len(net.languages)))
    for p in range(0, len(text), STEP):
        s, e, at = start[p:p + STEP], end[p:p + STEP], text[p:p + STEP]
        weight = np.minimum(e - s, WINDOW)
        np.add.at(total, at, net.log_probabilities(fill_windows(data, s, e)) * weight[:, None])
    x = total / np.maximum(np.diff(off), 1)[:, None]
    p = np.exp(x - x.max(axis=1, keepdims=True))
    p /= p.sum(axis=1, keepdims=True)
    best = p.argmax(axis=1)
    some = pc.fill_null(pc.match_substring_regex(texts, r"\pL"), False)
    names = pa.array(net.languages, pa.string()).take(pa.array(best))
    return pc.if_else(some, names, UNKNOWN), pc.if_else(some, pa.array(p[np.arange(len(best)), best]), 0.0)


def predict(spark: SparkSession, docs: DataFrame, net: Network | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score) of every text."""
    bound_batches(spark)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    if net is None:
        return rows.select("doc_id", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    shared = spark.sparkContext.broadcast(net)  # some 20 KB, and 200 bytes a language

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for ids, texts in pieces(b.columns, 1, PIECE_BYTES):
                names, score = _predict(texts, shared.value)
                yield pa.RecordBatch.from_arrays([ids, names, score], names=["doc_id", "lang_pred", "score"])

    return rows.mapInArrow(each, "doc_id long, lang_pred string, score double")


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2


def identify(spark: SparkSession, docs: DataFrame, **options) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every document; learns from those that aren't held out."""
    known = docs.filter(~held_out(F.col("doc_id"))).select(F.col("doc_id").alias("id"), "text", "lang")
    told = predict(spark, docs, train(spark, known, **options))
    return told.select("doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "lang_pred", "score")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract rows over all documents."""
    return identify(spark, spark.read.parquet(f"{sf_dir}/documents.parquet"))


SQL = None
