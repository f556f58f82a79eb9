"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

A text's features are the distinct hashes of its words, of longer words' beginnings, of
neighbouring pairs and of pairs one word apart, over the whole text.  One task makes passes over a bounded
sample of labelled rows with per-coordinate rates and L1 sparsity; what remains is a
few thousand weights, broadcast as one array of 2^``bits`` floats whatever the
corpus.

The sample takes all labelled ids up to ``max_rows`` (a documented bound), and beyond it
those of smallest hashed id, one row an id; in that order it ends with the row that
brings its texts to ``max_bytes`` (a documented bound too).  Everything is scored.

Defined results: a null or empty text has no features and gets the bias's score;
null labels are not learnt from; without usable labels every score is 0.5 less a
hair, so nothing is rejected; repeated rows are scored one by one, and of rows that
repeat an id the smallest text is learnt from; texts of any length are scored whole;
other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ._store import bound_batches
from ._text import NON_ALNUM, Words, mix, pieces, release, split_words, word_hashes

BITS = 20
MAX_ROWS = 16384
#: bytes of text that are learnt from; features take some five times as much memory
MAX_BYTES = 64 << 20
PASSES = 5
ALPHA, BETA, L1, L2 = 0.5, 1.0, 5.0, 0.1
#: bytes of text worked on at a time; features take some seventy times as much while they are made
STEP_BYTES = 1 << 19
#: bytes of the beginnings that longer words also count by: inflected forms share them
STEMS = (5, 6, 7, 8)
_SEEDS = tuple(np.uint64(s) for s in (0x51ED270B, 0x2545F491, 0x9E3779B1))


def features(words: Words, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """(document, bucket) of each occurrence of a word, its beginnings, a pair and a pair one word apart."""
    h, doc = words.hashes(), words.doc_of()
    out_doc, out = [doc], [mix(h ^ _SEEDS[0])]
    for gap in (1, 2):
        if len(h) > gap:
            inside = doc[:-gap] == doc[gap:]
            out_doc.append(doc[:-gap][inside])
            out.append(mix(h[:-gap] * np.uint64(0x9E3779B97F4A7C15) + h[gap:] + _SEEDS[gap])[inside])
    for n in STEMS:
        at = np.flatnonzero(words.ends - words.starts > n)
        out_doc.append(doc[at])
        out.append(word_hashes(words.buf, words.starts[at], words.starts[at] + n, seed=n))
    return np.concatenate(out_doc), (np.concatenate(out) >> np.uint64(64 - bits)).astype(np.int64)


class Ftrl:
    """Per-coordinate FTRL-proximal for logistic loss; the last coordinate is the bias, without L1."""

    def __init__(self, size: int, alpha: float = ALPHA, beta: float = BETA, l1: float = L1, l2: float = L2):
        self.z, self.n = np.zeros(size + 1), np.zeros(size + 1)
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2
        self.bias = size

    def weights(self, at: np.ndarray) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        l1 = np.where(at == self.bias, 0.0, self.l1)
        w = -(z - np.sign(z) * l1) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2)
        return np.where(np.abs(z) <= l1, 0.0, w)

    def learn(self, at: np.ndarray, label: int) -> None:
        w = self.weights(at)
        g = 1 / (1 + np.exp(-np.clip(w.sum(), -35, 35))) - label
        n = self.n[at]
        sigma = (np.sqrt(n + g * g) - np.sqrt(n)) / self.alpha
        self.z[at] += g - sigma * w
        self.n[at] = n + g * g


def train(spark: SparkSession, docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS, passes: int = PASSES, bits: int = BITS, max_bytes: int = MAX_BYTES) -> tuple[np.ndarray, float]:
    """Weights and bias from ``docs`` (id, text) and ``labels`` (id, label); learns in one task from a bounded sample."""

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, rows, marks, seen = Ftrl(1 << bits), [], [], 0
        for b in batches:
            for texts, labels in pieces(b.columns, 0, STEP_BYTES):
                if seen >= max_bytes:
                    break
                words = split_words(texts, NON_ALNUM, lower=True)
                doc, bucket = features(words, bits)
                key = np.unique((doc << bits) | bucket)
                cut = np.searchsorted(key >> bits, np.arange(len(words.counts) + 1))
                own = (key & ((1 << bits) - 1)).astype(np.int32)
                rows += np.split(own, cut[1:-1])
                marks += labels.to_pylist()
                seen += len(words.buf)
        release()
        shuffle = np.random.RandomState(7)
        for _ in range(passes):
            for r in shuffle.permutation(len(marks)):
                model.learn(np.append(rows[r], model.bias), marks[r])
        w = model.weights(np.arange(model.bias + 1))
        at = np.flatnonzero(w)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(w[at])], names=["at", "w"])
        del rows, model
        release()

    # max_rows pairs of numbers at most are broadcast, and only their texts move, one an id
    picked = labels.filter("label is not null").groupBy("id").agg(F.max("label").cast("int").alias("label")).orderBy(F.xxhash64("id"), "id").limit(max_rows)
    texts = docs.select("id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).join(F.broadcast(picked), "id")
    ordered = texts.groupBy("id", "label").agg(F.min("text").alias("text")).repartition(1).sortWithinPartitions(F.xxhash64("id"), "id")
    out = np.zeros((1 << bits) + 1)
    for r in ordered.select("text", "label").mapInArrow(fit, "at long, w double").collect():  # the nonzero weights
        out[r["at"]] = r["w"]
    return out[:-1].astype(np.float32), float(out[-1])


def _scores(texts: pa.Array, weights: np.ndarray, bias: float) -> np.ndarray:
    bits = len(weights).bit_length() - 1
    words = split_words(texts, NON_ALNUM, lower=True)
    doc, bucket = features(words, bits)
    used = weights[bucket] != 0
    key = np.unique((doc[used] << bits) | bucket[used])
    total = bias + np.bincount(key >> bits, weights[key & ((1 << bits) - 1)], len(words.counts))
    return 1 / (1 + np.exp(-np.clip(total, -35, 35)))


def score_texts(spark: SparkSession, docs: DataFrame, weights: np.ndarray, bias: float, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score) of every document."""
    model = spark.sparkContext.broadcast((weights, bias))  # 4 bytes a bucket

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for ids, texts in pieces(b.columns, 1, STEP_BYTES):
                yield pa.RecordBatch.from_arrays([ids, pa.array(_scores(texts, *model.value))], names=["doc_id", "score"])

    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(score, "doc_id long, score double")


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0


def learn(spark: SparkSession, docs: DataFrame, labels: DataFrame, **options) -> tuple[np.ndarray, float]:
    """Weights and bias from the labels that aren't held out."""
    bound_batches(spark)
    known = labels.filter("toxic is not null").groupBy(F.col("doc_id").alias("id")).agg(F.max("toxic").alias("label"))
    known = known.filter(~held_out(F.col("id")))
    weights, bias = train(spark, docs.select(F.col("doc_id").alias("id"), "text"), known, **options)
    return (weights, bias) if bias or weights.any() else (weights, -1e-6)


def score_documents(spark: SparkSession, docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """doc_id, held_out, score and predicted of every document; learns from labels that aren't held out."""
    scored = score_texts(spark, docs, *learn(spark, docs, labels, **options))
    return scored.select("doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))


def drop_toxic(spark: SparkSession, docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """Documents, all columns, without those predicted toxic; texts are not shuffled."""
    weights, bias = learn(spark, docs, labels, **options)
    model = spark.sparkContext.broadcast((weights, bias))
    text, names = docs.columns.index("text"), docs.columns

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for cols in pieces(b.columns, text, STEP_BYTES):
                good = pa.array(_scores(cols[text], *model.value) < 0.5)
                yield pa.RecordBatch.from_arrays([c.filter(good) for c in cols], names=names)
            release()

    return docs.mapInArrow(keep, docs.schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract rows over all documents."""
    return score_documents(spark, spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))


SQL = None
