"""Mixing sources to target weights, with soft membership.

A classifier learns from the texts of a labelled table, one logistic model a domain over
hashed words and beginnings of words, in one task from at most ``max_rows`` ids and
``max_bytes`` of text (documented bounds).  Texts are halved by a hash of their words, a
model learns from each half, and a text is scored by the model of the other: no
document, labelled or not, meets a model that has learnt its words.  A scale and a bias a
domain, fitted by tokens on the labelled rows (``MAX_KEPT`` at most), turn margins into
posteriors whose expected token shares there are those of the labels.

Rates r, one a document, minimise by projected gradient

    (x(r) - t)' H^-1 (x(r) - t) / 2  +  weight / 2 * sum of n (r - 1)^2

over r >= ``least``, where x(r) = sum of n r p are the domains' expected tokens, t their
targets, n a document's share of the tokens, p its posterior and H = sum of n p p'.  The
gradient of a document is p' H^-1 (x - t) + weight * (r - 1); it is scaled by the second
moments of the documents that aren't held at ``least``, and an iteration is one aggregate
that tries several lengths.  A document's rate follows from its posterior and the
few vectors of the iterations so far, which are replayed: no state is kept, and a
lost executor costs a recomputation of its rows only.  ``weight`` is small, so that targets are met
where they can be; where rates so uneven would leave an effective sample of less than
``effective`` of the documents, (sum of r)^2 / sum of r^2, the weight grows until they don't,
and the targets are missed by as much as it takes.  What is reached, the effective sample and
the weight are part of the mixture; a miss is logged, or raised with ``on_miss="raise"``.

Tokens are words between white space.  Rates act as copies: the whole part, and one
more with the fraction's probability by a hash of the id.

Defined results: null and empty texts have no tokens and take the posterior of the bias;
null labels, and labels of unknown documents, are not learnt from; an id labelled
twice takes the smaller domain name, and of rows that repeat an id the smallest text is learnt
from; domains without labelled rows are left out and the other targets
share their weight; without any labelled row, or for an empty table, all rates are
one.  Repeated rows are treated alike, but rows that repeat an id draw the same fraction;
texts of any length are read whole; other columns pass through, whatever their names.
"""

from __future__ import annotations

import logging
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F

from ._store import Workspace
from ._text import NON_ALNUM, Words, mix, pieces, release, split_words, word_hashes
from .toxicity import STEP_BYTES, Ftrl

BITS = 18
#: labelled ids and bytes of text that are learnt from, and rows that calibrate
MAX_ROWS, MAX_BYTES, MAX_KEPT = 4096, 32 << 20, 1 << 14
PASSES, L1 = 3, 3.0
#: bytes of the beginnings that longer words also count by
STEMS = (5, 7)
#: margins level off here; long texts add up more of them
STEEP = 10.0
#: gap of a domain as a part of its target (of a hundredth of the tokens at least)
TOLERANCE = 1e-3
#: lengths tried of a step
LENGTHS = 0.5 ** np.arange(12)
WEIGHT, HEAVIER, MOST_WEIGHT = 1e-4, 8.0, 1e3
STEPS = 40
COPY_BYTES = 8 << 20

_log = logging.getLogger(__name__)


class TargetsMissed(RuntimeError):
    """No rates within the bounds bring the domains to their targets."""


@dataclass(frozen=True)
class Mixture:
    """Everything that a document's rate depends on but its text; of fixed size."""

    domains: tuple[str, ...]
    weights: np.ndarray | None  # half x domain x bucket; of a half that the other's texts are learnt in
    bias: np.ndarray  # half x domain
    scale: np.ndarray  # of margins, a domain
    shift: np.ndarray
    steps: tuple[tuple[np.ndarray, float], ...] = ()  # a vector over domains and a length each
    weight: float = WEIGHT
    part: np.ndarray | None = None  # shares that posteriors are taken less, where the total is free
    least: float = 0.0
    wanted: tuple[float, ...] = ()  # expected shares of tokens
    reached: tuple[float, ...] = ()
    converged: bool = False
    effective: float = 1.0  # sample, as a share of the documents
    labelled: tuple[float, ...] = ()  # shares of tokens by label in the rows that calibrate
    expected: tuple[float, ...] = ()  # and by posterior

    def margins(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Token counts and each domain's margin, in small steps: features take much more memory than text."""
        n, out = [np.zeros(0, np.int64)], [np.zeros((0, len(self.domains)))]
        for (part,) in pieces([texts], 0, STEP_BYTES):
            words = split_words(part, NON_ALNUM, lower=True)
            doc, bucket = features(words)
            half = halves(words, bucket)
            used = (self.weights[:, :, bucket] != 0).any(axis=(0, 1))
            key = np.unique((doc[used] << BITS) | bucket[used])
            at, column = key >> BITS, key & ((1 << BITS) - 1)
            s = np.stack([np.bincount(at, w[half[at], column], len(words.counts)) for w in self.weights.transpose(1, 0, 2)], axis=1) + self.bias[half]
            n.append(split_words(part).counts)
            out.append(STEEP * np.tanh(s / STEEP))
        return np.concatenate(n), np.concatenate(out)

    def posteriors(self, margins: np.ndarray) -> np.ndarray:
        return _softmax(margins * self.scale + self.shift)

    def rates(self, p: np.ndarray) -> np.ndarray:
        """Replay of the iterations."""
        r, q = np.full(len(p), max(1.0, self.least)), p if self.part is None else p - self.part
        for g, length in self.steps:
            r = np.maximum(r - length * (q @ g + self.weight * (r - 1)), self.least)
        return r


def _softmax(z: np.ndarray) -> np.ndarray:
    x = np.exp(z - z.max(axis=1, keepdims=True))
    return x / x.sum(axis=1, keepdims=True)


def features(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """(document, bucket) of each word, then of beginnings of longer ones."""
    doc, hashes = [words.doc_of()], [mix(words.hashes())]
    for n in STEMS:
        at = np.flatnonzero(words.ends - words.starts > n)
        doc.append(doc[0][at])
        hashes.append(word_hashes(words.buf, words.starts[at], words.starts[at] + n, seed=n))
    return np.concatenate(doc), (np.concatenate(hashes) >> np.uint64(64 - BITS)).astype(np.int64)


def halves(words: Words, bucket: np.ndarray) -> np.ndarray:
    """0 or 1 for each text by its words, of which ``bucket`` begins with one each; copies stay together."""
    total = np.bincount(words.doc_of(), bucket[: len(words.starts)], len(words.counts))
    return (mix(total.astype(np.uint64)) & np.uint64(1)).astype(np.int64)


def learn_domains(spark: SparkSession, docs: DataFrame, labelled: DataFrame, domains: list[str], max_rows: int = MAX_ROWS, max_bytes: int = MAX_BYTES) -> Mixture | None:
    """Weights over the documents that ``labelled`` (doc_id, domain) names, max_rows at most; each half is scored by what the other teaches."""
    known = labelled.filter(F.col("domain").isin(*domains)).groupBy("doc_id").agg(F.min("domain").alias("domain")).filter("doc_id is not null")
    # max_rows ids at most are broadcast, and only their texts move
    picked = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    rows = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).join(F.broadcast(picked), "doc_id")
    rows = rows.groupBy("doc_id", "domain").agg(F.min("text").alias("text"))
    ordered = rows.repartition(1).sortWithinPartitions(F.xxhash64("doc_id"), "doc_id")
    number = {d: i for i, d in enumerate(domains)}

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, marks, half, seen = [], [], [], 0
        for b in batches:
            for texts, names in pieces(b.columns, 0, STEP_BYTES):
                if seen >= max_bytes:
                    break
                words = split_words(texts, NON_ALNUM, lower=True)
                doc, bucket = features(words)
                half += halves(words, bucket).tolist()
                key = np.unique((doc << BITS) | bucket)
                found += np.split((key & ((1 << BITS) - 1)).astype(np.int32), np.searchsorted(key >> BITS, np.arange(1, len(words.counts))))
                marks += [number[x] for x in names.to_pylist()]
                seen += len(words.buf)
        release()
        marks, half = np.array(marks, np.int64), np.array(half, np.int64)
        shuffle = np.random.RandomState(7)
        for side in (0, 1):
            rows = np.flatnonzero(half != side)
            for d in range(len(domains)):
                model = Ftrl(1 << BITS, l1=L1)
                for _ in range(PASSES):
                    for r in shuffle.permutation(rows):
                        model.learn(np.append(found[r], model.bias), int(marks[r] == d))
                w = model.weights(np.arange(model.bias + 1))
                at = np.append(np.flatnonzero(w[:-1]), model.bias)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), x)) for x in (side, d)] + [pa.array(at), pa.array(w[at]), pa.array(np.full(len(at), int((marks == d).sum())))], names=["half", "d", "at", "w", "n"])
        del found
        release()

    got = ordered.select("text", "domain").mapInArrow(fit, "half long, d long, at long, w double, n long").toArrow()  # the nonzero weights
    half, d, at, w, n = (got[c].to_numpy() for c in ("half", "d", "at", "w", "n"))
    seen = [i for i in range(len(domains)) if (n[d == i] > 0).any()]
    if not seen:
        return None
    weights = np.zeros((2, len(domains), (1 << BITS) + 1), np.float32)
    weights[half, d, at] = w
    ones = np.ones(len(seen))
    return Mixture(tuple(domains[i] for i in seen), np.ascontiguousarray(weights[:, seen, :-1]), weights[:, seen, -1].astype(float), ones, 0 * ones)


@dataclass(frozen=True)
class Fitted:
    model: Mixture | None
    scored: DataFrame | None  # doc_id, n_tokens and margins of every document, written


def fit_rates(spark: SparkSession, docs: DataFrame, labelled: DataFrame, targets: dict[str, float], least: float = 0.0, total: float | None = None, **options) -> Mixture | None:
    """The mixture of :func:`fit`, without the table."""
    return fit(spark, docs, labelled, targets, least, total, **options).model


def fit(
    spark: SparkSession, docs: DataFrame, labelled: DataFrame, targets: dict[str, float], least: float = 0.0, total: float | None = None,
    effective: float = 0.0, weight: float = WEIGHT, on_miss: str = "log",
) -> Fitted:
    """A mixture whose rates bring the domains' expected tokens to shares ``targets`` of ``total``.

    Without ``total`` it is the present total, or with a positive ``least`` whatever the
    shares need: rates have no upper bound, and the total is that of the rates nearest to one.
    """
    model = learn_domains(spark, docs, labelled, sorted(targets))
    if model is None:
        return Fitted(None, None)
    ws = Workspace(spark, "mixing")
    k = len(model.domains)
    shared = spark.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for ids, texts in pieces(b.columns, 1):
                n, s = shared.value.margins(texts)
                yield pa.RecordBatch.from_arrays([ids, pa.array(n), _lists(s)], names=["doc_id", "n_tokens", "margins"])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    scored = ws.put(texts.mapInArrow(score, "doc_id long, n_tokens long, margins array<double>"), "scored")
    model = _calibrated(scored, labelled, model)
    share = np.array([targets[d] for d in model.domains], float)
    share /= share.sum()
    free = total is None and least > 0
    while True:
        model, all_tokens = _descend(scored, _with(model, steps=(), least=least, weight=weight, part=share if free else None), share, free, total)
        if not all_tokens or model.effective >= effective or weight >= MOST_WEIGHT:
            break
        weight *= HEAVIER
    if all_tokens and not model.converged:
        text = f"mixing misses its targets: wanted {_told(model, share)}, reached {_told(model, model.reached)} with an effective sample of {model.effective:.2f} of the documents"
        if on_miss == "raise":
            raise TargetsMissed(text)
        _log.warning(text)
    return Fitted(model, scored)


def _descend(scored: DataFrame, model: Mixture, share: np.ndarray, free: bool, total: float | None) -> tuple[Mixture, float]:
    """Projected gradient over all documents; the model with its iterations, and the tokens of the table."""
    k, spark = len(share), scored.sparkSession

    def sums(g: np.ndarray, lengths: np.ndarray) -> list[np.ndarray]:
        """For each length of a further step g: x, its H over documents that aren't held, sum of n (r - 1)^2, of n r, of r, of r^2, and the counts."""
        m, now = len(lengths), spark.sparkContext.broadcast((_with(model, weights=None), g, lengths))  # a few vectors

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            at, g, lengths = now.value
            x, square, rest = np.zeros((m, k)), np.zeros((m, k, k)), np.zeros((m, 6))
            for b in batches:
                p = at.posteriors(_matrix(b["margins"], k))
                n, q, r0 = b["n_tokens"].to_numpy().astype(float), p if at.part is None else p - at.part, at.rates(p)
                down = q @ g + at.weight * (r0 - 1)
                for i, length in enumerate(lengths):
                    r = np.maximum(r0 - length * down, at.least)
                    x[i] += (n * r) @ p
                    held = (r <= at.least) & (r0 - length * down < at.least)
                    square[i] += (q * (n * ~held)[:, None]).T @ q
                    rest[i] += [n @ (r - 1) ** 2, n @ r, r.sum(), r @ r, n.sum(), len(n)]
            flat = np.concatenate([x.reshape(-1), square.reshape(-1), rest.reshape(-1)])
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(flat))), pa.array(flat)], names=["at", "x"])

        got = {r["at"]: r["x"] for r in scored.select("n_tokens", "margins").mapInArrow(add, "at long, x double").groupBy("at").agg(F.sum("x").alias("x")).collect()}
        flat = np.array([got.get(i, 0.0) for i in range(m * (k + k * k + 6))])
        x, square, rest = np.split(flat, [m * k, m * (k + k * k)])
        return [x.reshape(m, k), square.reshape(m, k, k), rest.reshape(m, 6)]

    x, square, rest = sums(np.zeros(k), np.zeros(1))
    tokens = rest[0, 4]
    if tokens <= 0:
        return model, 0.0
    goal = share * (1 if total is None else total / tokens)
    inverse = lambda h: np.linalg.pinv(h / tokens, rcond=1e-9, hermitian=True)
    metric = inverse(square[0])
    gap = lambda x: x / tokens - (goal if not free else share * x.sum() / tokens)
    lowest, at = np.inf, 0
    for _ in range(STEPS):
        values = [0.5 * gap(x[i]) @ metric @ gap(x[i]) + 0.5 * model.weight * rest[i, 0] / tokens for i in range(len(x))]
        best = int(np.argmin(values))
        if len(x) > 1:
            if not values[best] < lowest * (1 - 1e-9):
                break
            model = _with(model, steps=(*model.steps, (g, float(LENGTHS[best]))))
        lowest, at = values[best], best
        kept = (x[at], square[at], rest[at])
        g = inverse(kept[1]) @ gap(kept[0])
        x, square, rest = sums(g, LENGTHS)
    x, _, rest = kept
    reached = x / max(x.sum(), 1e-300)
    whole = x.sum() / tokens if free else goal.sum()
    met = (np.abs(x / tokens - share * whole) <= TOLERANCE * whole * np.maximum(share, 0.01)).all()
    effective = rest[2] ** 2 / max(rest[3] * rest[5], 1e-300)
    return _with(model, wanted=tuple(share.tolist()), reached=tuple(reached.tolist()), converged=bool(met), effective=float(effective)), tokens


def _told(model: Mixture, shares: np.ndarray) -> str:
    return ", ".join(f"{d} {x:.4f}" for d, x in zip(model.domains, shares))


def _with(model: Mixture, **changes) -> Mixture:
    return Mixture(**(model.__dict__ | changes))


def _lists(x: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.arange(0, x.size + 1, x.shape[1]), pa.int32()), pa.array(x.reshape(-1)))


def _matrix(lists: pa.Array, k: int) -> np.ndarray:
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(-1, k)


def _calibrated(scored: DataFrame, labelled: DataFrame, model: Mixture) -> Mixture:
    """The model with a scale and a bias a domain; shares of tokens by label and by posterior of the rows they were fitted on."""
    k = len(model.domains)
    known = labelled.filter(F.col("domain").isin(*model.domains)).groupBy("doc_id").agg(F.min("domain").alias("domain"))
    judged = scored.join(known, "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id", "n_tokens", "margins").limit(MAX_KEPT)
    got = judged.select("domain", "n_tokens", "margins").toArrow()  # MAX_KEPT rows at most
    own = np.array([model.domains.index(d) for d in got["domain"].to_pylist()], np.int64)
    n = got["n_tokens"].to_numpy().astype(float)
    if not n.sum():
        return model
    s = np.array(got["margins"].to_pylist(), float).reshape(-1, k)
    scale, shift = calibrate(s, own, n / n.mean(), k)
    model = _with(model, scale=scale, shift=shift)
    shares = lambda x: tuple((x / x.sum()).tolist())
    model = _with(model, labelled=shares(np.bincount(own, n, k)), expected=shares(n @ model.posteriors(s)))
    _log.info("mixing: tokens by label %s, by posterior %s", _told(model, model.labelled), _told(model, model.expected))
    return model


def calibrate(s: np.ndarray, own: np.ndarray, n: np.ndarray, k: int, ridge: float = 1.0) -> tuple[np.ndarray, np.ndarray]:
    """Scale and bias of each class by weighted softmax regression, Newton's steps; free biases make expected weights those of the labels."""
    scale, shift = np.full(k, 0.3), np.zeros(k)
    y = np.eye(k)[own]

    def loss(a: np.ndarray, b: np.ndarray) -> float:
        z = s * a + b
        top = z.max(axis=1)
        return n @ (top + np.log(np.exp(z - top[:, None]).sum(axis=1)) - z[np.arange(len(own)), own]) + ridge / 2 * ((a - 0.3) ** 2).sum()

    for _ in range(100):
        p = _softmax(s * scale + shift)
        d = n[:, None] * (p - y)
        grad = np.concatenate([(d * s).sum(axis=0) + ridge * (scale - 0.3), d.sum(axis=0)])
        if np.abs(grad).max() < 1e-9 * n.sum():
            break
        w = n[:, None, None] * (p[:, :, None] * np.eye(k) - p[:, :, None] * p[:, None, :])
        aa = np.einsum("nde,nd,ne->de", w, s, s) + ridge * np.eye(k)
        ab, bb = np.einsum("nde,nd->de", w, s), w.sum(axis=0) + 1e-9 * n.sum() * np.eye(k)
        step = np.linalg.solve(np.block([[aa, ab], [ab.T, bb]]), grad)
        now = loss(scale, shift)
        for length in 0.5 ** np.arange(30):
            a, b = scale - length * step[:k], shift - length * step[k:]
            if loss(a, b) < now:
                break
        else:
            break
        scale, shift = a, b
    return scale, shift - shift.mean()


def n_copies(rates: np.ndarray, ids: pa.Array, seed: int = 11) -> np.ndarray:
    """Whole copies, and one more with the fraction's probability, by a hash of the id."""
    number = ids.cast(pa.int64()).fill_null(-1).to_numpy(zero_copy_only=False).view(np.uint64)
    u = (mix(number * np.uint64(2 * seed + 1) + np.uint64(seed)) >> np.uint64(11)).astype(float) / float(1 << 53)
    return np.floor(rates).astype(np.int64) + (u < rates - np.floor(rates))


RATES = "doc_id long, n_tokens long, rate double, posterior array<double>, copies long"


def _rated(ids: pa.Array, n, margins: np.ndarray, model: Mixture, seed: int) -> pa.RecordBatch:
    p = model.posteriors(margins)
    rates = model.rates(p)
    return pa.RecordBatch.from_arrays([ids, pa.array(n), pa.array(rates), _lists(p), pa.array(n_copies(rates, ids, seed))], names=["doc_id", "n_tokens", "rate", "posterior", "copies"])


def fitted_rates(fitted: Fitted, seed: int = 11) -> DataFrame:
    """What :func:`document_rates` returns, for the documents of the fit; no text is read again."""
    shared = fitted.scored.sparkSession.sparkContext.broadcast(_with(fitted.model, weights=None))

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield _rated(b["doc_id"], b["n_tokens"], _matrix(b["margins"], len(shared.value.domains)), shared.value, seed)

    return fitted.scored.mapInArrow(rate, RATES)


def document_rates(spark: SparkSession, docs: DataFrame, model: Mixture | None, seed: int = 11) -> DataFrame:
    """doc_id, n_tokens, rate, posterior (in the order of the model's domains) and the copies that :func:`resample` makes."""
    if model is None:
        n = F.size(F.filter(F.split(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != ""))
        return docs.select(F.col("doc_id").cast("long").alias("doc_id"), n.cast("long").alias("n_tokens"), F.lit(1.0).alias("rate"), F.array().cast("array<double>").alias("posterior"), F.lit(1).cast("long").alias("copies"))
    shared = spark.sparkContext.broadcast(model)

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for ids, texts in pieces(b.columns, 1):
                yield _rated(ids, *shared.value.margins(texts), shared.value, seed)

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(rate, RATES)


def resample(spark: SparkSession, docs: DataFrame, model: Mixture | None, seed: int = 11) -> DataFrame:
    """Documents, all columns, each as often as its rate says; texts are not shuffled."""
    if model is None:
        return docs
    shared = spark.sparkContext.broadcast(model)
    names = docs.columns
    text, doc_id = names.index("text"), names.index("doc_id")

    def repeat(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for cols in pieces(b.columns, text):
                _, s = shared.value.margins(cols[text])
                rate = shared.value.rates(shared.value.posteriors(s))
                n = n_copies(rate, cols[doc_id], seed)
                # rates have no bound, so copies go out in batches of bounded text
                at = np.repeat(np.arange(len(n)), n)
                size = pc.binary_length(cols[text].cast(pa.binary())).fill_null(0).to_numpy(zero_copy_only=False)[at] + 64
                for part in np.split(at, np.flatnonzero(np.diff(np.cumsum(size) // COPY_BYTES)) + 1):
                    yield pa.RecordBatch.from_arrays([c.take(pa.array(part)) for c in cols], names=names)
            release()

    return docs.mapInArrow(repeat, docs.schema)


#: shares of tokens by domain; domains follow from the labels
TARGETS = {"high": 0.85, "low": 0.13, "toxic": 0.02}
#: share of the documents that the effective sample of the query is at least
EFFECTIVE = 0.5


def quality_domains(labels: DataFrame) -> DataFrame:
    domain = F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 1, "high").when(F.col("quality") == 0, "low")
    return labels.select("doc_id", domain.alias("domain")).filter("domain is not null")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rate, copies and domain posterior of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    fitted = fit(spark, docs, quality_domains(spark.read.parquet(f"{sf_dir}/labels.parquet")), TARGETS, effective=EFFECTIVE)
    return document_rates(spark, docs, None) if fitted.model is None else fitted_rates(fitted)


SQL = None
