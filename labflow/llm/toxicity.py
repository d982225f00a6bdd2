"""Toxicity: a convolutional text classifier trained in numpy.

A word's vector is the sum of hashed embeddings of the word and of its first 4, 5 and 6 bytes, so inflected and compound
forms share a vector with their stem.  Filters one, two and three words wide run over the whole text; each filter's
maximum over the text, from its first to its last word, goes to a logistic layer; zero rows between texts keep them apart.
Training uses a bounded sample of labelled rows: in hash order of the id, at most ``SAMPLE_ROWS`` of them, up to the first
whose text would bring the sample above ``SAMPLE_BYTES``; a text that is longer than that alone takes no part.  A fifth of it is left out of training to calibrate
the score (Platt scaling) and to choose a threshold for each language.  Scoring runs over whole texts, in batches.

Defined cases: a null or empty text is scored as a text without words; words unseen in training add nothing; a language
without enough positive rows takes the common threshold; without usable labels every score is the prior; repeated
labels count as often as they are given, and null labels are left out.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textblocks as tb
from .decontaminate import BREAKS

SAMPLE_ROWS, SAMPLE_BYTES = 8_000, 32 << 20
TABLE = 1 << 22
DIM, FILTERS, WIDTHS = 12, 12, (1, 2, 3)
PAD = max(WIDTHS)
#: A feature has an embedding if so many training texts hold it.
MIN_TEXTS = 3
SCORE_BYTES = 1 << 20
RIDGE = 1e-4


def featurise(batch: tb.Batch) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of each word's four features (n, 4), and ``first`` by document."""
    data = tb.lower_ascii(batch.data)
    starts, ends, first = tb.words(tb.Batch(data, batch.offsets), BREAKS)
    out = np.empty((len(starts), 4), np.int32)
    for k, width in enumerate((None, 4, 5, 6)):
        stop = ends if width is None else np.minimum(ends, starts + width)
        hashes = tb.word_hashes(data, starts, stop)
        out[:, k] = (tb.mix(hashes + np.uint64(k + 1)) % np.uint64(TABLE)).astype(np.int32)
        if width is not None:
            out[ends - starts < width, k] = -1
    return out, first


@dataclass
class Model:
    known: np.ndarray  # sorted buckets that have an embedding
    table: np.ndarray  # their vectors; the last row is zero
    filters: list[np.ndarray]
    bias: list[np.ndarray]
    out: np.ndarray
    base: float
    slope: float = 1.0
    shift: float = 0.0
    thresholds: dict[str, float] | None = None
    common: float = 0.5

    def rows(self, buckets: np.ndarray) -> np.ndarray:
        if not len(self.known):
            return np.zeros(buckets.shape, np.int32)
        at = np.minimum(np.searchsorted(self.known, buckets), len(self.known) - 1)
        return np.where(self.known[at] == buckets, at, len(self.known)).astype(np.int32)

    def lay(self, rows: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Word vectors with ``PAD`` zero rows after each text, and the places where windows begin in each text: start, stop.

        A window that begins at a text's last word ends in its zero rows; a text without words has one window of zero rows.
        """
        n = len(first) - 1
        start = first[:-1] + PAD * np.arange(n)
        x = np.zeros((int(first[-1]) + PAD * n + 1, DIM), np.float32)
        if len(rows):
            put = np.arange(len(rows)) + PAD * np.repeat(np.arange(n), np.diff(first))
            x[put] = self.table[rows[:, 0]] + self.table[rows[:, 1]] + self.table[rows[:, 2]] + self.table[rows[:, 3]]
        return x, start, start + np.maximum(np.diff(first), 1)

    def maps(self, x: np.ndarray) -> list[np.ndarray]:
        """Each width's filters at each place."""
        n = len(x) - max(WIDTHS) + 1
        return [sum(x[i : n + i] @ w[i] for i in range(width)) + b for width, w, b in zip(WIDTHS, self.filters, self.bias, strict=True)]

    def pooled(self, x: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        ends = np.stack([start, stop], axis=1).ravel()
        return np.maximum(np.concatenate([np.maximum.reduceat(y, ends, axis=0)[::2] for y in self.maps(x)], axis=1), 0)

    def logits(self, batch: tb.Batch) -> np.ndarray:
        if not len(batch):
            return np.zeros(0)
        buckets, first = featurise(batch)
        return self.pooled(*self.lay(self.rows(buckets), first)) @ self.out + self.base

    def score(self, batch: tb.Batch) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * self.logits(batch) + self.shift, -30, 30)))


def fit(texts: list[str], labels: np.ndarray, langs: list[str | None], seed: int = 5) -> Model:
    rng = np.random.default_rng(seed)
    prior = float(np.clip(labels.mean() if len(labels) else 0.5, 1e-3, 1 - 1e-3))
    parts = [featurise(tb.Batch.of(pa.array([t])))[0] for t in texts]
    held = np.arange(len(texts)) % 5 == 4
    each = [np.unique(p) for p, h in zip(parts, held, strict=True) if not h]
    seen, texts_with = np.unique(np.concatenate(each), return_counts=True) if each else (np.zeros(0, np.int32), np.zeros(0, np.int64))
    known = seen[(texts_with >= MIN_TEXTS) & (seen >= 0)]
    del each, seen, texts_with
    model = Model(known, np.r_[rng.normal(0, 0.1, (len(known), DIM)), np.zeros((1, DIM))].astype(np.float32), [rng.normal(0, 0.3, (w, DIM, FILTERS)).astype(np.float32) for w in WIDTHS], [np.zeros(FILTERS, np.float32) for _ in WIDTHS], np.full(FILTERS * len(WIDTHS), 0.3, np.float32), float(np.log(prior / (1 - prior))))
    if len(known) and 0 < labels.sum() < len(labels):
        for i, p in enumerate(parts):
            parts[i] = model.rows(p)
        _train(model, parts, labels, np.flatnonzero(~held), rng)
    _calibrate(model, texts, labels, langs, np.flatnonzero(held))
    return model


def gradients(model: Model, words: np.ndarray, first: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
    """Of the weighted logistic loss with a small ridge: by text's logit, by filters, biases and output, and by word vector (laid)."""
    x, start, stop = model.lay(words, first)
    places, values = [], []
    for y in model.maps(x):
        top = np.stack([s + y[s:e].argmax(axis=0) for s, e in zip(start, stop, strict=True)])
        places.append(top)
        values.append(y[top, np.arange(FILTERS)])
    pooled = np.maximum(np.concatenate(values, axis=1), 0)
    p = 1 / (1 + np.exp(-np.clip(pooled @ model.out + model.base, -30, 30)))
    error = ((p - labels) * weights).astype(np.float32)
    back = error[:, None] * model.out * (pooled > 0)
    grads: list[np.ndarray] = []
    gx = np.zeros_like(x)
    for k, width in enumerate(WIDTHS):
        g, top = back[:, k * FILTERS : (k + 1) * FILTERS], places[k]
        gw = np.zeros_like(model.filters[k])
        for i in range(width):
            gw[i] = np.einsum("bfd,bf->df", x[top + i], g)
            np.add.at(gx, (top + i).ravel(), (g[:, :, None] * model.filters[k][i].T[None]).reshape(-1, DIM))
        grads.append(gw + RIDGE * model.filters[k])
    grads += [back[:, k * FILTERS : (k + 1) * FILTERS].sum(axis=0) for k in range(len(WIDTHS))]
    grads.append(pooled.T @ error + RIDGE * model.out)
    return error, grads, gx


def _train(model: Model, rows: list[np.ndarray], labels: np.ndarray, pick: np.ndarray, rng: np.random.Generator, batch: int = 32, steps: int = 1500, rate: float = 0.01) -> None:
    """Adam on the weighted logistic loss; embeddings move only where a filter's maximum lies."""
    share = labels[pick].mean()
    weights = np.where(labels == 1, min(4.0, 0.5 / share), 1.0)
    dense = [*model.filters, *model.bias, model.out]
    moments = [[np.zeros_like(p), np.zeros_like(p)] for p in dense]
    m1, m2 = np.zeros_like(model.table), np.zeros_like(model.table)
    order, at = rng.permutation(pick), 0
    for step in range(1, max(steps, 4 * -(-len(pick) // batch)) + 1):
        if at + batch > len(order):
            order, at = rng.permutation(pick), 0
        own = order[at : at + batch]
        at += batch
        first = np.r_[0, np.cumsum([len(rows[i]) for i in own])]
        words = np.concatenate([rows[i] for i in own])
        error, grads, gx = gradients(model, words, first, labels[own], weights[own] / len(own))
        model.base -= 0.5 * float(error.sum())
        fade = np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
        for param, grad, mv in zip(dense, grads, moments, strict=True):
            mv[0] += 0.1 * (grad - mv[0])
            mv[1] += 0.001 * (grad * grad - mv[1])
            param -= (rate * fade * mv[0] / (np.sqrt(mv[1]) + 1e-7)).astype(np.float32)
        put = np.arange(len(words)) + PAD * np.repeat(np.arange(len(own)), np.diff(first))
        moved = np.flatnonzero(gx[put].any(axis=1))
        if len(moved):
            ids, inverse = np.unique(words[moved].ravel(), return_inverse=True)
            ge = np.zeros((len(ids), DIM), np.float32)
            np.add.at(ge, inverse, np.repeat(gx[put[moved]], 4, axis=0))
            m1[ids] += 0.1 * (ge - m1[ids])
            m2[ids] += 0.001 * (ge * ge - m2[ids])
            model.table[ids] -= (rate * fade * m1[ids] / (np.sqrt(m2[ids]) + 1e-7)).astype(np.float32)
            model.table[-1] = 0


def _calibrate(model: Model, texts: list[str], labels: np.ndarray, langs: list[str | None], held: np.ndarray) -> None:
    model.thresholds = {}
    if not len(held):
        return
    z = model.logits(tb.Batch.of(pa.array([texts[i] for i in held])))
    y = labels[held].astype(float)
    goal = np.where(y == 1, (y.sum() + 1) / (y.sum() + 2), 1 / (len(y) - y.sum() + 2))
    a, b = 1.0, 0.0
    for _ in range(50):  # Newton steps of Platt's method
        p = 1 / (1 + np.exp(-np.clip(a * z + b, -30, 30)))
        w, e = np.maximum(p * (1 - p), 1e-6), p - goal
        h = np.array([[np.sum(w * z * z) + 1e-3, np.sum(w * z)], [np.sum(w * z), np.sum(w) + 1e-3]])
        da, db = np.linalg.solve(h, [np.sum(e * z) + 1e-3 * (a - 1), np.sum(e)])
        a, b = a - np.clip(da, -1, 1), b - np.clip(db, -2, 2)
    model.slope, model.shift = max(a, 0.05), b
    s = 1 / (1 + np.exp(-np.clip(model.slope * z + model.shift, -30, 30)))
    model.common = _best(s, y, 0.3)
    for lang in {langs[i] for i in held} - {None}:
        own = np.array([langs[i] == lang for i in held])
        if y[own].sum() >= 5:
            model.thresholds[lang] = _best(s[own], y[own], model.common)


def _best(s: np.ndarray, y: np.ndarray, default: float) -> float:
    """The threshold with the best F1, midway to the next score; ``default`` if nothing is positive."""
    if not y.sum():
        return default
    order = np.argsort(-s)
    hits = np.cumsum(y[order])
    f1 = 2 * hits / (np.arange(1, len(y) + 1) + y.sum())
    k = int(np.argmax(f1))
    after = s[order][k + 1] if k + 1 < len(s) else 0.0
    return float((s[order][k] + after) / 2)


def held_out(doc_id: str = "doc_id"):
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", rows: int = SAMPLE_ROWS, size: int = SAMPLE_BYTES) -> Model:
    """Fit on at most ``rows`` labelled rows outside the held-out quarter, and at most ``size`` bytes of text."""
    usable = labels.filter(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1) & ~held_out()).select("doc_id", F.col(label).alias("y"))
    sample = usable.orderBy(F.xxhash64("doc_id", F.lit(3)), "doc_id", "y").limit(rows)
    texts = docs.select("doc_id", "lang", "text").join(F.broadcast(sample), "doc_id")  # at most ``rows`` ids
    sized = texts.select("doc_id", "lang", "y", F.coalesce("text", F.lit("")).alias("text")).withColumn("bytes", F.octet_length("text")).filter(F.col("bytes") <= size)
    got, used = [], 0
    for r in sized.orderBy(F.xxhash64("doc_id", F.lit(3)), "doc_id", "text", "y").limit(rows).toLocalIterator():
        used += r["bytes"]
        if used > size:
            break
        got.append(r)
    return fit([r["text"] for r in got], np.array([r["y"] for r in got], np.int64), [r["lang"] for r in got])


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang, score of each document; the language takes no part in the score."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in tb.joined(batches, "text", SCORE_BYTES):
            s = shared.value.score(tb.Batch.of(rows.column("text")))
            cut = [shared.value.thresholds.get(x, shared.value.common) for x in rows.column("lang").to_pylist()]
            yield pa.record_batch([rows.column("doc_id"), pa.array(s.astype(float)), pa.array(cut, pa.float64())], ["doc_id", "score", "lang_threshold"])

    return docs.select("doc_id", "lang", "text").mapInArrow(task, "doc_id long, score double, lang_threshold double")


def op6_toxicity(spark, sf_dir: str) -> DataFrame:
    from .common import table

    docs = table(spark, sf_dir, "documents")
    scored = score(docs, train(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"), "lang_threshold", (F.col("score") >= F.col("lang_threshold")).alias("flagged"))
