"""Quality scores by nearest-neighbour voting over latent-semantic vectors.

Terms are three-grams of byte classes, and marks for the tenths of a text's words that repeat the word
before and of its three-word windows that repeat one before. A bounded sample of labelled documents gives the term weights,
the latent-semantic projection and the reference vectors, which are broadcast. Every document is
projected and compared with all references in blocks of exact cosine products; the labels of its
nearest references vote with their similarities.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillon.llm import _text as T
from quillon.llm._ship import ship
from quillon.llm.langid import held_out


def _classes() -> tuple[np.ndarray, int]:
    """The class of each byte: a-z, capitals, digits, blank, newline, . , | marks, other ASCII, UTF-8 leads, four groups of continuations."""
    k = np.full(256, 34, np.uint8)
    k[97:123] = np.arange(26)
    k[65:91], k[48:58], k[32], k[[9, 10, 11, 12, 13]], k[46], k[44], k[124] = 26, 27, 28, 29, 30, 31, 32
    k[[ord(c) for c in "#*$%&<>"]] = 33
    k[192:] = 35
    for b in range(128, 192):
        k[b] = 36 + (b - 128) // 16
    return k, 40


CLASS, SYMBOLS = _classes()

GRAM = 3
MARKS = 22
TERMS_IN_ALL = SYMBOLS**GRAM + MARKS
#: A mark counts as so many occurrences.
MARK_COUNT = 400
#: Bounds of the labelled sample (rows) and of the terms and dimensions kept: at most
#: REFERENCES x DIMENSIONS and TERMS x DIMENSIONS floats are broadcast.
REFERENCES, TERMS, DIMENSIONS = 6000, 8192, 64
NEIGHBOURS = 25
#: A neighbour votes with its similarity to this power.
SHARPNESS = 8


def _terms(buf: np.ndarray, rows: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(terms, counts) of each text."""
    c = CLASS[buf].astype(np.int32)
    code = (c[:-2] * SYMBOLS + c[1:-1]) * SYMBOLS + c[2:] if len(c) > 2 else np.zeros(0, np.int32)
    starts, ends, first = T.words(buf, rows)
    h = T.word_hashes(buf, starts, ends) if len(starts) else np.zeros(0, np.uint64)
    win, wfirst = T.windows(h, first, 3, whole=False) if len(h) else (h, np.zeros(len(rows), np.int64))
    for r in range(len(rows) - 1):
        a, b = rows[r], rows[r + 1]
        n = np.bincount(code[a : max(a, b - GRAM + 1)], minlength=TERMS_IN_ALL)
        w, x = h[first[r] : first[r + 1]], win[wfirst[r] : wfirst[r + 1]]
        if len(w) > 1:
            n[TERMS_IN_ALL - MARKS + int(np.ceil(10 * (w[1:] == w[:-1]).mean()))] = MARK_COUNT
        if len(x):
            n[TERMS_IN_ALL - MARKS + 11 + int(np.ceil(10 * (1 - len(np.unique(x)) / len(x))))] = MARK_COUNT
        t = np.flatnonzero(n)
        yield t, n[t]


def _sparse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a, b, buf, rows in T.steps(batch.column("text")):
            pairs = list(_terms(buf, rows))
            yield pa.RecordBatch.from_arrays([batch.column("label").slice(a, b - a), pa.array([t.astype(np.int32).tobytes() for t, _ in pairs], pa.binary()), pa.array([n.astype(np.float32).tobytes() for _, n in pairs], pa.binary())], names=["label", "terms", "counts"])


@dataclass
class Model:
    row: np.ndarray  # term -> row of projection, or the zero row
    projection: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    prior: float

    def project(self, terms: np.ndarray, counts: np.ndarray) -> np.ndarray:
        v = np.log1p(counts).astype(np.float32) @ self.projection[self.row[terms]]
        size = np.sqrt(v @ v)
        return v / size if size > 0 else v

    def score(self, block: np.ndarray) -> np.ndarray:
        """The share of similarity-weighted votes for label 1; the prior where nothing is similar."""
        if not len(self.labels):
            return np.full(len(block), self.prior)
        sim = block @ self.vectors.T
        k = min(NEIGHBOURS, sim.shape[1])
        least = np.partition(sim, sim.shape[1] - k, axis=1)[:, -k, None]
        near = sim > least
        tied = sim == least
        near |= tied & (np.cumsum(tied, axis=1) <= k - near.sum(axis=1, keepdims=True))
        w = np.where(near, np.maximum(sim, 0), 0).astype(np.float64) ** SHARPNESS
        total = w.sum(axis=1)
        return np.where(total > 0, w @ self.labels / np.maximum(total, 1e-12), self.prior)


def fit(spark: SparkSession, docs: DataFrame, labels: DataFrame, label: str = "quality") -> Model:
    """Fits on at most REFERENCES labelled documents that aren't held out, the first by a hash of doc_id.

    Rows without doc_id or label teach nothing; several labels of a document count as their mean,
    rounded up, and of texts that share a doc_id the first in order teaches. Without any labelled document
    the model answers 0.5.
    """
    ship(spark)
    some = labels.where(~held_out() & F.col("doc_id").isNotNull() & F.col(label).isNotNull()).groupBy("doc_id").agg(F.avg(label).alias("label"))
    some = some.orderBy(F.xxhash64("doc_id"), "doc_id").limit(REFERENCES)
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(F.broadcast(some), "doc_id").select(F.col("doc_id"), F.when(F.col("label") >= 0.5, 1.0).otherwise(0.0).alias("label"), "text")
    rows = rows.groupBy("doc_id").agg(F.first("label").alias("label"), F.min("text").alias("text")).orderBy("doc_id")  # at most REFERENCES
    got = rows.select("label", "text").mapInArrow(_sparse, "label double, terms binary, counts binary").toArrow()
    y = got["label"].to_numpy()
    sparse = [(np.frombuffer(t.as_py(), np.int32), np.frombuffer(c.as_py(), np.float32)) for t, c in zip(got["terms"], got["counts"], strict=True)]
    frequency = np.zeros(TERMS_IN_ALL, np.int64)
    for t, _ in sparse:
        frequency[t] += 1
    kept = np.sort(np.argsort(-frequency, kind="stable")[: min(TERMS, int((frequency > 1).sum()))])
    row = np.full(TERMS_IN_ALL, len(kept), np.int32)
    row[kept] = np.arange(len(kept), dtype=np.int32)
    if not len(kept):
        return Model(row, np.zeros((1, 1), np.float32), np.zeros((0, 1), np.float32), np.zeros(0), float(y.mean()) if len(y) else 0.5)
    weight = np.log((1 + len(sparse)) / (1 + frequency[kept])).astype(np.float32) + 1
    x = np.zeros((len(sparse), len(kept) + 1), np.float32)
    for i, (t, c) in enumerate(sparse):
        x[i, row[t]] = np.log1p(c)
    x = x[:, :-1] * weight
    x /= np.maximum(np.sqrt((x * x).sum(axis=1, keepdims=True)), 1e-9)
    dims = min(DIMENSIONS, *x.shape)
    q = np.linalg.qr(x.T @ (x @ np.random.default_rng(7).standard_normal((x.shape[1], dims + 16)).astype(np.float32)))[0]
    for _ in range(3):  # randomised subspace iteration
        q = np.linalg.qr(x.T @ (x @ q))[0]
    _, _, small = np.linalg.svd(x @ q, full_matrices=False)
    basis = (q @ small[:dims].T).astype(np.float32)
    projection = np.vstack([basis * weight[:, None], np.zeros((1, dims), np.float32)])
    vectors = x @ basis
    vectors /= np.maximum(np.sqrt((vectors * vectors).sum(axis=1, keepdims=True)), 1e-9)
    return Model(row, projection, vectors.astype(np.float32), y, float(y.mean()))


def score(spark: SparkSession, docs: DataFrame, model: Model) -> DataFrame:
    """docs(doc_id, text, ...) -> (doc_id, held_out, score, predicted) of every whole text.

    Texts that are null, empty or hold no known term have no direction and get the labels' mean.
    Repeated rows are scored as often as they stand; other columns are ignored; an empty table gives
    no rows. Ties among neighbours at the limit are broken by their place in the sample.
    """
    ship(spark)
    shared = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            for a, b, buf, rows in T.steps(batch.column("text")):
                block = np.stack([m.project(t, n) for t, n in _terms(buf, rows)])
                s = np.concatenate([m.score(block[i : i + 256]) for i in range(0, len(block), 256)])
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(a, b - a), pa.array(np.clip(s, 0, 1).astype(np.float64))], names=["doc_id", "score"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id long, score double")
    return rows.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def classify(spark: SparkSession, docs: DataFrame, labels: DataFrame, label: str = "quality") -> DataFrame:
    """fit() and score() in one."""
    return score(spark, docs, fit(spark, docs, labels, label))
