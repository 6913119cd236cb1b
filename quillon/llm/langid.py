"""Language identification with string kernels.

The kernel of two texts counts the n-grams (all lengths of a blended spectrum) present in both,
divided by the root of the product of their own counts. Landmarks are labelled sample texts; the
Nystroem map built on them turns one-versus-rest kernel ridge regression into a small linear system.
A batch of texts is scored as one product: presence matrix times (landmark presence times map times
weights), which is the same as multiplying through the kernel values, since those are linear in the
presence of n-grams.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillon.llm._ship import ship

#: Lengths of the n-grams, in code points, and the number of hashed n-grams.
LENGTHS = (1, 2, 3, 4)
BUCKETS = 1 << 18
#: Bounds of the labelled sample: texts of one language to fit on and to use as landmarks, their characters. Every
#: language is learned; where there are many, each has fewer texts, SAMPLE_TEXTS in all but LEAST_PER_LANGUAGE at least.
PER_LANGUAGE, LANDMARKS, SAMPLE_CHARS, SAMPLE_TEXTS, LEAST_PER_LANGUAGE = 240, 48, 20_000, 16_384, 12
RIDGE = 1e-3
#: accepted() rejects a document whose best score is lower, or that knows less than so much of the share of
#: its n-grams which texts of its language find among the landmarks in the median, less so many standard
#: deviations of that share in a text of as many n-grams: the fewer it has, the less its share tells.
MIN_SCORE, KNOWN, DEVIATIONS = 0.3, 0.65, 2.0
#: Labelled texts beside the landmarks that a language needs for a median of its own; with fewer it has that of all languages' together.
LEAST_TEXTS = 8


def _has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def _grams(text: str) -> np.ndarray:
    """Sorted hashed n-grams present in a text (lower-cased, runs of non-letters as one blank)."""
    c = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    c = c[c != 0xFEFF]
    # ASCII that is no letter counts as a blank, runs of blanks as one
    blank = (c < 128) & ~((c >= 97) & (c <= 122))
    keep = np.ones(len(c), bool)
    keep[1:] = ~(blank[1:] & blank[:-1])
    c = np.where(blank, np.uint32(32), c)[keep].astype(np.uint32)
    seen = np.zeros(BUCKETS, bool)
    g = np.zeros(len(c), np.uint32)
    for n in range(1, max(LENGTHS) + 1):
        if len(c) < n:
            break
        g = g[: len(c) - n + 1] * np.uint32(0x01000193) + (c[n - 1 :] + np.uint32(n)) * np.uint32(0x9E3779B1)
        if n in LENGTHS:
            h = g ^ (g >> np.uint32(15))
            h = h * np.uint32(0x85EBCA6B)
            seen[h >> np.uint32(14)] = True
    return np.flatnonzero(seen)


@dataclass
class Model:
    languages: list[str]
    index: np.ndarray  # bucket -> row of weights, or the zero row
    weights: np.ndarray  # (rows + 1, languages)
    bias: np.ndarray
    usual: np.ndarray  # median share of known n-grams in texts of each language

    def known(self, grams: np.ndarray) -> float:
        """The share of a text's n-grams that the landmarks have."""
        return float((self.index[grams] < len(self.weights) - 1).mean()) if len(grams) else 0.0

    def scores(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Regression values, one row a text and one column a language, the share of known n-grams and the number of n-grams."""
        out, known, many = np.empty((len(texts), len(self.languages)), np.float32), np.zeros(len(texts)), np.zeros(len(texts))
        for a in range(0, len(texts), 64):
            part = [_grams(t) for t in texts[a : a + 64]]
            block = np.zeros((len(part), len(self.weights)), np.float32)
            for i, g in enumerate(part):
                block[i, self.index[g]] = 1 / max(1.0, len(g)) ** 0.5
                known[a + i], many[a + i] = self.known(g), len(g)
            block[:, -1] = 0
            out[a : a + 64] = block @ self.weights
        return out + self.bias, known, many

    def accepts(self, texts: list[str]) -> np.ndarray:
        """Whether each text has a letter, scores enough and is built as its language is."""
        ok = np.array([_has_letter(t) for t in texts], bool)
        some = np.flatnonzero(ok)
        values, known, many = self.scores([texts[i] for i in some])
        least = KNOWN * self.usual[values.argmax(axis=1)]
        least -= DEVIATIONS * np.sqrt(least * (1 - least) / np.maximum(many, 1))
        ok[some] = ((values.max(axis=1, initial=-1.0) + 1) / 2 >= MIN_SCORE) & (known >= least)
        return ok


def fit(spark: SparkSession, labelled: DataFrame) -> Model:
    """Fits on labelled(text, lang): a bounded sample of whole texts, the first by a hash of the text.

    The bounds are PER_LANGUAGE, SAMPLE_TEXTS and SAMPLE_CHARS; nothing else is read to the driver.
    Null texts or languages and texts without a letter teach nothing; no labelled row at all gives a
    model that answers `und`.
    """
    ship(spark)
    usable = labelled.where(F.col("text").rlike(r"\p{L}") & F.col("lang").isNotNull() & (F.length("text") <= SAMPLE_CHARS)).select("text", "lang", (F.pmod(F.xxhash64("text"), F.lit(1 << 30)) / (1 << 30)).alias("u"))
    counts = usable.groupBy("lang").count().persist()  # a row a language
    most = min(PER_LANGUAGE, max(LEAST_PER_LANGUAGE, SAMPLE_TEXTS // max(1, counts.count())))
    take = counts.select("lang", (F.lit(1.5 * most + 30) / F.col("count")).alias("share"))
    first = F.row_number().over(Window.partitionBy("lang").orderBy("u", "text"))
    rows = usable.join(take, "lang").where("u < share").select("lang", "u", "text").withColumn("n", first).where(F.col("n") <= most)
    rows = rows.select("lang", "u", "text").mapInArrow(_to_grams, "lang string, u double, grams binary").collect()
    counts.unpersist()
    by: dict[str, list[np.ndarray]] = {}
    for r in sorted(rows, key=lambda r: (r["lang"], r["u"])):
        by.setdefault(r["lang"], []).append(np.frombuffer(bytes(r["grams"]), np.int32))
    names = sorted(by)
    if not names:
        return Model(["und"], np.zeros(BUCKETS, np.int32), np.zeros((1, 1), np.float32), np.full(1, -1, np.float32), np.zeros(1))
    per = max(4, min(LANDMARKS, 1024 // len(names)))
    marks = [g for n in names for g in by[n][:per]]
    texts = [(g, i) for i, n in enumerate(names) for g in by[n]]
    used = np.unique(np.concatenate(marks))
    index = np.full(BUCKETS, len(used), np.int32)
    index[used] = np.arange(len(used), dtype=np.int32)

    def presence(grams: list[np.ndarray]) -> np.ndarray:
        m = np.zeros((len(grams), len(used) + 1), np.float32)
        for i, g in enumerate(grams):
            m[i, index[g]] = 1 / len(g) ** 0.5
        m[:, -1] = 0
        return m

    land = presence(marks)
    values, vectors = np.linalg.eigh((land @ land.T).astype(np.float64))
    values = np.maximum(values, 1e-6 * values.max())
    root = vectors / np.sqrt(values)  # the Nystroem map: kernel values with the landmarks times this
    left, right = np.zeros((root.shape[1] + 1,) * 2), np.zeros((root.shape[1] + 1, len(names)))
    weight = {i: 1 / len(by[n]) for i, n in enumerate(names)}
    for a in range(0, len(texts), 256):
        part = texts[a : a + 256]
        phi = np.hstack([(presence([g for g, _ in part]) @ land.T).astype(np.float64) @ root, np.ones((len(part), 1))])
        y = np.full((len(part), len(names)), -1.0)
        y[np.arange(len(part)), [i for _, i in part]] = 1
        w = np.array([weight[i] for _, i in part])[:, None] / len(names)
        left += phi.T @ (w * phi)
        right += phi.T @ (w * y)
    left[np.arange(len(root.T)), np.arange(len(root.T))] += RIDGE
    beta = np.linalg.solve(left + 1e-9 * np.eye(len(left)), right)
    weights = land.T.astype(np.float64) @ (root @ beta[:-1])
    weights[-1] = 0
    model = Model(names, index, weights.astype(np.float32), beta[-1].astype(np.float32), np.zeros(len(names)))
    shares = [[model.known(g) for g in by[n][per:]] for n in names]
    together = np.median(x) if (x := [k for own in shares for k in own]) else 0.0
    model.usual[:] = [np.median(own) if len(own) >= LEAST_TEXTS else together for own in shares]
    return model


def _to_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.RecordBatch.from_arrays([batch.column("lang"), batch.column("u"), pa.array([_grams(t).astype(np.int32).tobytes() for t in batch.column("text").to_pylist()], pa.binary())], names=["lang", "u", "grams"])


def predict(spark: SparkSession, docs: DataFrame, model: Model) -> DataFrame:
    """docs(doc_id, text, ...) -> (doc_id, lang_pred, score) of every whole text.

    A text that is null or has no letter gives `und` with score 0; ties go to the first language by
    name. score maps the best regression value from [-1, 1] to [0, 1]. Repeated rows are scored as
    often as they stand; other columns are ignored; an empty table gives no rows.
    """
    ship(spark)
    shared = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            for a in range(0, batch.num_rows, 1024):
                part = batch.slice(a, 1024)
                texts = part.column("text").to_pylist()
                known = np.array([t is not None and _has_letter(t) for t in texts], bool)
                values = np.full((len(texts), len(m.languages)), -1.0, np.float32)
                if known.any():
                    values[known] = m.scores([t for t, k in zip(texts, known, strict=True) if k])[0]
                best = values.argmax(axis=1)
                score = np.clip((values[np.arange(len(texts)), best].astype(float) + 1) / 2, 0, 1) * known
                names = [m.languages[i] if k else "und" for i, k in zip(best, known, strict=True)]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(names, pa.string()), pa.array(score)], names=["doc_id", "lang_pred", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id long, lang_pred string, score double")


def held_out(doc_id: str = "doc_id"):
    """The rows that no model learns from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 3 == 1, F.lit(False))


def identify(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Fits on the rows of docs(doc_id, text, lang, ...) that aren't held out and scores every row.

    A null doc_id is not held out and its row comes back with a null doc_id.
    """
    model = fit(spark, docs.where(~held_out() & F.col("doc_id").isNotNull()).select("text", "lang"))
    return predict(spark, docs, model).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def accepted(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """The rows of docs whose language is known, with all their columns.

    Rejected are texts that are null or have no letter, score less than MIN_SCORE in every language, or
    are built of n-grams that their language doesn't have (see KNOWN). Without labelled rows nothing is known.
    """
    model = fit(spark, docs.where(~held_out() & F.col("doc_id").isNotNull()).select("text", "lang"))
    ship(spark)
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("boolean")
    def known(text: pd.Series) -> pd.Series:
        m = shared.value
        texts = [t if isinstance(t, str) else "" for t in text]
        return pd.Series(np.concatenate([m.accepts(texts[a : a + 1024]) for a in range(0, len(texts), 1024)]) if texts else np.zeros(0, bool))

    return docs.where(known("text"))
