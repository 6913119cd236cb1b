"""Quality rules with n-gram perplexity.

A modified Kneser-Ney model of characters (code points), order five, is counted by Spark over all
documents for every language value found. The counts, the continuation counts of the lower orders and
the discounts are grouped tables that grow with the corpus; joins of them give each five-gram its
interpolated probability. For scoring these stand in sorted arrays of hashes, in parts of a bounded
size: one part is broadcast at a time, and each document adds up what it finds in all parts. Documents
fall into two halves by the least hash of their word pairs, and each half is scored by the counts of
the other, so that no text, nor a copy of it, and few of its near copies vouch for it. Each language's
bands, robust in the spread of all its documents, reject what lies outside.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillon.llm import _text as T
from quillon.llm._ship import ship
from quillon.llm._store import Store

#: Order of the model. A context of four characters and one more fit into two longs.
ORDER = 5
#: What stands before the first character of a text: no code point.
START = (1 << 21) - 1
#: Five-grams of one broadcast part: 16 bytes each.
PART = 4_000_000
#: Distinct five-grams that a task holds before it sends its counts on.
HELD = 500_000
#: Bytes of text of one step: a step makes some twenty arrays of its characters.
STEP = 1 << 18
#: Spreads (median absolute deviations of the log-perplexity, scaled to a normal sigma) from the median to the bands.
LOWER, UPPER = 4.0, 4.0
#: A band widens by this over the root of a document's length in characters: a short text's mean varies more.
LENGTH = 1.5

_B = np.int64(21)


def _points(buf: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points of UTF-8 bytes and each row's first."""
    lead = (buf & 0xC0) != 0x80
    first = np.concatenate([[0], np.cumsum(lead)])[rows]
    return np.frombuffer(buf.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32).astype(np.int64), first


def _grams(buf: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ends, middle, first) of each character's five-gram: its first and last character in one long, the three between in another, and each row's first."""
    c, first = _points(buf, rows)
    # four STARTs before each text
    place = np.arange(len(c)) + np.repeat((ORDER - 1) * np.arange(1, len(first)), np.diff(first))
    whole = np.full(len(c) + (ORDER - 1) * (len(first) - 1), START, np.int64)
    whole[place] = c
    middle = (whole[place - 3] << 2 * _B) | (whole[place - 2] << _B) | whole[place - 1]
    return (whole[place - 4] << _B) | c, middle, first


def _half(buf: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """The half of each text."""
    starts, ends, first = T.words(buf, rows)
    half = np.zeros(len(rows) - 1, np.int64)
    if len(starts):
        pairs, at = T.windows(T.word_hashes(buf, starts, ends), first, 2, whole=True)
        some = np.flatnonzero(np.diff(at))
        half[some] = (np.minimum.reduceat(pairs, at[:-1][some]) & np.uint64(1)).astype(np.int64)
    return half


_KEY = ["lang", "ends", "middle"]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, ends, middle, n0, n1): distinct five-grams with their counts in both halves, added up in the task."""
    held: list[pa.Table] = []

    def added(tables: list[pa.Table]) -> pa.Table:
        t = pa.concat_tables(tables).group_by(_KEY, use_threads=False).aggregate([("n0", "sum"), ("n1", "sum")])
        return t.rename_columns([c.removesuffix("_sum") for c in t.column_names]).select([*_KEY, "n0", "n1"])

    for batch in batches:
        lang = batch.column("lang").to_numpy(zero_copy_only=False)
        for a, b, buf, rows in T.steps(batch.column("text"), STEP):
            ends, middle, first = _grams(buf, rows)
            of = np.repeat(np.arange(b - a), np.diff(first))
            half = _half(buf, rows)[of]
            held.append(added([pa.table({"lang": lang[a:b][of], "ends": ends, "middle": middle, "n0": 1 - half, "n1": half})]))
            if sum(t.num_rows for t in held) > HELD:
                held = [added(held)]
                if held[0].num_rows > HELD / 2:
                    yield from held.pop().to_batches()
                    pa.default_memory_pool().release_unused()
    if held:
        yield from added(held).to_batches()


def _discounts(counts: DataFrame) -> DataFrame:
    """(lang, d0, d1): each half's three discounts of modified Kneser-Ney, from its counts of counts."""
    ones = [F.sum((F.col(f"n{h}") == i).cast("double")).alias(f"o{h}{i}") for h in (0, 1) for i in range(1, 5)]

    def of(h: int) -> Column:
        o = [None] + [F.col(f"o{h}{i}") for i in range(1, 5)]
        y = F.when((o[1] > 0) & (o[2] > 0), o[1] / (o[1] + 2 * o[2])).otherwise(0.5)
        d = [F.when((o[i] > 0) & (o[i + 1] > 0), F.least(F.greatest(i - (i + 1) * y * o[i + 1] / o[i], F.lit(0.05 * i)), F.lit(0.95 * i))).otherwise(0.5) for i in (1, 2, 3)]
        return F.array(F.lit(0.0), *d)

    return counts.groupBy("lang").agg(*ones).select("lang", of(0).alias("d0"), of(1).alias("d1"))


def _shares(counts: DataFrame, context: list[str]) -> DataFrame:
    """counts with share0, share1 and weight0, weight1: the discounted share of each n-gram and what its context leaves to the lower order, in both halves' models."""
    cut = counts.join(F.broadcast(_discounts(counts)), "lang")  # a row a language
    for h in (0, 1):
        cut = cut.withColumn(f"c{h}", F.get(f"d{h}", F.least(f"n{h}", F.lit(3)).cast("int"))).drop(f"d{h}")
    keys = ["lang", *context]
    total = cut.groupBy(*keys).agg(*(F.sum(f"{a}{h}").alias(f"{b}{h}") for h in (0, 1) for a, b in (("n", "all"), ("c", "left"))))
    out = cut.join(total, keys)
    for h in (0, 1):
        some = F.col(f"all{h}") > 0
        out = out.withColumn(f"share{h}", F.when(some, (F.col(f"n{h}") - F.col(f"c{h}")) / F.col(f"all{h}")).otherwise(0.0))
        out = out.withColumn(f"weight{h}", F.when(some, F.col(f"left{h}") / F.col(f"all{h}")).otherwise(1.0))
    return out.drop(*(f"{c}{h}" for c in ("n", "c", "all", "left") for h in (0, 1)))


def fit(store: Store, rows: DataFrame) -> DataFrame:
    """(lang, ends, middle, p0, p1): the log-probability of the last character of every five-gram of rows(lang, text) in the models of both halves.

    Lower orders count distinct left neighbours. Every n-gram of either half stands in the tables of
    all orders, so the joins miss none; one that a half doesn't have counts 0 there and gets its share
    of the lower orders. A character that a half never saw gets one share of the uniform distribution
    over its characters and one unknown.
    """
    context = {ORDER: ["first", "middle"], 1: []}  # by order; in between the characters of middle that the order sees
    inner = lambda order: F.col("middle").bitwiseAND(F.lit((1 << 21 * (order - 1)) - 1)).alias("middle")
    sums = lambda of: [F.sum(of(h)).alias(f"n{h}") for h in (0, 1)]
    counts = rows.mapInArrow(_count, "lang long, ends long, middle long, n0 long, n1 long").groupBy(*_KEY).agg(*sums(lambda h: f"n{h}"))
    counts = counts.select("lang", F.shiftright("ends", 21).alias("first"), "middle", F.col("ends").bitwiseAND(F.lit((1 << 21) - 1)).alias("w"), "n0", "n1")
    tables = {ORDER: store.keep(counts, f"grams{ORDER}")}
    for order in range(ORDER - 1, 0, -1):
        below = tables[order + 1].select("lang", *([inner(order)] if order > 1 else []), "w", "n0", "n1")
        types = below.groupBy("lang", *context.setdefault(order, ["middle"]), "w").agg(*sums(lambda h: (F.col(f"n{h}") > 0).cast("long")))
        tables[order] = store.keep(types, f"grams{order}")
    size = tables[1].groupBy("lang").agg(*(F.sum((F.col(f"n{h}") > 0).cast("long")).alias(f"size{h}") for h in (0, 1)))
    p = _shares(tables[1], []).join(F.broadcast(size), "lang").select("lang", "w", *((F.col(f"share{h}") + F.col(f"weight{h}") / (F.col(f"size{h}") + 1)).alias(f"low{h}") for h in (0, 1)))
    for order in range(2, ORDER + 1):
        lower = ["lang", *(["middle"] if order > 2 else []), "w"]
        p = p.select(*(F.col(c).alias("below" if c == "middle" else c) for c in lower), "low0", "low1")
        shares = _shares(tables[order], context[order])
        if order > 2:
            shares = shares.withColumn("below", inner(order - 1))
        p = shares.join(p, ["below" if c == "middle" else c for c in lower]).select("lang", *context[order], "w", *((F.col(f"share{h}") + F.col(f"weight{h}") * F.col(f"low{h}")).alias(f"low{h}") for h in (0, 1)))
        p = store.keep(p, f"p{order}")
    return p.select("lang", F.shiftleft("first", 21).bitwiseOR(F.col("w")).alias("ends"), "middle", *(F.log(f"low{h}").cast("float").alias(f"p{h}") for h in (0, 1)))


def _hash(lang: np.ndarray, ends: np.ndarray, middle: np.ndarray) -> np.ndarray:
    return T.mix(T.mix(lang.view(np.uint64) ^ ends.view(np.uint64)) + middle.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            h = _hash(*(batch.column(c).to_numpy() for c in _KEY))
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), batch.column("p0"), batch.column("p1")], names=["h", "p0", "p1"])


class Lookup:
    """Sorted hashes and the values beside them, the last of which stands for none.

    A first guess of each place comes from an index of the hashes' leading bits.
    """

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        bits = max(1, (len(keys) - 1).bit_length())
        self.keys, self.values, self.shift = keys, values, np.uint64(64 - bits)
        self.first = np.searchsorted(keys, np.arange(1 << bits, dtype=np.uint64) << self.shift).astype(np.int32)

    def __call__(self, h: np.ndarray, column: np.ndarray) -> np.ndarray:
        """The value of each hash in a column of its own; 0 for hashes that aren't there."""
        at = self.first[(h >> self.shift).astype(np.int64)]
        key = self.keys[at]
        behind = np.flatnonzero(key < h)
        while len(behind):
            at[behind] += 1
            key[behind] = now = self.keys[at[behind]]
            behind = behind[now < h[behind]]
        return np.where((key == h) & (at < len(self.keys) - 1), self.values[at, column], self.values.dtype.type(0))


def parts(store: Store, model: DataFrame) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Sorted hashes and log-probabilities in both halves' models of the five-grams, about PART of them at a time, and a last entry for none."""
    hashed = store.keep(model.mapInArrow(_hashed, "h long, p0 float, p1 float"), "hashed")
    n = max(1, math.ceil(hashed.count() / PART))
    for i in range(n):
        t = hashed.where(F.pmod("h", F.lit(n)) == i).toArrow()
        h = t["h"].to_numpy().view(np.uint64)
        by = np.argsort(h)
        yield np.append(h[by], np.uint64(2**64 - 1)), np.stack([np.append(t[c].to_numpy()[by], np.float32(0)) for c in ("p0", "p1")], axis=1)


def _base(buf: np.ndarray, rows: np.ndarray) -> dict[str, np.ndarray]:
    """Base features of each text."""
    starts, ends, first = T.words(buf, rows)
    n_words = np.diff(first)
    sums = lambda mask: np.diff(np.concatenate([[0], np.cumsum(mask)])[rows])
    chars = sums(T.IS_WORD[buf] & ((buf & 0xC0) != 0x80))
    symbols = sums(np.isin(buf, np.frombuffer(b"#*$%&|<>", np.uint8)))
    repeat, dup = np.zeros(len(n_words), np.int64), np.zeros(len(n_words), np.int64)
    if len(starts):
        win, wrow = T.windows(T.word_hashes(buf, starts, ends), first, 3, whole=False)
        for r in np.flatnonzero(np.diff(wrow) > 1):
            w = win[wrow[r] : wrow[r + 1]]
            _, inverse, times = np.unique(w, return_inverse=True, return_counts=True)
            again = times[inverse] > 1
            if again.any():
                cover = np.zeros(n_words[r], bool)
                for j in range(3):
                    cover[j : j + len(w)] |= again
                repeat[r] = cover.sum()
        raw = buf.tobytes()
        for r in np.flatnonzero(n_words):
            lines = [x for x in raw[rows[r] : rows[r + 1]].split(b"\n") if x.strip(b" \t\n\x0b\x0c\r")]
            dup[r] = len(lines) - len(set(lines))
    return {"n_words": n_words, "word_chars": chars, "n_symbols": symbols, "n_dup_lines": dup, "n_repeat_words": repeat}


FEATURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def measure(spark: SparkSession, store: Store, docs: DataFrame) -> DataFrame:
    """(doc_id, lang, the base features, log_ppl) of every whole text; log_ppl is null for texts without a letter.

    A document's log-probability is spread over its letters (ASCII letters and what lies beyond ASCII),
    so that marks and figures between them count as their cost.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.when(F.col("lang").isNull(), F.lit(0).cast("long")).otherwise(F.xxhash64(F.lower("lang"))).alias("lang"), F.col("text").cast("string").alias("text"))
    names = ["row", "doc_id", "lang", *FEATURES, "n", "total"]

    def scored(rows: DataFrame, shared, begins: bool) -> DataFrame:
        """What the model's part adds to the log-probability of each text; the first pass finds the features too."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            find = Lookup(*shared.value)
            for batch in batches:
                lang = batch.column("lang").to_numpy(zero_copy_only=False)
                for a, b, buf, rows in T.steps(batch.column("text"), STEP):
                    ends, middle, first = _grams(buf, rows)
                    of = np.repeat(np.arange(b - a), np.diff(first))
                    # the half that a text isn't in scores it
                    found = find(_hash(lang[a:b][of], ends, middle), 1 - _half(buf, rows)[of])
                    total = pa.array(np.bincount(of, found, b - a).astype(np.float64))
                    if not begins:
                        yield pa.RecordBatch.from_arrays([batch.column("row").slice(a, b - a), total], names=["row", "more"])
                        continue
                    c = ends & START
                    n = np.bincount(of, (c >= 128) | ((c | 32) >= 97) & ((c | 32) <= 122), b - a)
                    f = _base(buf, rows)
                    yield pa.RecordBatch.from_arrays([*(batch.column(c).slice(a, b - a) for c in names[:3]), *(pa.array(f[k].astype(np.int64)) for k in FEATURES), pa.array(n.astype(np.int64)), total], names=names)

        return rows.mapInArrow(run, "row long, doc_id long, lang long, " + ", ".join(f"{k} long" for k in FEATURES) + ", n long, total double" if begins else "row long, more double")

    model = fit(store, rows.select("lang", "text"))
    numbered = rows.withColumn("row", F.xxhash64("doc_id", "lang", "text"))
    done = None
    for part in parts(store, model):
        shared = spark.sparkContext.broadcast(part)
        if done is None:
            done = store.keep(scored(numbered, shared, True), "scored")
        else:  # equal rows get equal sums
            one = store.keep(scored(numbered.select("row", "lang", "text"), shared, False), "more")
            done = store.keep(done.join(one.groupBy("row").agg(F.first("more").alias("more")), "row").withColumn("total", F.col("total") + F.col("more")).drop("more"), "scored")
            store.drop(one)
        shared.destroy()
    return done.select("doc_id", "lang", *FEATURES, F.when(F.col("n") > 0, -F.col("total") / F.col("n")).alias("log_ppl"))


def bands(measured: DataFrame) -> DataFrame:
    """(lang, low, high): what each language accepts of a log-perplexity, from all its documents."""
    usable = measured.where(F.col("log_ppl").isNotNull() & (F.col("n_words") >= 50))
    mid = usable.groupBy("lang").agg(F.percentile_approx("log_ppl", 0.5, 2000).alias("mid"))
    off = usable.join(F.broadcast(mid), "lang").groupBy("lang").agg(F.first("mid").alias("mid"), (1.4826 * F.percentile_approx(F.abs(F.col("log_ppl") - F.col("mid")), 0.5, 2000)).alias("spread"))
    return off.select("lang", (F.col("mid") - LOWER * F.col("spread")).alias("low"), (F.col("mid") + UPPER * F.col("spread")).alias("high"))


def judge(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """(doc_id, base features, base_failed, log_ppl, kept) of every row of docs(doc_id, text, lang, ...).

    base_failed: under 50 words, or more than half of the words in repeated three-word windows.
    kept: not base_failed and the log-perplexity inside the bands of the document's language. A null or
    empty text has no words and fails. Each language value has a model of its own, whatever its case;
    null is one more. Repeated rows are judged as often as they stand, other columns are ignored, and an
    empty table gives no rows.
    """
    ship(spark)
    store = Store(spark, "lmquality")
    m = store.finish(measure(spark, store, docs), "measured")
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    wider = LENGTH / F.sqrt(F.greatest("word_chars", F.lit(1)))
    inside = F.coalesce(F.col("log_ppl").between(F.col("low") - wider, F.col("high") + wider), F.lit(False))
    out = m.join(F.broadcast(bands(m)), "lang", "left")  # a row a language
    return out.select("doc_id", *FEATURES, failed.alias("base_failed"), "log_ppl", (~failed & inside).alias("kept"))
