"""Benchmark decontamination: size-partitioned MinHash containment search.

A benchmark item with n distinct five-word shingles is contained in a document that holds at least
CONTAINMENT of them. Items are partitioned by size (powers of two). In a partition whose largest
item may have u shingles, an item's sketch is its u - ceil(CONTAINMENT * u) + 1 smallest shingle
hashes: a document that contains the item misses at most one fewer, so it holds one of the sketch,
and no contained item is missed. A document is read once: bitmaps of the items' shingles and sketches,
whose size follows the benchmark's up to a bound, tell which of its hashes can matter, and only documents
with a sketch hit send hashes on. Candidates come from an equi-join of hits with the sketches alone; each
is verified on the exact count of the item's distinct shingles that the document holds. A shingle or an
item that very many documents share is dealt over several tasks in both joins.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillon.llm import _text as T
from quillon.llm._ship import ship
from quillon.llm._store import Store, free_name, sized

CONTAINMENT_NUM, CONTAINMENT_DEN = 80, 100
#: Bits of a bitmap for each shingle of the benchmark, and of the smallest and the largest bitmap (32 MB); a fuller one lets more hashes through, which the joins then drop.
SHINGLE_BITS, LEAST_BITS, MOST_BITS = 16, 1 << 20, 1 << 28
#: Rows of one key that a join leaves to one task.
HOT_ROWS = 100_000


def _need(n: int) -> int:
    return -(-CONTAINMENT_NUM * n // CONTAINMENT_DEN)


def sketch_size(n: int) -> int:
    """Sketch length of the size partition that n belongs to."""
    upper = (1 << max(0, math.ceil(math.log2(n)))) if n > 1 else 1
    return upper - _need(upper) + 1


def _item_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column("item_id")
        for a, b, buf, rows in T.steps(batch.column("text")):
            u, first = T.distinct(*T.shingles(buf, rows))
            n = np.diff(first)
            of = np.repeat(np.arange(b - a), n)
            by = np.lexsort((T.mix(u), of))
            low = np.arange(len(u)) - first[of] < np.array([sketch_size(x) if x else 0 for x in n], np.int64)[of]
            tag = np.array([hash_text(buf[rows[r] : rows[r + 1]]) if n[r] else 0 for r in range(b - a)], np.int64)
            yield pa.RecordBatch.from_arrays([ids.take(pa.array(a + of)), pa.array(tag[of]), pa.array(n[of]), pa.array(u[by].view(np.int64)), pa.array(low)], names=["item_id", "item", "n_item", "hash", "in_sketch"])


def item_shingles(items: DataFrame) -> DataFrame:
    """(item_id, item, n_item, hash, in_sketch) of every distinct shingle of items(item_id, text); item tells texts with one item_id apart."""
    rows = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).mapInArrow(_item_rows, "item_id long, item long, n_item long, hash long, in_sketch boolean")
    return rows.distinct().withColumn("item", F.xxhash64("item_id", "item"))


def _bitmap(hashes: DataFrame, bits: int) -> np.ndarray:
    """A bitmap of the hashes: at most bits / 64 rows come to the driver."""
    bit = F.pmod("hash", F.lit(bits))
    got = hashes.groupBy((bit / 64).cast("int").alias("at")).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(bit, F.lit(64)).cast("int"))).alias("bits")).toArrow()
    out = np.zeros(bits // 64, np.int64)
    out[got["at"].to_numpy()] = got["bits"].to_numpy()
    return out.view(np.uint64)


def spread_join(store: Store, big: DataFrame, small: DataFrame, key: str) -> DataFrame:
    """big joined with small on key; a key of over HOT_ROWS rows of big is dealt over several tasks, to which its rows of small are copied.

    big should be a kept table, so that a repeated task deals its rows alike.
    """
    hot = store.keep(big.groupBy(key).count().where(F.col("count") > HOT_ROWS).select(key, F.ceil(F.col("count") / HOT_ROWS).alias("_salts")), "hot")  # at most a row for HOT_ROWS of big
    hot = sized(hot)
    left = big.join(hot, key, "left").withColumn("_salt", F.coalesce(F.pmod(F.monotonically_increasing_id(), "_salts"), F.lit(0)))
    right = small.join(hot, key, "left").withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("_salts", F.lit(1).cast("long")) - 1)))
    return left.drop("_salts").join(right.drop("_salts"), [key, "_salt"]).drop("_salt")


def find_leaks(spark: SparkSession, docs: DataFrame, items: DataFrame) -> DataFrame:
    """(doc_id, item_id, n_item, n_shared) of each document that contains a benchmark item.

    docs(doc_id, text, ...), items(item_id, text, ...); A-Z are lowered. Null, empty or blank texts on
    either side contain nothing and are contained nowhere; an item of one to four words is one
    shingle, which only a document of those same words holds. Rows that repeat a doc_id are searched
    text by text and a pair is returned once, with the most shingles shared. A null doc_id or item_id
    is kept as null. Other columns are ignored, and an empty table on either side gives no rows.
    """
    ship(spark)
    store = Store(spark, "leaks")
    shingles = store.keep(item_shingles(items), "items")
    bits = min(MOST_BITS, max(LEAST_BITS, 1 << (SHINGLE_BITS * max(shingles.count(), 1) - 1).bit_length()))
    shared = spark.sparkContext.broadcast((_bitmap(shingles, bits), _bitmap(shingles.where("in_sketch"), bits)))

    def hits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole, sketch = shared.value
        has = lambda bitmap, h: (bitmap[(h % bits) >> np.uint64(6)] >> (h & np.uint64(63))) & np.uint64(1) != 0
        for batch in batches:
            ids = batch.column("doc_id")
            for a, b, buf, rows in T.steps(batch.column("text")):
                h, first = T.shingles(buf, rows)
                if not len(h):
                    continue
                maybe = has(whole, h)
                of = np.repeat(np.arange(b - a), np.diff(first))
                starts = maybe & has(sketch, h)
                known = np.zeros(b - a, bool)
                known[of[starts]] = True
                at = np.flatnonzero(maybe & known[of])
                if len(at):
                    by = at[np.lexsort((h[at], of[at]))]
                    at = by[np.concatenate([[True], (h[by[1:]] != h[by[:-1]]) | (of[by[1:]] != of[by[:-1]])])]  # each hash of a text once
                    tags = np.zeros(b - a, np.int64)
                    for r in np.unique(of[at]):
                        tags[r] = hash_text(buf[rows[r] : rows[r + 1]])
                    yield pa.RecordBatch.from_arrays([ids.take(pa.array(a + of[at])), pa.array(tags[of[at]]), pa.array(h[at].view(np.int64)), pa.array(starts[at])], names=["doc_id", "tag", "hash", "starts"])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = store.keep(texts.mapInArrow(hits, "doc_id long, tag long, hash long, starts boolean"), "found")
    # a pair is a candidate if it shares part of the item's sketch; the count is of the item's whole set
    sketches = shingles.where("in_sketch").select("hash", "item")
    candidates = store.keep(spread_join(store, found.where("starts").select("doc_id", "tag", "hash"), sketches, "hash").select("doc_id", "tag", "item").distinct(), "candidates")
    wanted = spread_join(store, candidates, shingles.select("item", "item_id", "n_item", "hash"), "item")
    held = found.select(F.col("doc_id").alias("_doc"), F.col("tag").alias("_tag"), F.col("hash").alias("_hash")).distinct()
    both = wanted.join(held, F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("tag") == F.col("_tag")) & (F.col("hash") == F.col("_hash")))
    pairs = both.groupBy("doc_id", "tag", "item", "item_id", "n_item").agg(F.count("*").alias("n_shared")).where(CONTAINMENT_DEN * F.col("n_shared") >= CONTAINMENT_NUM * F.col("n_item"))
    return pairs.groupBy("doc_id", "item_id").agg(F.max("n_item").alias("n_item"), F.max("n_shared").alias("n_shared"))


def hash_text(raw: np.ndarray) -> int:
    """Tells texts of rows that share a doc_id apart."""
    return int(T.word_hashes(raw, np.array([0]), np.array([len(raw)]))[0].view(np.int64))


def clean_documents(spark: SparkSession, docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of docs whose doc_id leaks no item, with all their columns, whatever their names."""
    leaks = Store(spark, "decontam").keep(find_leaks(spark, docs, items).select("doc_id").distinct(), "leaks")
    leaks = leaks.toDF(free_name("leak", docs.columns))
    return docs.join(sized(leaks), docs["doc_id"].eqNullSafe(leaks[leaks.columns[0]]), "left_anti")
