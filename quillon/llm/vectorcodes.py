"""Vector code compression: product codes whose nearest entries are found by Orchard's search.

Every codebook entry has the list of all entries of its part, by distance. A search stands at an entry,
goes through that entry's list, and jumps to a better entry's list as soon as it meets one; entries that
were measured are marked and not measured again. It stops where the list's next entry is farther from
the current entry than twice the current distance: by the triangle inequality none beyond is nearer. All
numbers are integers, so results don't depend on how rows are dealt out.
Searches of a batch go on side by side in numpy; sums of a round are added up by Spark, and only the
codebooks (PARTS * ENTRIES entries) come to the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillon.llm._ship import ship
from quillon.llm._store import Store, sized

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
#: Scaled components must be under this, so that the squared distances of 64 components fit a long.
BOUND = 1 << 27
#: Searches that go on side by side.
SEARCHES = 1 << 17


class Codebooks:
    """The entries of each part (parts, entries, components) with their neighbour lists."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        gap = entries[:, :, None, :] - entries[:, None, :, :]
        far = (gap * gap).sum(-1)
        self.lists = np.argsort(far, axis=2, kind="stable")
        self.far = np.take_along_axis(far, self.lists, 2)
        sums = entries.sum(-1)
        self.by_sum = np.argsort(sums, axis=1, kind="stable")
        self.sums = np.take_along_axis(sums, self.by_sum, 1)

    def search(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each vector's nearest entry and squared distance in each part; x: (vectors, parts, components). Ties go to the lower index."""
        n, parts, _ = x.shape
        many = self.entries.shape[1]
        part = np.tile(np.arange(parts), n)
        x = x.reshape(n * parts, -1)
        # The walk may begin anywhere; it begins at an entry with about the vector's sum.
        total = x.sum(-1)
        here = np.empty(n * parts, np.int64)
        for k in range(parts):
            here[k::parts] = self.by_sum[k, np.minimum(np.searchsorted(self.sums[k], total[k::parts]), many - 1)]
        gap = x - self.entries[part, here]
        best = (gap * gap).sum(-1)
        seen = np.zeros((n * parts, many), bool)
        seen[np.arange(n * parts), here] = True
        at = np.zeros(n * parts, np.int64)
        going = np.arange(n * parts)
        while len(going):
            k, c, i = part[going], here[going], at[going]
            near = self.far[k, c, i] <= 4 * best[going]
            going, k, c, i = going[near], k[near], c[near], i[near]
            at[going] = i + 1
            other = self.lists[k, c, i]
            new = ~seen[going, other]
            g, o = going[new], other[new]
            seen[g, o] = True
            gap = x[g] - self.entries[part[g], o]
            d = (gap * gap).sum(-1)
            better = (d < best[g]) | ((d == best[g]) & (o < here[g]))
            g = g[better]
            here[g], best[g], at[g] = o[better], d[better], 0
            going = going[at[going] < many]
        return here.reshape(n, parts), best.reshape(n, parts)


def _vectors(column: pa.Array, width: int) -> np.ndarray:
    """Scaled integers (vectors, PARTS, components) of a list column."""
    x = np.floor(column.flatten().to_numpy(zero_copy_only=False).astype(np.float64) * SCALE)
    if len(x) and np.abs(x).max() >= BOUND:
        raise ValueError(f"components of {BOUND // SCALE} or more are refused: their squared distances wouldn't fit a long")
    return x.astype(np.int64).reshape(-1, PARTS, width)


def compress(spark: SparkSession, vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label") -> DataFrame:
    """vectors -> (vec_id, label, code, error, label_error, codebooks_sha256).

    code: two hex digits for each part's entry; error: squared distance to the entries, over all parts;
    label_error: error summed over rows of the same label, nulls together.
    A vector that is null, holds null or non-finite components or has another length than the first kept
    one is dropped; a first length that PARTS doesn't divide is refused, and so are components of BOUND /
    SCALE or more. Codebooks start as the first rows by vec_id (nulls last), then by vector; with fewer rows than
    ENTRIES they are smaller. Repeated rows stay and count as often as they stand. An empty table, or one
    without kept vectors, gives no rows. Other columns are ignored, so their names can't clash.
    """
    ship(spark)
    rows = vectors.select(F.col(vec_id).alias("vec_id"), F.col(embedding).cast("array<double>").alias("x"), F.col(label).alias("label"))
    rows = rows.where(F.col("x").isNotNull() & ~F.exists("x", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf"))))
    kinds = dict(rows.dtypes)
    out = f"vec_id {kinds['vec_id']}, label {kinds['label']}, code string, error long"
    leader = rows.orderBy(F.asc_nulls_last("vec_id"), "x").limit(1).collect()
    if not leader:
        return spark.createDataFrame([], f"{out}, label_error long, codebooks_sha256 string")
    size = len(leader[0]["x"])
    if size % PARTS:
        raise ValueError(f"vectors of {size} components can't be cut into {PARTS} equal parts")
    width = size // PARTS
    rows = rows.where(F.size("x") == size)
    first = pa.array([r["x"] for r in rows.orderBy(F.asc_nulls_last("vec_id"), "x").limit(ENTRIES).collect()], pa.list_(pa.float64()))
    entries = np.ascontiguousarray(_vectors(first, width).transpose(1, 0, 2))

    def searched(batches: Iterator[pa.RecordBatch], books: Codebooks):
        for batch in batches:
            for at in range(0, len(batch), SEARCHES // PARTS):
                part = batch.slice(at, SEARCHES // PARTS)
                x = _vectors(part.column("x"), width)
                yield (part, x, *books.search(x))

    for _ in range(ROUNDS):
        shared = spark.sparkContext.broadcast(entries)

        def sums(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            books = Codebooks(shared.value)
            total, count = np.zeros_like(books.entries), np.zeros(books.entries.shape[:2], np.int64)
            for _, x, at, _ in searched(batches, books):
                for k in range(PARTS):
                    np.add.at(total[k], at[:, k], x[:, k])
                    count[k] += np.bincount(at[:, k], minlength=count.shape[1])
            k, e = np.nonzero(count)
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(k, width)), pa.array(np.repeat(e, width)), pa.array(np.tile(np.arange(width), len(k))), pa.array(np.repeat(count[k, e], width)), pa.array(total[k, e].ravel())], names=["part", "entry", "place", "n", "total"])

        added = rows.select("x").mapInArrow(sums, "part long, entry long, place long, n long, total long").groupBy("part", "entry", "place").agg(F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
        entries = entries.copy()
        for r in added.collect():  # at most PARTS * ENTRIES * width rows
            entries[r["part"], r["entry"], r["place"]] = int(r["total"]) // r["n"]

    shared = spark.sparkContext.broadcast(entries)

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, _, at, far in searched(batches, Codebooks(shared.value)):
            digits = at.astype(np.uint8).tobytes().hex()
            code = [digits[i : i + 2 * PARTS] for i in range(0, len(digits), 2 * PARTS)]
            yield pa.RecordBatch.from_arrays([part.column("vec_id"), part.column("label"), pa.array(code, pa.string()), pa.array(far.sum(1))], names=["vec_id", "label", "code", "error"])

    store = Store(spark, "vectorcodes")
    codes = store.keep(rows.select("vec_id", "label", "x").mapInArrow(coded, out), "codes")
    by_label = codes.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error"))
    digest = hashlib.sha256(",".join(map(str, entries.ravel().tolist())).encode()).hexdigest()
    return codes.join(sized(by_label), F.col("label").eqNullSafe(F.col("of"))).select("vec_id", "label", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))
