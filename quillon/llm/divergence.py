"""Source divergence audit with hash-consed segment trees.

Spark counts terms by (lang, source), keeps a language's terms that stand in enough documents, and deals
each language's term ids into blocks of about BLOCK ids by a hash. In a block every source has a segment
tree over the ids, common ids first, whose leaves are counts. Trees are hash-consed level by level: equal
count subtrees, of one source or of several, are one node. Two trees are walked together from their
roots; on each level equal node pairs are merged and only their multiplicity is kept, so an equal pair
is opened, and at the leaves priced, once a block. The blocks' prices are summed by Spark.

A block's unit of work holds the sources of two tiles (TILE each), so its memory is bounded by
2 * TILE * BLOCK counts, whatever the number of sources, terms or documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillon.llm import _text as T
from quillon.llm._ship import ship
from quillon.llm._store import Store, sized

SCALE = 1_000_000_000
#: Documents of the language that a term must stand in; ranks of a group's terms that are returned.
LEAST_DOCUMENTS, TOP_TERMS = 3, 200
#: Term ids of a block (on average), sources of a tile, source pairs walked in one numpy step.
BLOCK, TILE, PAIRS = 2048, 32, 256

#: Bytes and rows of text that a task counts in one step; what it sends on is a row for each group and term of a step.
STEP, STEP_ROWS = 6 << 20, 8192

_IN_TERM = np.zeros(256, bool)
_IN_TERM[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, source, term, n, df) of each group and term of a step; a null term stands for the group itself."""
    for batch in batches:
        lang, source = (batch.column(c).fill_null("").dictionary_encode() for c in ("lang", "source"))
        many = max(1, len(source.dictionary))
        groups, group = np.unique(lang.indices.to_numpy().astype(np.int64) * many + source.indices.to_numpy(), return_inverse=True)
        for a, b, buf, rows in T.steps(batch.column("text"), STEP, STEP_ROWS):
            starts, ends, first = T.words(buf, rows, _IN_TERM)
            bounds = np.concatenate([[0], np.cumsum(ends - starts)])
            found = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(bounds), pa.py_buffer(T.LOWER[buf[_IN_TERM[buf]]])]).dictionary_encode()
            size = max(1, len(found.dictionary))
            # a term of a text once, with its times, and then a term of a group
            key, times = np.unique(np.repeat(np.arange(b - a), np.diff(first)) * size + found.indices.to_numpy(), return_counts=True)
            key, where = np.unique(group[a + key // size] * size + key % size, return_inverse=True)
            n, df = np.bincount(where, times, len(key)).astype(np.int64), np.bincount(where, minlength=len(key))
            own = np.unique(group[a:b])
            at, none = groups[np.concatenate([key // size, own])], np.zeros(len(own), np.int64)
            term = pa.concat_arrays([found.dictionary.take(pa.array(key % size)).cast(pa.string()), pa.nulls(len(own), pa.string())])
            yield pa.RecordBatch.from_arrays([lang.dictionary.take(pa.array(at // many)), source.dictionary.take(pa.array(at % many)), term, pa.array(np.concatenate([n, none])), pa.array(np.concatenate([df, none]))], names=["lang", "source", "term", "n", "df"])


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, df): occurrences in the group and rows of the group that have the term.

    Each group has a row with a null term besides.
    """
    rows = docs.select(*(F.col(c).cast("string").alias(c) for c in ("lang", "source", "text")))
    return rows.mapInArrow(_count, "lang string, source string, term string, n long, df long").groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("df").alias("df"))


def shares(count: np.ndarray, total: np.ndarray) -> np.ndarray:
    """1 + floor(SCALE * (count + 1) / total) for count < total < 2**53: long division, three digits a step."""
    digit, left = np.divmod(count + 1, total)
    for _ in range(3):
        more, left = np.divmod(left * 1000, total)
        digit = digit * 1000 + more
    return 1 + digit


def _grow(counts: np.ndarray) -> tuple[list[tuple[np.ndarray, np.ndarray]], np.ndarray, np.ndarray]:
    """The shared nodes of all rows' trees: (left, right) of each level's nodes from the leaves' parents up, the distinct counts, each row's root.

    counts: a power of two of columns; -1 where an id is missing.
    """
    values, nodes = np.unique(counts, return_inverse=True)
    nodes = nodes.reshape(counts.shape)
    levels = []
    while nodes.shape[1] > 1:
        left, right = nodes[:, 0::2], nodes[:, 1::2]
        many = int(nodes.max()) + 1
        keys, ids = np.unique(left * many + right, return_inverse=True)
        levels.append((keys // many, keys % many))
        nodes = ids.reshape(left.shape)
    return levels, values, nodes[:, 0]


def _merge(pair: np.ndarray, x: np.ndarray, y: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, ...]:
    """Equal (pair, x, y) once, with the sum of their multiplicities, in order of pair."""
    many = int(max(x.max(), y.max())) + 1
    key = (pair * many + x) * many + y
    order = np.argsort(key, kind="stable")
    key = key[order]
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    return pair[order][first], x[order][first], y[order][first], np.add.reduceat(times[order], first)


def pair_prices(counts: np.ndarray, totals: np.ndarray, a: np.ndarray, b: np.ndarray, step: int = PAIRS) -> tuple[np.ndarray, np.ndarray]:
    """For each pair of rows (a, b): the sums over columns of f(p of a, p of b) and of f(p of b, p of a).

    counts: rows by ids, -1 in columns that are no id; totals: each row's N + V.
    """
    levels, values, roots = _grow(counts)
    there, back = np.zeros(len(a), np.int64), np.zeros(len(a), np.int64)
    for at in range(0, len(a), step):
        i, j = a[at : at + step], b[at : at + step]
        pair, x, y, times = np.arange(len(i)), roots[i], roots[j], np.ones(len(i), np.int64)
        for left, right in reversed(levels):
            pair, x, y, times = _merge(np.concatenate([pair, pair]), np.concatenate([left[x], right[x]]), np.concatenate([left[y], right[y]]), np.concatenate([times, times]))
        real = values[x] >= 0
        pair, x, y, times = pair[real], x[real], y[real], times[real]
        if not len(pair):
            continue
        p, q = shares(values[x], totals[i][pair]), shares(values[y], totals[j][pair])
        square = (p - q) ** 2
        first = np.flatnonzero(np.concatenate([[True], pair[1:] != pair[:-1]]))
        there[at + pair[first]] = np.add.reduceat(square // q * times, first)
        back[at + pair[first]] = np.add.reduceat(square // p * times, first)
    return there, back


def _price(unit: pa.Table, tile: int, step: int) -> pa.Table:
    """One block and two tiles of so many sources: rows (lang, a, b, value) for both directions of each pair of sources."""
    lang, ta, tb = (unit.column(c)[0].as_py() for c in ("lang", "ta", "tb"))
    is_term = pc.is_valid(unit.column("term"))
    marks, terms = unit.filter(pc.invert(is_term)), unit.filter(is_term)
    sids, where = np.unique(marks.column("sid").to_numpy(), return_index=True)
    totals = marks.column("total").to_numpy()[where]
    codes = terms.column("term").combine_chunks().dictionary_encode() if len(terms) else None
    known = len(codes.dictionary) if codes is not None else 0
    width = marks.column("n")[0].as_py()  # terms of the block, those that none of these sources has too
    counts = np.full((len(sids), 1 << max(width - 1, 0).bit_length()), -1, np.int64)
    counts[:, :width] = 0
    if known:
        code = codes.indices.to_numpy()
        common = np.zeros(known, np.int64)
        common[code] = terms.column("total").to_numpy()
        place = np.empty(known, np.int64)
        place[np.argsort(-common, kind="stable")] = np.arange(known)
        counts[np.searchsorted(sids, terms.column("sid").to_numpy()), place[code]] = terms.column("n").to_numpy()
    rows = np.arange(len(sids))
    a, b = (x.ravel() for x in np.meshgrid(rows, rows, indexing="ij"))
    use = (a < b) if ta == tb else (sids[a] // tile == ta) & (sids[b] // tile == tb)
    a, b = a[use], b[use]
    there, back = pair_prices(counts, totals, a, b, step)
    return pa.table({"lang": pa.array([lang] * (2 * len(a)), pa.string()), "a": np.concatenate([sids[a], sids[b]]), "b": np.concatenate([sids[b], sids[a]]), "value": np.concatenate([there, back])}, schema=pa.schema([("lang", pa.string()), ("a", pa.int64()), ("b", pa.int64()), ("value", pa.int64())]))


def audit(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """docs(text, lang, source, ...) -> (lang, source, part, item, value, rank).

    Part `pair` prices each group against each other source of its language, all ranks; part `term` lists
    the terms that a group has more of than its language, up to rank TOP_TERMS. A term counts if it stands
    in LEAST_DOCUMENTS rows of the language.
    Null text, lang and source count as ''. Repeated rows count as often as they stand. A language with
    one source has no pairs; a group without terms has count 0 of every term; a language without kept
    terms gives its pairs value 0. Ties go by the item's bytes. An empty table gives no rows. Other
    columns are ignored, so their names can't clash. Values are exact up to 2**53 terms a language.
    """
    ship(spark)
    store = Store(spark, "divergence")
    counted = store.keep(term_counts(docs), "counts")
    by_term = Window.partitionBy("lang", "term")
    kept = counted.where("term IS NOT NULL").select("lang", "source", "term", "n", F.sum("df").over(by_term).alias("df"), F.sum("n").over(by_term).alias("all"), F.when(F.row_number().over(by_term.orderBy("source")) == 1, 1).otherwise(0).alias("lead"))
    kept = store.keep(kept.where(F.col("df") >= LEAST_DOCUMENTS).drop("df"), "kept")
    sums = kept.groupBy("lang", "source").agg(F.sum("n").alias("n"), F.sum("lead").alias("v"))
    by_lang = Window.partitionBy("lang")
    groups = counted.select("lang", "source").distinct().join(sums, ["lang", "source"], "left").na.fill(0, ["n", "v"])
    groups = groups.select("lang", "source", (F.row_number().over(by_lang.orderBy("source")) - 1).cast("long").alias("sid"), F.count("*").over(by_lang).alias("s"), F.sum("v").over(by_lang).alias("v"), "n", F.sum("n").over(by_lang).alias("lang_n"))
    groups = store.keep(groups, "groups")
    store.drop(counted)

    small = sized(groups)
    rows = kept.join(small.withColumnRenamed("n", "group_n"), ["lang", "source"])
    p, q = (f"1 + (cast({c} + 1 as decimal(19,0)) * cast({SCALE} as decimal(10,0))) div cast({n} + v as decimal(19,0))" for c, n in (("n", "group_n"), ("all", "lang_n")))
    over = rows.select("lang", "source", F.col("term").alias("item"), F.expr(p).alias("p"), F.expr(q).alias("q")).where("p > q")
    over = over.select("lang", "source", "item", F.expr("(p - q) * (p - q) div q").alias("value"))
    ranked = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    top = over.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= TOP_TERMS).select("lang", "source", F.lit("term").alias("part"), "item", "value", "rank")

    tile_size, step = TILE, PAIRS

    def price(unit: pa.Table) -> pa.Table:
        return _price(unit, tile_size, step)

    blocks = F.expr(f"greatest(1, ceil(v / {BLOCK}))").cast("long")
    tiles = F.explode(F.expr(f"sequence(0L, (s - 1) div {TILE})"))
    cells = rows.select("lang", F.pmod(F.xxhash64("term"), blocks).alias("block"), "sid", "term", "n", F.col("all").alias("total"), tiles.alias("u"))
    widths = rows.where("lead = 1").groupBy("lang", F.pmod(F.xxhash64("term"), blocks).alias("block")).agg(F.count("*").alias("width"))  # a row a block
    marks = groups.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1))).join(widths, ["lang", "block"], "left")
    marks = marks.select("lang", "block", "sid", F.lit(None).cast("string").alias("term"), F.coalesce("width", F.lit(0)).alias("n"), (F.col("n") + F.col("v")).alias("total"), tiles.alias("u"))
    tile = F.expr(f"sid div {TILE}")
    units = cells.unionByName(marks).select("lang", "block", F.least(tile, "u").alias("ta"), F.greatest(tile, "u").alias("tb"), "sid", "term", "n", "total")
    prices = units.groupBy("lang", "block", "ta", "tb").applyInArrow(price, "lang string, a long, b long, value long").groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    name = groups.select("lang", "sid", "source")
    pairs = prices.join(sized(name.select("lang", F.col("sid").alias("a"), "source")), ["lang", "a"]).join(sized(name.select("lang", F.col("sid").alias("b"), F.col("source").alias("item"))), ["lang", "b"])
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", "value", F.row_number().over(ranked).alias("rank"))
    return pairs.unionByName(top)
