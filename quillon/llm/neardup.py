"""Near-duplicate documents by a chosen-path set similarity join.

Every text becomes its set of distinct five-word shingles (A-Z lowered). Equal sets are one class.
Between classes, independent trees branch each class by selected minwise tokens: a node is a path of
(position, minimum) choices, and classes that share a path meet in it. Small nodes are compared
exhaustively. Large ones are first compared in blocks, which joins what is alike throughout, and
branch again as long as they hold several components; a node whose members are connected already can
add nothing, so a group of any size costs its members and not its pairs. After MOST_LEVELS levels what
is left is compared block by block, exhaustively. Trees come in turns, and each turn sees the
components that the ones before have found.

Only (node, id) rows go through the trees. A comparison screens by a sketch that can't err: the parities
of a set's hashes in buckets; parities that differ are elements that the sets don't share. What the
screen leaves is confirmed or refused on the full shingle sets of both texts.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillon.llm import _text as T
from quillon.llm._ship import ship
from quillon.llm._store import Store, sized

#: Trees by turn, and branches of a class at each root. A pair at 0.85 meets at one of the twelve with all but 1e-10.
TURNS, ROOT_BRANCHES = (2, 4), 2
ROOTS = sum(TURNS) * ROOT_BRANCHES
#: Minwise positions that nodes below the roots branch on, a byte each.
POSITIONS = 128
#: A node of at most so many classes and, unless it has very few classes, so many shingles is compared exhaustively.
LEAF, LEAF_SHINGLES, FEW = 2048, 1 << 24, 64
#: Levels of a tree before the exhaustive finish.
MOST_LEVELS = 32
#: Bits of a parity sketch: the power of two from two bits a shingle, within these.
LEAST_BITS, MOST_BITS = 512, 1 << 20

_rng = np.random.default_rng(20240229)
_A = (_rng.integers(0, 1 << 32, POSITIONS, dtype=np.uint32) | np.uint32(1)).astype(np.uint32)
_B = _rng.integers(0, 1 << 32, POSITIONS, dtype=np.uint32).astype(np.uint32)
_RA = _rng.integers(0, 1 << 63, ROOTS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_RB = _rng.integers(0, 1 << 63, ROOTS, dtype=np.uint64)


def parities(u: np.ndarray) -> np.ndarray:
    """The parity sketch of a set of hashes, as bytes; halves of a sketch combine to that of half the bits by exclusive or."""
    bits = min(max(LEAST_BITS, 1 << max(2 * len(u) - 1, 1).bit_length()), MOST_BITS)
    at = (T.mix(u ^ np.uint64(0x94D049BB133111EB)) & np.uint64(bits - 1)).astype(np.int64)
    return np.packbits((np.bincount(at, minlength=bits) & 1).astype(np.uint8), bitorder="little")


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a, b, buf, rows in T.steps(batch.column("text")):
            u, first = T.distinct(*T.shingles(buf, rows))
            n = np.diff(first)
            full = np.flatnonzero(n)
            k1, k2 = np.zeros(b - a, np.uint64), np.zeros(b - a, np.uint64)
            roots, low = np.zeros((b - a, ROOTS), np.uint64), np.zeros((b - a, POSITIONS), np.uint8)
            if len(full):
                at = first[:-1][full]
                k1[full] = np.add.reduceat(T.mix(u + np.uint64(1)), at)
                k2[full] = np.add.reduceat(T.mix(u ^ np.uint64(0xC2B2AE3D27D4EB4F)), at)
                for i in range(ROOTS):
                    roots[full, i] = T.mix(np.minimum.reduceat(u * _RA[i] + _RB[i], at) + np.uint64(i))
                x = (u >> np.uint64(32)).astype(np.uint32)
                for i in range(POSITIONS):
                    low[full, i] = np.minimum.reduceat(x * _A[i] + _B[i], at) & np.uint32(255)
            odd = [parities(u[first[r] : first[r + 1]]).tobytes() if n[r] else b"" for r in range(b - a)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").slice(a, b - a), pa.array(n.astype(np.int64)), pa.array(k1.view(np.int64)), pa.array(k2.view(np.int64)), pa.array([r.tobytes() for r in roots], pa.binary()), pa.array([r.tobytes() for r in low], pa.binary()), pa.array(odd, pa.binary())],
                names=["doc_id", "n", "k1", "k2", "roots", "low", "odd"],
            )


def signatures(docs: DataFrame) -> DataFrame:
    """(doc_id, n, k1, k2, roots, low, odd): set size, a 128-bit hash of the set, its minima at the roots and below them, its parities."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(_sign, "doc_id long, n long, k1 long, k2 long, roots binary, low binary, odd binary")


def _matrix(column: pa.Array, kind: type) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(len(column), -1)


def _at_roots(first: int, last: int):
    """Rows (node, id, n) of the branches first to last."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                node = _matrix(batch.column("roots"), np.int64)[:, first:last]
                take = pa.array(np.repeat(np.arange(batch.num_rows), last - first))
                yield pa.RecordBatch.from_arrays([pa.array(node.ravel()), batch.column("id").take(take), batch.column("n").take(take)], names=["node", "id", "n"])

    return run


def _branch(branches: float):
    """Rows (node, id, n) of the children: each node goes on at one position, or at two with the chance that gives branches on average."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            node, low = batch.column("node").to_numpy(zero_copy_only=False).view(np.uint64), _matrix(batch.column("low"), np.uint8)
            h = T.mix(node ^ np.uint64(0xA24BAED4963EE407))
            one = (h % np.uint64(POSITIONS)).astype(np.int64)
            two = (one + 1 + ((h >> np.uint64(8)) % np.uint64(POSITIONS - 1)).astype(np.int64)) % POSITIONS
            both = np.flatnonzero((h >> np.uint64(24)).astype(np.float64) < (branches - 1) * 2.0**40)
            row = np.concatenate([np.arange(len(node)), both])
            at = np.concatenate([one, two[both]])
            child = T.mix(T.mix(node[row] + at.astype(np.uint64)) + low[row, at].astype(np.uint64))
            take = pa.array(row)
            yield pa.RecordBatch.from_arrays([pa.array(child.view(np.int64)), batch.column("id").take(take), batch.column("n").take(take)], names=["node", "id", "n"])

    return run


def _groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.RecordBatch]:
    """The groups of equal key of batches that are sorted by it, each in one piece."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(key).to_numpy(zero_copy_only=False)
        ends = [*(np.flatnonzero(keys[1:] != keys[:-1]) + 1), len(keys)]
        if held and held[0].column(key)[0].as_py() != keys[0]:
            yield pa.concat_batches(held)
            held = []
        for a, b in zip([0, *ends[:-1]], ends, strict=True):
            if b < len(keys):
                yield pa.concat_batches([*held, batch.slice(a, b - a)])
                held = []
            else:
                held.append(batch.slice(a))
    if held:
        yield pa.concat_batches(held)


def candidates(n: np.ndarray, odd: list[bytes], num: int, den: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(i, js, distances): the pairs of sets of these sizes and parities that can be as near as num / den.

    A distance is the count of parities that differ, so the sets differ in as many elements or more.
    """
    by = np.argsort(n, kind="stable")
    size = n[by].astype(np.int64)
    words = np.array([len(odd[r]) // 8 for r in by])
    tables: dict[int, tuple[int, np.ndarray]] = {}  # words of a sketch -> first row from which it is tabled, its table
    for w in np.unique(words):
        rows = np.flatnonzero((words == w) | (words == 2 * w))
        table = np.zeros((len(rows), w), np.uint64)
        for k, r in enumerate(rows):
            x = np.frombuffer(odd[by[r]], np.uint64)
            table[k] = x if len(x) == w else x[:w] ^ x[w:]
        tables[w] = (rows[0], table)
    # sets that differ in size by more than the threshold allows can't be near, and sketches of near sets differ by one halving at most
    last = np.searchsorted(size * num, size * den, "right")
    for i in range(len(by) - 1):
        first, table = tables[words[i]]
        a, b = i + 1 - first, min(last[i], first + len(table)) - first
        if a < b:
            d = np.bitwise_count(table[a:b] ^ table[i - first]).sum(axis=1, dtype=np.int64)
            js = np.flatnonzero((den - num) * (size[i] + size[i + 1 : i + 1 + b - a]) >= (den + num) * d)
            if len(js):
                yield by[i], by[i + 1 + js], d[js]


def _screen(num: int, den: int):
    """(leaf, id) of the members of each leaf that can be near to one of another component."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches, "leaf"):
            comp = group.column("comp").to_numpy()
            if group.num_rows < 2 or (comp == comp[0]).all():
                continue
            some = np.zeros(group.num_rows, bool)
            for i, js, _ in candidates(group.column("n").to_numpy(), group.column("odd").to_pylist(), num, den):
                js = js[comp[js] != comp[i]]
                some[js] = True
                some[i] |= len(js) > 0
            if some.any():
                yield group.select(["leaf", "id", "comp"]).filter(pa.array(some))

    return run


def _root(parent: dict[int, int], x: int) -> int:
    while (p := parent.setdefault(x, x)) != x:
        parent[x] = x = parent.setdefault(p, p)
    return x


def _confirm(num: int, den: int):
    """Edges (a, b) between the components of each leaf that an exact comparison of its sets joins, nearest sketches first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches, "leaf"):
            sets = [T.shingle_set(t) for t in group.column("text").to_pylist()]
            comp, ids = group.column("comp").to_pylist(), group.column("id").to_pylist()
            n = np.array([len(s) for s in sets])
            pairs = sorted((int(d), i, int(j)) for i, js, ds in candidates(n, [parities(s).tobytes() for s in sets], num, den) for j, d in zip(js, ds, strict=True) if comp[i] != comp[j])
            parent: dict[int, int] = {}
            edges = []
            for _, i, j in pairs:
                p, q = _root(parent, comp[i]), _root(parent, comp[j])
                if p != q:
                    both = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
                    if both and den * both >= num * (n[i] + n[j] - both):
                        parent[max(p, q)] = min(p, q)
                        edges.append((ids[i], ids[j]))
            if edges:
                yield pa.RecordBatch.from_arrays([pa.array([e[k] for e in edges], pa.int64()) for k in (0, 1)], names=["a", "b"])

    return run


def components(store: Store, edges: DataFrame) -> DataFrame:
    """(id, comp) of every id on an edge (a, b): comp is the smallest id that edges lead to.

    Each round takes the smallest label among neighbours and then that label's own label, so long
    chains need few rounds. Hot ids only meet in partial minima and joins that Spark can split.
    """
    n = 2 * edges.count()
    both = store.keep(edges.select("a", "b").union(edges.select("b", "a")).toDF("id", "other"), "arcs", n)
    label = store.keep(both.groupBy("id").agg(F.least(F.col("id"), F.min("other")).alias("comp")), "label", n)
    while True:
        of = label.select(F.col("id").alias("other"), F.col("comp").alias("near"))
        step = both.join(of, "other").groupBy("id").agg(F.min("near").alias("near")).join(label, "id").select("id", F.least("near", "comp").alias("mid"), F.col("comp").alias("old"))
        jump = label.select(F.col("id").alias("mid"), F.col("comp").alias("far"))
        new = store.keep(step.join(jump, "mid", "left").select("id", F.least("mid", F.coalesce("far", "mid")).alias("comp"), "old"), "label", n)
        moved = not new.where("comp <> old").isEmpty()
        store.drop(label)
        if not moved:
            store.drop(both)
            return new
        label = new


def _with_comp(rows: DataFrame, label: DataFrame | None) -> DataFrame:
    if label is None:
        return rows.withColumn("comp", F.col("id"))
    return rows.join(label.select("id", "comp"), "id", "left").withColumn("comp", F.coalesce("comp", "id"))


def _merge(store: Store, label: DataFrame | None, edges: DataFrame) -> DataFrame:
    """The components after edges: these join the components that label knows."""
    if label is None:
        return components(store, edges)
    ends = _with_comp(_with_comp(edges.withColumnRenamed("a", "id"), label).select(F.col("comp").alias("a"), F.col("b").alias("id")), label)
    ends = store.keep(ends.select("a", F.col("comp").alias("b")).where("a <> b").distinct(), "ends", edges.count())
    moved = components(store, ends)
    new = label.select("id", "comp").join(moved.select(F.col("id").alias("comp"), F.col("comp").alias("to")), "comp", "left").select("id", F.coalesce("to", "comp").alias("comp"))
    out = store.keep(new.union(moved.select("id", "comp").join(label.select("id"), "id", "left_anti")), "label", label.count() + moved.count())
    store.drop(label, moved, ends)
    return out


def _meeting(store: Store, rows: DataFrame, n: int, label: DataFrame | None) -> DataFrame:
    """(node, id, comp, size, weight) of the nodes in which several components meet; of nodes with the same members one stays."""
    rows = _with_comp(rows, label)
    part = [F.sum(F.pmod(F.xxhash64("id", F.lit(k)), F.lit(1 << 31))).alias(f"s{k}") for k in range(3)]
    stats = rows.groupBy("node").agg(F.count("*").alias("size"), F.sum("n").alias("weight"), F.min("comp").alias("lo"), F.max("comp").alias("hi"), *part).where("lo < hi")
    stats = store.keep(stats.groupBy("size", "s0", "s1", "s2").agg(F.min("node").alias("node"), F.max("weight").alias("weight")).select("node", "size", "weight"), "nodes", n)
    out = store.keep(rows.join(stats, "node").select("node", "id", "n", "comp", "size", "weight"), "meeting", n)
    store.drop(stats)
    return out


def _large() -> Column:
    return (F.col("size") > LEAF) | ((F.col("weight") > LEAF_SHINGLES) & (F.col("size") > FEW))


def _leaves(met: DataFrame, finish: bool) -> DataFrame:
    """(leaf, id, comp): small nodes as they are and large ones in blocks, at the finish in every pair of blocks."""
    blocks = F.ceil(2 * F.greatest(F.col("size") / LEAF, F.col("weight") / LEAF_SHINGLES)).cast("long")
    block = F.pmod(F.xxhash64("id", "node"), blocks)
    small = met.where(~_large()).select(F.col("node").alias("leaf"), "id", "comp")
    large = met.where(_large())
    if finish:
        other = large.select("node", "id", "comp", block.alias("i"), F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)).alias("j")).where("i <> j")
        return small.union(other.select(F.xxhash64("node", F.least("i", "j"), F.greatest("i", "j")).alias("leaf"), "id", "comp"))
    return small.union(large.select(F.xxhash64("node", block).alias("leaf"), "id", "comp"))


def _links(store: Store, leaves: DataFrame, n: int, odd: DataFrame, text_of: Callable[[DataFrame], DataFrame], num: int, den: int) -> DataFrame | None:
    """Edges between components that the n rows of leaves show, or None."""

    def by_leaf(rows: DataFrame, n: int) -> DataFrame:
        return rows.repartition("leaf").sortWithinPartitions("leaf").coalesce(store.tasks(n, 20_000))

    screened = by_leaf(leaves.join(odd, "id").select("leaf", "id", "comp", "n", "odd"), n)
    screened = store.keep(screened.mapInArrow(_screen(num, den), "leaf long, id long, comp long"), "screened")
    edges = None
    if m := screened.count():
        text = text_of(screened.select("id"), m)
        full = by_leaf(screened.join(text, "id").select("leaf", "id", "comp", "text"), m)
        edges = store.keep(full.mapInArrow(_confirm(num, den), "a long, b long"), "edges")
        store.drop(text)
    store.drop(screened)
    return None if edges is None or edges.isEmpty() else edges


def near_duplicates(spark: SparkSession, docs: DataFrame, num: int = 85, den: int = 100) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row of docs(doc_id, text, ...).

    Links: den * |intersection| >= num * |union| of the shingle sets, confirmed on the full sets.
    component_id is the smallest doc_id reachable; kept marks that document. Null, empty or
    blank texts have no shingles and are linked with nothing. Texts of one to four words are one
    shingle. Rows that repeat a doc_id count as one node with that id, whatever their texts. A null
    doc_id can't be named as anyone's component: its row comes back with null component_id and
    kept = false. Other columns, whatever their names, are ignored. An empty table gives no rows.
    Thresholds from a half on.
    """
    if not den <= 2 * num <= 2 * den:
        raise ValueError("the similarity must be from a half to one")
    ship(spark)
    store = Store(spark, "neardup")
    base = store.keep(signatures(docs), "signatures")
    n = base.count()
    named = base.where("n > 0 AND doc_id IS NOT NULL")
    classes = store.keep(named.groupBy("k1", "k2").agg(F.min("doc_id").alias("id"), *(F.first(c).alias(c) for c in ("n", "roots", "low", "odd"))), "classes", n, 50_000)
    members = base.select("doc_id", "n", "k1", "k2").join(classes.select("k1", "k2", "id"), ["k1", "k2"], "left").select("doc_id", "n", F.when(F.col("n") > 0, F.col("id")).otherwise(F.col("doc_id")).alias("id"))
    members = store.keep(members, "members", n)
    store.drop(base)
    # a doc_id that stands with several texts links their classes
    several = members.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min("id").alias("a"), F.max("id").alias("b")).where("a < b").select("doc_id", "a")
    several = store.keep(several, "several", n)
    label = None
    if not several.isEmpty():
        label = _merge(store, None, store.keep(members.join(several, "doc_id").select("a", F.col("id").alias("b")).where("a < b").distinct(), "edges", n))

    def text_of(ids: DataFrame, n: int) -> DataFrame:
        rows = docs.select(F.col("doc_id").cast("long").alias("id"), F.col("text").cast("string").alias("text")).join(sized(ids), "id", "left_semi")
        return store.keep(rows.groupBy("id", F.xxhash64("text")).agg(F.first("text").alias("text")).select("id", "text"), "text", n, 20_000)

    first, count = 0, classes.count()
    for trees in TURNS:
        last = first + trees * ROOT_BRANCHES
        rows, m = classes.select("id", "n", "roots").mapInArrow(_at_roots(first, last), "node long, id long, n long"), count * (last - first)
        for level in range(MOST_LEVELS + 1):
            met = _meeting(store, rows, m, label)
            leaves = _leaves(met, level == MOST_LEVELS)
            edges = _links(store, leaves, leaves.count(), classes.select("id", "n", "odd"), text_of, num, den)
            if edges is not None:
                label = _merge(store, label, edges)
                store.drop(edges)
            rest = met.where(_large()).select("node", "id", "n")
            m = rest.count()
            if level == MOST_LEVELS or not m:
                store.drop(met)
                break
            rest = rest.join(classes.select("id", "low"), "id").select("node", "id", "n", "low").coalesce(store.tasks(m))
            rows = store.keep(rest.mapInArrow(_branch(min(den / num, 2.0)), "node long, id long, n long"), "rows")
            store.drop(met)
            m = rows.count()
        first = last

    out = members.select("doc_id", "n", "id").where("id IS NOT NULL")
    out = _with_comp(out, label).unionByName(members.where("id IS NULL").withColumn("comp", F.lit(None).cast("long")))
    comp = F.when(F.col("doc_id").isNotNull(), F.col("comp"))
    return store.finish(out.select("doc_id", F.col("n").alias("n_shingles"), comp.alias("component_id"), F.coalesce(comp == F.col("doc_id"), F.lit(False)).alias("kept")), rows=n)
