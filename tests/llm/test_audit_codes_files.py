"""Source divergence, vector codes and token-id files against brute force and on awkward rows."""

import hashlib
import random
import re
import struct
import zlib
from collections import Counter
from itertools import pairwise

import numpy as np
import pytest

from quillon.llm import divergence, queries, rans, vectorcodes
from quillon.llm._store import Store

CLASH = "doc_id long, text string, lang string, source string, term string, n long, df long, sid long, s long, v long, hash string, seq string, file string, block string, total string"


def _rows(texts):
    return [(i, t, lang, source, "t", 1, 2, 3, 4, 5, "h", "q", "f", "b", "z") for i, (t, lang, source) in enumerate(texts)]


def _audit(rows):
    """(lang, source, part, item) -> (value, rank) in plain Python."""
    docs = [(lang or "", source or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))) for text, lang, source in rows]
    out = {}
    for lang in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == lang]
        df = Counter(t for *_, w in own for t in set(w))
        kept = sorted(t for t, n in df.items() if n >= divergence.LEAST_DOCUMENTS)
        groups = {s: Counter(t for _, x, w in own if x == s for t in w if df[t] >= divergence.LEAST_DOCUMENTS) for _, s, _ in own}
        share = lambda c: {t: 1 + 10**9 * (c[t] + 1) // (sum(c.values()) + len(kept)) for t in kept}
        p = {s: share(c) for s, c in groups.items()}
        q = share(sum(groups.values(), Counter()))
        for s in groups:
            pairs = [(sum((p[s][t] - p[o][t]) ** 2 // p[o][t] for t in kept), o) for o in groups if o != s]
            terms = [((p[s][t] - q[t]) ** 2 // q[t], t) for t in kept if groups[s][t] and p[s][t] > q[t]]
            for part, found in (("pair", pairs), ("term", terms)):
                for rank, (value, item) in enumerate(sorted(found, key=lambda x: (-x[0], x[1].encode())), 1):
                    if part == "pair" or rank <= divergence.TOP_TERMS:
                        out[lang, s, part, item] = (value, rank)
    return out


@pytest.mark.parametrize("block, tile, pairs", [(2048, 32, 256), (8, 2, 3)])
def test_divergence_equals_brute_force(spark, monkeypatch, block, tile, pairs):
    """Whole languages in one block and many small blocks, tiles and steps; nulls, '' and repeated rows; a language without kept terms; groups without terms."""
    for name, value in (("BLOCK", block), ("TILE", tile), ("PAIRS", pairs)):
        monkeypatch.setattr(divergence, name, value)
    r = random.Random(3)
    words = [f"{a}{b}" for a in "äßfgKLé日" for b in "aeiouxyz"]
    texts = [(" ".join(r.choices(words, range(1, len(words) + 1), k=r.randrange(60))) + r.choice(["", " 12 x_y", "\n---"]), r.choice(["en", "de", None]), r.choice(["a", "b", "c", "d", "é", "z", None])) for _ in range(80)]
    texts += texts[:5] + [(None, "en", "silent"), ("12 34", "en", "figures"), ("uno dos", "xx", "one"), ("tres", "xx", "two"), (None, "yy", None)]
    got = divergence.audit(spark, spark.createDataFrame(_rows(texts), CLASH)).collect()
    assert {(x["lang"], x["source"], x["part"], x["item"]): (x["value"], x["rank"]) for x in got} == _audit(texts) and len(got) == len(_audit(texts))
    assert divergence.audit(spark, spark.createDataFrame([], CLASH)).count() == 0


def test_equal_node_pairs_are_priced_once(monkeypatch):
    """Sources with the same counts everywhere meet in one leaf pair, however many ids there are."""
    seen = []
    plain = divergence.shares
    monkeypatch.setattr(divergence, "shares", lambda c, n: seen.append(len(c)) or plain(c, n))
    counts = np.tile(np.array([[1, 0], [0, 3]]), (1, 512))
    there, back = divergence.pair_prices(counts, np.array([2000, 3000]), np.array([0]), np.array([1]))
    assert seen == [2, 2]
    f = lambda p, q: (p - q) ** 2 // q
    share = lambda c, n: 1 + 10**9 * (c + 1) // n
    assert there[0] == 512 * (f(share(1, 2000), share(0, 3000)) + f(share(0, 2000), share(3, 3000)))
    assert back[0] == 512 * (f(share(0, 3000), share(1, 2000)) + f(share(3, 3000), share(0, 2000)))


def test_shares_are_exact_for_large_counts():
    count = np.array([0, 10**15, 9 * 10**14 + 7, 2**52], np.int64)
    total = np.array([2**53 - 1, 10**15 + 1, 10**15 + 9, 2**53 - 3], np.int64)
    assert divergence.shares(count, total).tolist() == [1 + 10**9 * (int(c) + 1) // int(n) for c, n in zip(count, total, strict=True)]


def _codes(rows):
    """(vec_id, label) -> (code, error) in plain Python, and the codebooks' digest."""
    kept = sorted([(i, [int(np.floor(256 * x)) for x in v], label) for i, v, label in rows if v is not None and len(v) == 32 and all(x is not None and np.isfinite(x) for x in v)], key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    cut = lambda v: [v[2 * k : 2 * k + 2] for k in range(16)]
    books = [[cut(v)[k] for _, v, _ in kept[:64]] for k in range(16)]
    near = lambda x, k: min((sum((a - b) ** 2 for a, b in zip(x, e, strict=True)), j) for j, e in enumerate(books[k]))
    for _ in range(2):
        found = [[near(x, k)[1] for k, x in enumerate(cut(v))] for _, v, _ in kept]
        for k in range(16):
            for j in range(len(books[k])):
                own = [cut(v)[k] for (_, v, _), at in zip(kept, found, strict=True) if at[k] == j]
                if own:
                    books[k][j] = [sum(x) // len(own) for x in zip(*own, strict=True)]
    best = [(i, label, [near(x, k) for k, x in enumerate(cut(v))]) for i, v, label in kept]
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return sorted((str(i), str(label), "".join(f"{j:02x}" for _, j in n), sum(d for d, _ in n)) for i, label, n in best), digest


def test_vector_codes_equal_brute_force(spark):
    """Ties among equal entries, repeated rows and ids, nulls everywhere, other lengths, and clashing columns."""
    r = random.Random(6)
    common = [r.randrange(-3, 4) / 256 for _ in range(32)]
    rows = [(i, [r.randrange(-9, 9) / 64 + r.choice([0, 0.001]) for _ in range(32)], r.choice([1, 2, None])) for i in range(150)]
    rows += [(200 + i, common, 7) for i in range(60)] + [(-5, common, 1), (-5, common, 1), (-4, common, 2), (None, rows[0][1], None)]
    rows += [(900, None, 1), (901, [None] * 32, 1), (902, [float("nan")] * 32, 1), (903, [float("inf")] * 32, 1), (904, [], 1), (905, [1.0] * 16, 1)]
    df = spark.createDataFrame([(*x, "p", "e", "c") for x in rows], "vec_id long, embedding array<float>, label int, part string, error string, code string")
    want, digest = _codes([(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v], label) for i, v, label in rows])
    got = vectorcodes.compress(spark, df).collect()
    assert sorted((str(x["vec_id"]), str(x["label"]), x["code"], x["error"]) for x in got) == want
    assert {x["codebooks_sha256"] for x in got} == {digest}
    total = Counter()
    for x in got:
        total[x["label"]] += x["error"]
    assert all(x["label_error"] == total[x["label"]] for x in got)


def test_vector_codes_of_few_and_no_rows(spark):
    kind = "vec_id long, embedding array<double>, label string"
    assert vectorcodes.compress(spark, spark.createDataFrame([], kind)).count() == 0
    assert vectorcodes.compress(spark, spark.createDataFrame([(1, None, "a")], kind)).count() == 0
    got = vectorcodes.compress(spark, spark.createDataFrame([(1, [0.5] * 16, None), (2, [0.25] * 16, None)], kind)).collect()
    assert sorted((x["code"], x["error"], x["label_error"]) for x in got) == [("00" * 16, 0, 0), ("01" * 16, 0, 0)]
    for bad, message in (([1.0] * 15, "equal parts"), ([1e6] * 16, "refused")):
        with pytest.raises(Exception, match=message):
            vectorcodes.compress(spark, spark.createDataFrame([(1, bad, None)], kind)).collect()


def test_orchard_search_measures_few_entries(monkeypatch):
    """The nearest entry is exact although most entries aren't measured."""
    r = np.random.default_rng(0)
    books = vectorcodes.Codebooks(r.integers(-1000, 1000, (2, 64, 3)))
    x = books.entries[np.arange(2), r.integers(0, 64, (500, 2))] + r.integers(-20, 20, (500, 2, 3))
    at, far = books.search(x)
    gap = ((x[:, :, None, :] - books.entries[None]) ** 2).sum(-1)
    assert (at == gap.argmin(2)).all() and (far == gap.min(2)).all()


def _library():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(queries.tokenizer_path(queries.BYTE_TOKENIZER))
    t.no_padding(), t.no_truncation()
    return t


def test_token_files_equal_the_library(spark, sf):
    t, start = _library(), 0
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = {r["doc_id"]: r for r in queries.op13_token_files(spark, sf).collect()}
    assert set(got) == set(docs)
    for i in sorted(docs):
        ids = [*t.encode(docs[i] or "", add_special_tokens=False).ids, 0]
        assert (got[i]["start"], got[i]["n_tokens"], got[i]["ids_crc32"]) == (start, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids)))
        start += len(ids)


def test_pieces_give_the_texts_ids():
    """Cut texts against the library on whole ones: spaces of all kinds, marks, contractions, special tokens, other scripts; also when little is remembered."""
    t, r = _library(), random.Random(8)
    bits = ["a", "I'm", "don't", " ", "  ", "\n", "\t", " \n ", "the", "The", "'s", "12", "3rd", "é", "日本", "ß", " ", " ", "<|endoftext|>", " <|endoftext|> x", "x" * 50, "!", "...", "_", "́", "😀", "\x00", "{", "~"]
    texts = ["".join(r.choice(bits) + r.choice(["", " "]) for _ in range(r.randrange(30))) for _ in range(3000)] + ["", " ", "a", " a", "a ", "a b", "word " * 3000]
    raw = [x.encode() for x in texts]
    buf, rows = np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0] + [len(x) for x in raw])
    want = [[*t.encode(x, add_special_tokens=False).ids, 0] for x in texts]
    for most in (rans.PIECES, 50):
        e = rans.Encoder(queries.tokenizer_path(queries.BYTE_TOKENIZER))
        old, rans.PIECES = rans.PIECES, most
        try:
            for at in range(0, len(texts), 500):
                part = rows[at : at + 501]
                ids, bounds = e.encode(buf[part[0] : part[-1]], part - part[0])
                assert [ids[a:b].tolist() for a, b in pairwise(bounds)] == want[at : at + 500]
        finally:
            rans.PIECES = old


@pytest.mark.parametrize("sizes", [[1], [63, 64, 65], [5000, 1, 100_000]])
def test_frames_round_trip_and_damage_is_seen(sizes):
    r = np.random.default_rng(sum(sizes))
    parts = [np.minimum(r.geometric(0.01, n) - 1, 49_999).astype(np.uint32) for n in sizes]
    counts = Counter(np.concatenate(parts).tolist())
    ids, freq, bits = rans.Table.scaled(counts)
    assert freq.sum() == 1 << bits and freq.min() >= 1 and set(ids) == set(counts)
    table = rans.Table(ids, freq, bits)
    for x in [*parts, np.zeros(0, np.uint32)]:
        frame = table.encode(x)
        assert (table.decode(frame) == x).all()
        for at in (0, len(frame) // 2, len(frame) - 1):
            bad = bytearray(frame)
            bad[at] ^= 1
            with pytest.raises(ValueError):
                table.decode(bytes(bad))
    entropy = -sum(n * np.log2(n / sum(sizes)) for n in counts.values()) / 8
    if sum(sizes) > 100_000:
        assert sum(len(table.encode(x)) for x in parts) < 1.15 * entropy


def test_token_files_of_awkward_rows(spark, monkeypatch):
    """Null and repeated ids, null, empty, equal and long texts, clashing columns; small blocks; an empty table; a damaged file."""
    monkeypatch.setattr(rans, "BLOCK", 300)
    t = _library()
    texts = [(None, "null id"), (3, None), (3, "three"), (3, "three"), (3, "drei " * 200), (1, ""), (2, "x" * 100_000), (7, "a b c"), (5, "é 日本")]
    df = spark.createDataFrame([(i, x, "h", 1, 2, "f") for i, x in texts], "doc_id long, text string, hash string, seq long, first long, frame string")
    folder = Store(spark, "rans-test").root
    rans.write_files(spark, df, queries.tokenizer_path(queries.BYTE_TOKENIZER), folder)
    got = sorted(rans.read_documents(spark, folder).collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in got] == [None, 1, 2, 3, 3, 3, 3, 5, 7]
    assert [r["start"] for r in got] == [0, *np.cumsum([r["n_tokens"] for r in got])[:-1].tolist()]
    want = Counter((i, tuple([*t.encode(x or "", add_special_tokens=False).ids, 0])) for i, x in texts)
    assert Counter((r["doc_id"], tuple(r["ids"])) for r in got) == want
    again = rans.read_documents(spark, folder, digests=True).collect()
    assert Counter((r["doc_id"], r["ids_crc32"]) for r in again) == Counter((i, zlib.crc32(struct.pack(f"<{len(x)}I", *x))) for (i, x), n in want.items() for _ in range(n))
    assert rans.round_trip(spark, df.limit(0), queries.tokenizer_path(queries.BYTE_TOKENIZER)).count() == 0
    blocks = spark.read.parquet(f"{folder}/blocks")
    assert blocks.where("n_ids > 300").count() >= 2 and blocks.selectExpr("max(size(doc_ids)) AS n").first()["n"] > 1
    blocks.selectExpr("file", "block", "first", "n_ids", "doc_ids", "lengths", "unhex(replace(hex(frame), substring(hex(frame), -20, 4), 'ABCD')) AS frame").write.parquet(f"{folder}-bad/blocks")
    spark.read.parquet(f"{folder}/table").write.parquet(f"{folder}-bad/table")
    with pytest.raises(Exception, match="damaged frame"):
        rans.read_documents(spark, f"{folder}-bad").collect()
