"""Each operator against brute force, SQL or held-out rows, and on awkward rows."""

import hashlib
import re
import struct
import zlib
from collections import Counter

import pytest

from quillon.llm import bpe, chat, decontam, knnquality, langid, licenses, linedup, lmquality, neardup, queries, secrets

SQL = queries.oracle_sql()
DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double, comp long, line string"


@pytest.fixture(scope="module")
def documents(spark, sf):
    return {r["doc_id"]: r for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}


def _odd(spark):
    words = " ".join(f"w{i}" for i in range(300))
    texts = [None, "", " \n\t ", "one", words, words, "é ß 日本 " * 60, "x" * 200_000, "line one of five words\n" * 40]
    return spark.createDataFrame([(i, t, "en" if i % 2 else None, None if i == 3 else "s", None, None, 1, "l") for i, t in enumerate(texts)], DOCS)


@pytest.mark.parametrize("name", sorted(SQL))
def test_equals_sql(name, same):
    same(queries.queries()[name], SQL[name])


def test_language_on_held_out_rows(spark, sf, documents):
    rows = queries.op1_language_id(spark, sf).collect()
    assert {r["doc_id"] for r in rows} == set(documents)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) and 0 <= r["score"] <= 1 for r in rows)
    held = [r for r in rows if r["held_out"] and documents[r["doc_id"]]["lang"]]
    right = sum(r["lang_pred"] == documents[r["doc_id"]]["lang"] for r in held)
    assert right >= 0.9 * len(held), (right, len(held))


def test_bpe_equals_the_library(spark, sf, documents):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(queries.tokenizer_path())
    t.no_padding(), t.no_truncation()
    for r in queries.op3_bpe(spark, sf).collect():
        ids = t.encode(documents[r["doc_id"]]["text"] or "", add_special_tokens=False).ids
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(t.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_quality_base_rules(spark, sf, documents):
    for r in queries.op4_quality_rules(spark, sf).collect():
        text = documents[r["doc_id"]]["text"] or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        lines = Counter(x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x))
        grams = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
        repeat = {j for i in range(len(words) - 2) if grams[tuple(words[i : i + 3])] > 1 for j in range(i, i + 3)}
        want = (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), sum(n - 1 for n in lines.values()), len(repeat))
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == want
        assert r["base_failed"] == (len(words) < 50 or 100 * len(repeat) > 50 * len(words))
        assert not (r["base_failed"] and r["kept"])


def test_quality_classifier_on_held_out_rows(spark, sf):
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    held = [r for r in queries.op5_quality_classifier(spark, sf).collect() if r["held_out"] and labels.get(r["doc_id"]) is not None]
    assert sum(r["predicted"] == labels[r["doc_id"]] for r in held) >= 0.75 * len(held)


def test_base_secrets(spark, sf, documents):
    kinds = (("assign", re.compile(r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")), ("access", re.compile(r"AKIA[A-Z0-9]+")), ("hex", re.compile(r"[0-9a-f]+")))
    for r in queries.op6_secret_scan(spark, sf).collect():
        text, spans = documents[r["doc_id"]]["text"] or "", []
        for k, (kind, pattern) in enumerate(kinds):
            for m in pattern.finditer(text):
                if (len(m[2]) >= 12 if kind == "assign" else len(m[0]) >= (18 if kind == "access" else 16)):
                    spans.append((m.start(), k, f"{kind}:{m.start()}:{m.end()}"))
        count = Counter(k for _, k, _ in spans)
        assert (r["n_assign"], r["n_access"], r["n_hex"]) == (count[0], count[1], count[2])
        assert r["base_sha256"] == hashlib.sha256(",".join(x for *_, x in sorted(spans)).encode()).hexdigest()
        assert {x for *_, x in spans} <= set(r["spans"].split(","))


@pytest.mark.parametrize("rows", ["odd", "empty"])
def test_awkward_rows(spark, sf, rows):
    docs = _odd(spark) if rows == "odd" else _odd(spark).limit(0)
    n = docs.count()
    labels = spark.createDataFrame([(1, 0), (4, 1)], "doc_id long, quality int")
    bench = spark.createDataFrame([(0, None), (1, ""), (2, "w1 w2 w3 w4 w5 w6")], "item_id long, text string")
    assert langid.identify(spark, docs).count() == n
    got = neardup.near_duplicates(spark, docs).collect()
    assert len(got) == n
    if n:
        assert {r["doc_id"]: r["component_id"] for r in got}[5] == 4
    for df in (bpe.encode_digests(spark, docs, queries.tokenizer_path()), lmquality.judge(spark, docs), knnquality.classify(spark, docs, labels), secrets.find_secrets(spark, docs), licenses.scan_licenses(docs), linedup.drop_boilerplate(spark, docs)):
        assert len(df.collect()) == n
    assert {(r["doc_id"], r["item_id"]) for r in decontam.find_leaks(spark, docs, bench).collect()} == ({(4, 2), (5, 2)} if n else set())


def test_chat_round_trip_of_control_strings(spark):
    rows = spark.createDataFrame([(1, 0, None, None), (1, 1, "assistant", "<turn>\\l </turn>"), (1, 1, "assistant", "<turn>\\l </turn>"), (2, 0, "user", "")], "conv_id long, turn long, role string, text string")
    done = {r["conv_id"]: r for r in chat.format_conversations(rows).select("conv_id", chat.read_turns("formatted").alias("t"), chat.loss_text("segments").alias("loss")).collect()}
    assert [(t["role"], t["text"]) for t in done[1]["t"]] == [("", ""), *[("assistant", "<turn>\\l </turn>")] * 2]
    assert done[1]["loss"] == "<turn>\\l </turn>" * 2 and done[2]["loss"] == ""


def test_pipeline_keeps_each_group_once(spark, sf, documents):
    ids = [r["doc_id"] for r in queries.pipeline(spark, sf).collect()]
    assert len(ids) == len(set(ids)) and set(ids) <= set(documents)


def _near_pairs(sizes, seed=7):
    """(doc_id, text) of pairs that differ in one word: (s - 5) of s + 5 five-word shingles in common."""
    import random

    r = random.Random(seed)
    rows = []
    for s in sizes:
        words = [f"w{r.randrange(10**9)}" for _ in range(s + 4)]
        other = list(words)
        other[r.randrange(5, s - 1)] = f"w{r.randrange(10**9)}"
        rows += [(len(rows), " ".join(words)), (len(rows) + 1, " ".join(other))]
    return rows


def _brute_components(rows, num, den):
    sets = {i: {tuple(w[j : j + 5]) for j in range(len(w) - 4)} for i, t in rows for w in [t.split()]}
    comp = {i: i for i, _ in rows}
    for a in sets:
        for b in sets:
            if a < b and den * len(sets[a] & sets[b]) >= num * len(sets[a] | sets[b]):
                low, high = sorted((comp[a], comp[b]))
                comp = {i: low if c == high else c for i, c in comp.items()}
    return comp


def test_pipeline_links_near_copies_from_080(spark, sf):
    import corpus_pipeline

    rows = _near_pairs([s for s in range(40, 66) for _ in range(3)])
    comp = _brute_components(rows, 80, 100)
    assert sum(c != i for i, c in comp.items()) > sum(c != i for i, c in _brute_components(rows, 85, 100).items()) > 0
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    assert {r["doc_id"] for r in corpus_pipeline.near(spark, docs, sf).collect()} == {i for i, c in comp.items() if c == i}


def test_near_recall_at_the_threshold(spark):
    """Of thousands of pairs from 0.85 to 0.9 at least 99 in 100 are found; in fact all but 1 in 1e9 should be."""
    rows = _near_pairs([62, 70, 80, 90] * 1000, seed=11)  # 57 of 67 shingles in common and more
    got = {r["doc_id"]: r["component_id"] for r in neardup.near_duplicates(spark, spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    found = sum(got[i + 1] == i for i in range(0, len(rows), 2))
    assert all(got[i] == i for i in range(0, len(rows), 2)) and found >= 0.99 * len(rows) / 2


def _copies(n, words, seed, edits):
    """n texts, each of the same words but for up to so many of them."""
    import random

    r = random.Random(seed)
    base = [f"b{r.randrange(10**9)}" for _ in range(words)]
    out = []
    for _ in range(n):
        t = list(base)
        for _ in range(r.randrange(edits + 1)):
            t[r.randrange(words)] = f"e{r.randrange(10**9)}"
        out.append(" ".join(t))
    return out


@pytest.mark.parametrize("leaf, levels", [(2048, 32), (16, 2), (16, 0)])
def test_near_groups_in_leaves_blocks_and_at_the_finish(spark, monkeypatch, leaf, levels):
    """Groups of copies, chains and texts that share a passage, against brute force, however nodes are cut."""
    monkeypatch.setattr(neardup, "LEAF", leaf)
    monkeypatch.setattr(neardup, "MOST_LEVELS", levels)
    chain = [" ".join(f"c{i}" for i in range(4 * k, 4 * k + 110)) for k in range(12)]  # neighbours at 0.927, the next but one at 0.86
    passage = " ".join(f"p{i}" for i in range(40))
    shared = [f"{passage} " + " ".join(f"s{k}x{i}" for i in range(60)) for k in range(60)]
    texts = [*_copies(60, 120, 1, 4), *_copies(40, 120, 2, 9), *chain, *shared, *[chain[0]] * 30, "a b", "a b", "a", None, ""]
    rows = list(enumerate(texts))
    got = {r["doc_id"]: r["component_id"] for r in neardup.near_duplicates(spark, spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    want = _brute_components([(i, t) for i, t in rows if t and len(t.split()) > 4], 85, 100)
    first = {}
    for i, t in rows:
        if i not in want:
            want[i] = first.setdefault(t, i) if t else i
    assert got == want


def test_near_rows_that_repeat_a_doc_id_are_one_node(spark):
    one, two = (" ".join(f"{c}{i}" for i in range(50)) for c in "ab")
    rows = [(5, one), (7, one), (7, two), (9, two), (9, two), (None, one), (3, None)]
    got = sorted((r["doc_id"] or -1, r["component_id"], r["kept"]) for r in neardup.near_duplicates(spark, spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == [(-1, None, False), (3, 3, True), (5, 5, True), (7, 5, False), (7, 5, False), (9, 5, False), (9, 5, False)]


def test_near_bound_never_errs():
    import numpy as np

    r = np.random.default_rng(3)
    near = 0
    for _ in range(300):
        n = int(r.integers(1, 3000))
        a = np.unique(r.integers(0, 1 << 63, n).astype(np.uint64))
        b = np.unique(np.concatenate([a[: int(n * r.uniform(0.8, 1))], r.integers(0, 1 << 63, int(r.integers(0, 1 + n // 6))).astype(np.uint64)]))
        both = len(np.intersect1d(a, b))
        if 100 * both >= 85 * (len(a) + len(b) - both):
            near += 1
            assert len(list(neardup.candidates(np.array([len(a), len(b)]), [neardup.parities(a).tobytes(), neardup.parities(b).tobytes()], 85, 100))) == 1
    far = [np.unique(r.integers(0, 1 << 63, 400).astype(np.uint64)) for _ in range(200)]
    assert near > 50 and not list(neardup.candidates(np.array([len(x) for x in far]), [neardup.parities(x).tobytes() for x in far], 85, 100))


def _kneser_ney(texts, other):
    """Log-perplexity per letter of each of texts in a modified Kneser-Ney model of the characters of other, order five."""
    import math

    def grams(t):
        w = ["", "", "", "", *t]
        return [tuple(w[i : i + 5]) for i in range(len(w) - 4)]

    counts = [Counter(g for t in other for g in grams(t))]
    for _ in range(4):
        counts.append(Counter(g[1:] for g in counts[-1]))
    cuts, below = [], []
    for c in counts:
        o = [0] + [sum(n == i for n in c.values()) for i in range(1, 5)]
        y = o[1] / (o[1] + 2 * o[2]) if o[1] and o[2] else 0.5
        cuts.append([0.0] + [min(max(i - (i + 1) * y * o[i + 1] / o[i], 0.05 * i), 0.95 * i) if o[i] and o[i + 1] else 0.5 for i in (1, 2, 3)])
        below.append({})
        for h, n in c.items():
            below[-1].setdefault(h[:-1], []).append(n)

    def p(g, k):
        if k == 5:
            return 1 / (len(counts[4]) + 1)
        found = below[k].get(g[:-1])
        if not found:
            return p(g[1:], k + 1)
        cut, n = cuts[k], counts[k].get(g, 0)
        return (n - cut[min(n, 3)] + sum(cut[min(m, 3)] for m in found) * p(g[1:], k + 1)) / sum(found)

    return [-sum(math.log(p(g, 0)) for g in grams(t)) / sum(c.isalpha() for c in t) for t in texts]


def _prose(n, seed=5):
    """Texts in which each word has few successors, and as many of the same words in any order."""
    import random

    r = random.Random(seed)
    parts = ("ka", "lo", "mi", "ne", "ru", "ta", "so", "vi", "pe", "du", "ba", "gi", "fo", "he", "ju", "ze")
    words = [a + b for a in parts for b in parts]
    after = {w: r.sample(words, 3) for w in words}
    out = []
    for _ in range(n):
        t = [r.choice(words)]
        while len(t) < 120:
            t.append(r.choice(after[t[-1]]))
        out.append(" ".join(t))
    mixed = []
    for t in out[:6]:
        w = t.split()
        r.shuffle(w)
        mixed.append(" ".join(w))
    return out, mixed


def test_perplexity_sees_word_order_in_every_language(spark):
    clean, mixed = _prose(120)
    rows = [(i, t, lang) for lang in ("en", "xx") for i, t in enumerate(clean + mixed, 1000 * (lang == "xx"))]
    got = {r["doc_id"]: r["kept"] for r in lmquality.judge(spark, spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    for base in (0, 1000):
        assert not any(got[base + i] for i in range(120, 126))
        assert sum(got[base + i] for i in range(120)) >= 118


@pytest.mark.parametrize("part, held", [(4_000_000, 2_000_000), (300, 100)])
def test_perplexity_equals_brute_force(spark, monkeypatch, part, held):
    """Also where the model comes in several parts and tasks send their counts on early."""
    import numpy as np

    monkeypatch.setattr(lmquality, "PART", part)
    monkeypatch.setattr(lmquality, "HELD", held)

    texts = [t for t in _prose(12)[0]] + ["ÉTÉ 日本 ÉTÉ 17", "kata", "ÉTÉ 日本 18 kata | lota 𝔸𝔹"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").selectExpr("doc_id", "text", "'EN' AS lang")
    raw = [t.encode() for t in texts]
    ends = np.cumsum([0] + [len(t) for t in raw])
    half = dict(enumerate(lmquality._half(np.frombuffer(b"".join(raw), np.uint8), ends).tolist()))
    assert set(half.values()) == {0, 1}
    got = {r["doc_id"]: r["log_ppl"] for r in lmquality.judge(spark, docs).collect()}
    for i, t in enumerate(texts):
        want = _kneser_ney([t], [u for j, u in enumerate(texts) if half[j] != half[i]])[0]
        assert got[i] == pytest.approx(want, rel=1e-5)


def test_perplexity_bands_reject_junk_and_keep_prose(spark, sf, documents):
    """Marks between words and texts in another language than the one they claim go; of good documents nearly all stay."""
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    clean, _ = _prose(100)
    marks = [(2 * 10**6 + i, t.replace(" ", " ### "), "xx") for i, t in enumerate(clean[:4])]
    rows = [(i, t, "xx") for i, t in enumerate(clean[4:])] + marks
    got = {r["doc_id"]: r for r in lmquality.judge(spark, spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert not any(got[i]["kept"] for i, *_ in marks) and sum(r["kept"] for r in got.values()) >= 0.95 * len(clean)
    judged = [(r["kept"], labels[r["doc_id"]]) for r in queries.op4_quality_rules(spark, sf).collect() if r["doc_id"] in labels and not r["base_failed"]]
    assert sum(k for k, q in judged if q == 1) >= 0.95 * sum(q == 1 for _, q in judged)


def test_pipeline_drops_short_boilerplate(spark, sf, documents):
    import corpus_pipeline

    rows = [(i, f"first line {i}\nAll rights reserved.\n\nonly {i % 4}", "en", f"site{i % 6}", 1) for i in range(12)]
    got = {r["doc_id"]: r["text"] for r in corpus_pipeline.lines(spark, spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long"), sf).collect()}
    assert got == {i: t if i == 0 else t.replace("All rights reserved.\n", "") for i, t, *_ in rows}
    # the same by brute force over the test table
    sites, first = {}, {}
    for i, r in sorted(documents.items()):
        for at, line in enumerate((r["text"] or "").split("\n")):
            if re.search(r"[^\x20\x09-\x0D]", line):
                sites.setdefault(line, set()).add(r["source"])
                first.setdefault(line, (i, at))
    bad = {line for line, s in sites.items() if len(s - {None}) >= 5}
    assert any(len(line.split()) < 5 for line in bad)
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = {r["doc_id"]: r["text"] for r in corpus_pipeline.lines(spark, docs, sf).collect()}
    for i, r in documents.items():
        if r["text"] is not None:
            assert got[i] == "\n".join(x for at, x in enumerate(r["text"].split("\n")) if x not in bad or first[x] == (i, at))


def test_random_tokens_of_every_kind_reach_the_battery(spark):
    import random
    import string

    r = random.Random(2)
    kinds = {"base64": string.ascii_letters + string.digits + "+/", "letters": string.ascii_letters, "base32": string.ascii_uppercase + "234567", "lower": string.ascii_lowercase, "digits": None}
    rows = []
    for kind, alphabet in kinds.items():
        for n in (16, 18, 20, 24, 32) * 8:
            token = "-".join("".join(r.choice(string.digits) for _ in range(4)) for _ in range(n // 4)) if kind == "digits" else "".join(r.choice(alphabet) for _ in range(n))
            rows.append((len(rows), kind, token, f"see {token} there"))
    plain = ["-" * 40, "=" * 20, "x" * 16, "xy" * 12, "/usr/share/doc/the/readers/and/other/texts", "1111-1111-1111-1111", "the_rest_of_the_letters_here_are_there", "internationalisation", "hainghethesthing", "nichtchzulichein"]
    rows += [(len(rows) + i, "plain", t, f"see {t} there") for i, t in enumerate(plain * 3)]
    got = {x["doc_id"]: {(s["start"], s["end"]) for s in [*x["base"], *x["added"]]} for x in secrets.find_secrets(spark, spark.createDataFrame([(i, t) for i, _, _, t in rows], "doc_id long, text string")).collect()}
    for kind in kinds:
        of = [(4, 4 + len(token)) in got[i] for i, k, token, _ in rows if k == kind]
        assert sum(of) >= 0.85 * len(of), (kind, sum(of), len(of))
    assert not {t for i, k, t, _ in rows if k == "plain" and got[i]}


CLASH = "doc_id long, text string, lang string, source string, n_chars long, _doc string, _row long, _lines string, _gone string, gone string, own string, lines string, doc string, row string, leak string, leak_ string, id string, comp string, node string, k1 string, n_lines long"


def _clashing(spark, texts):
    return spark.createDataFrame([(i, t, "en", f"site{i % 7}", 1, *["x"] * 1, 5, *["y"] * 13, 9) for i, t in enumerate(texts)], CLASH)


def test_columns_with_the_operators_own_names_come_back(spark):
    texts = [f"a line of {i} that is own\nthis line stands on every site" for i in range(14)] + [None, ""]
    docs = _clashing(spark, texts)
    got = linedup.drop_boilerplate(spark, docs)
    assert [c for c in got.columns if c != "n_removed"] == docs.columns
    rows = {r["doc_id"]: r for r in got.collect()}
    assert all(r["_doc"] == "x" and r["_row"] == 5 and r["own"] == "y" for r in rows.values())
    assert rows[0]["n_removed"] == 0 and rows[1]["text"] == "a line of 1 that is own" and rows[14]["text"] is None and (rows[15]["text"], rows[15]["n_lines"]) == ("", 1)
    bench = spark.createDataFrame([(1, "a line of 3 that is own", "z"), (2, None, "z"), (3, "", "z")], "item_id long, text string, doc_id string")
    left = decontam.clean_documents(spark, docs, bench)
    assert left.columns == docs.columns and {r["doc_id"] for r in left.collect()} == set(range(16)) - {3}
    assert decontam.clean_documents(spark, docs, bench.limit(0)).count() == 16
    assert {r["doc_id"] for r in langid.predict(spark, docs, langid.fit(spark, docs.select("text", "lang"))).collect()} == set(range(16))
    assert neardup.near_duplicates(spark, docs).count() == 16


def test_line_sites_ties_and_nulls(spark):
    """Five sites are enough, a null site is none, and the first occurrence of repeated rows stays in all of them."""
    rows = [(i, "the very same line here", f"s{i}") for i in range(5)] + [(0, "the very same line here", "s0"), (9, "four sites and a null", None)] + [(10 + i, "four sites and a null", f"s{i}") for i in range(4)]
    got = sorted((r["doc_id"], r["text"]) for r in linedup.drop_boilerplate(spark, spark.createDataFrame(rows, "doc_id long, text string, source string")).collect())
    assert got == sorted([(0, "the very same line here")] * 2 + [(i, "") for i in range(1, 5)] + [(9, "four sites and a null")] + [(10 + i, "four sites and a null") for i in range(4)])


def test_many_sites_are_judged_by_sketches(spark):
    """Far above the threshold nothing is counted exactly, around it everything is."""
    rows = [(100 * k + i, f"line that stands on {k} sites", f"s{i}") for k in (1, 3, 4, 5, 6, 9, 11, 40, 99) for i in range(k)]
    got = linedup.drop_boilerplate(spark, spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    assert {r["doc_id"] for r in got if r["n_removed"]} == {100 * k + i for k in (5, 6, 9, 11, 40, 99) for i in range(1, k)}


def test_language_stage_rejects_junk_and_keeps_prose(spark, sf, documents):
    import random
    import string

    import corpus_pipeline

    r = random.Random(4)
    junk = ["".join(r.choice(string.ascii_letters + string.digits + "  ") for _ in range(n)) for n in (120, 400, 4000)] + ["".join(r.choice("абвгдежзийклмн  ") for _ in range(300)), "12 34 --- 56", "", None]
    docs = spark.read.parquet(f"{sf}/documents.parquet").select(*corpus_pipeline.COLUMNS)
    more = spark.createDataFrame([(10**6 + i, t, None, "s", 1) for i, t in enumerate(junk)], docs.schema)
    kept = {r["doc_id"] for r in corpus_pipeline.language(spark, docs.union(more), sf).collect()}
    assert max(kept) < 10**6 and len(kept) >= 0.99 * len(documents)


def test_pipeline_stages_on_empty_tables(spark, sf):
    import corpus_pipeline

    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf)
        assert out.count() == 0 and (name == "tokens" or tuple(out.columns) == corpus_pipeline.COLUMNS)


def test_every_whole_token_passes_through_the_automaton():
    """Words that are tokens themselves come out of the transitions, not out of the vocabulary."""
    t = bpe.Tokenizer(queries.tokenizer_path())
    a = t.automaton
    words = [w.removesuffix("</w>") for w in a.vocab if w.endswith("</w>") and w not in t.special][::7]
    assert all(a.encode_symbols(w) == [a.vocab[w + "</w>"]] for w in words) and len(words) > 1000


def test_tokenizer_files_of_another_kind_are_refused(tmp_path):
    import json

    with open(queries.tokenizer_path(), encoding="utf-8") as f:
        spec = json.load(f)
    for change in ({"normalizer": None}, {"decoder": {"type": "ByteLevel"}}, {"model": spec["model"] | {"byte_fallback": True}}, {"added_tokens": [spec["added_tokens"][0] | {"lstrip": True}]}):
        (tmp_path / "t.json").write_text(json.dumps(spec | change))
        with pytest.raises(ValueError):
            bpe.Tokenizer(str(tmp_path / "t.json"))


def _battery(token):
    """The battery's p-value of a token, in plain Python."""
    import math
    import string

    up, low, dig = string.ascii_uppercase, string.ascii_lowercase, string.digits
    hexa = re.fullmatch("[0-9a-fA-F-]+", token)
    plain = token.rstrip("=")
    bare = token.replace("-", "").lower() if hexa else plain.replace("-", "+").replace("_", "/")
    kinds = [("[A-Z]+", up), ("[a-z]+", low), ("[A-Za-z]+", up + low), ("[A-Z2-7]+", up + "234567"), ("[A-Z0-9]+", up + dig), ("[a-z0-9]+", low + dig), ("[A-Za-z0-9]+", up + low + dig)]
    alphabet = dig if re.fullmatch("[0-9-]+", token) else "0123456789abcdef" if hexa else next((x for k, x in kinds if re.fullmatch(k, plain)), up + low + dig + "+/")
    v = [alphabet.index(c) + 1 for c in bare if c in alphabet]
    n, k = len(v), len(alphabet)
    if n < 16:
        return 0.0
    tail = lambda z: 0.5 * math.erfc(z / math.sqrt(2))
    chi = (max(k / n * sum(x * x for x in Counter(v).values()) - n, 0) / (k - 1)) ** (1 / 3)
    z1 = (chi - (1 - 2 / (9 * (k - 1)))) / math.sqrt(2 / (9 * (k - 1)))
    high = sum(x > k / 2 for x in v)
    m = 2 * high * (n - high) / n + 1
    turns = sum((a > k / 2) != (b > k / 2) for a, b in zip(v, v[1:]))
    z2 = abs(1 + turns - m) / math.sqrt((m - 1) * (m - 2) / (n - 1)) if m > 2 else 8.0
    z3 = abs(sum((a - (k + 1) / 2) * (b - (k + 1) / 2) for a, b in zip(v, v[1:]))) / ((k * k - 1) / 12) / math.sqrt(n - 1)
    letters = [c for c in bare if c.isalpha()] if k > 16 else []
    ps = [tail(z1), 2 * tail(z2), 2 * tail(z3)]
    if letters:
        q, common = 10 / 26, sum(c.lower() in "aehilnorst" for c in letters)
        ps.append(tail((common - q * len(letters)) / math.sqrt(q * (1 - q) * len(letters))))
        pairs = [a + b for a, b in zip(bare, bare[1:]) if a.isalpha() and b.isalpha()]
        r, usual = len(set(secrets._PAIRS)) / 676, sum(x.lower() in secrets._PAIRS for x in pairs)
        ps.append(tail((usual - r * len(pairs)) / math.sqrt(max(r * (1 - r) * len(pairs), 1e-9))))
        v, turning = 210 / 676, sum((x[0].lower() in "aeiou") != (x[1].lower() in "aeiou") for x in pairs)
        ps.append(tail((turning - v * len(pairs)) / math.sqrt(max(v * (1 - v) * len(pairs), 1e-9))))
    h = -sum(math.log(min(max(p, 1e-30), 1)) for p in ps)
    return math.exp(-h) * sum(h**i / math.factorial(i) for i in range(len(ps)))


def test_battery_equals_brute_force(spark):
    import random
    import string

    r = random.Random(9)
    tokens = ["".join(r.choice(a) for _ in range(n)) for a in (string.ascii_lowercase, string.ascii_letters, string.ascii_uppercase + "234567", string.ascii_letters + string.digits + "+/", "0123456789abcdef-", string.digits) for n in (16, 20, 33, 64) * 3]
    tokens += ["the_rest_of_the_letters_here", "aaaaaaaaaaaaaaaaaaaa", "internationalisation", "dGhpcyBpcyBub3QgcmFuZG9tIQ==", "x" * 15]
    df = spark.createDataFrame([(t,) for t in tokens], "t string")
    got = {x["t"]: x["p"] for x in df.select("t", secrets.battery(df["t"]).alias("p")).collect()}
    for t in tokens:
        assert got[t] == pytest.approx(_battery(t), abs=2e-6), t


def test_ordinary_identifiers_are_left_alone(spark):
    """snake_case and CamelCase names of prose words: none of the first kind is flagged, few of the second."""
    import random

    r = random.Random(5)
    words = "the reader takes another line from table after other columns were written into this store before rest of them are there because names should tell what they hold".split()
    snake = ["_".join(r.choice(words) for _ in range(5)) for _ in range(150)]
    camel = ["".join(r.choice(words).title() for _ in range(5)) + str(r.randrange(10)) for _ in range(150)]
    rows = [(i, f"see {t} there") for i, t in enumerate(snake + camel)]
    got = {x["doc_id"]: len(x["added"]) for x in secrets.find_secrets(spark, spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert sum(got[i] > 0 for i in range(150)) <= 3 and sum(got[i] > 0 for i in range(150, 300)) <= 15


def test_very_many_matches_in_one_text(spark):
    """Positions over several blocks, and time in proportion to the matches."""
    import time

    def run(n):
        text = "é" + " ".join(f"{i:016x}" for i in range(n))
        start = time.perf_counter()
        row = secrets.find_secrets(spark, spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
        return row, time.perf_counter() - start

    run(10)
    row, _ = run(1000)
    assert [(s["start"], s["end"]) for s in row["base"]] == [(1 + 17 * i, 17 + 17 * i) for i in range(1000)]
    few, many = run(2000)[1], run(8000)[1]
    assert many < 8 * few + 3


def test_license_rules():
    grant, condition, as_is = (licenses.SENTENCES[k][0] for k in ("mit-grant", "mit-condition", "as-is"))
    gpl = [licenses.SENTENCES[k][0] for k in ("gpl-free", "gpl-3-later")]
    scan = lambda t: licenses.match_rules(licenses.recognise(t))
    whole = f"{grant}:\n\n{condition}.\n\n{as_is}."
    assert scan(whole) == [("MIT", 0, len(whole))]
    # broken lines, comment signs and case don't matter; positions are those of the text
    broken = "// " + grant.upper().replace(", ", ",\n// ") + ":\n"
    assert [x[0] for x in scan("é. " + broken)] == ["MIT"] and scan("é. " + broken)[0][1] == 3
    filler = "Some other sentence stands here. "
    near, far = f"{gpl[0]}; {filler * 2}{gpl[1]}.", f"{gpl[0]}; {filler * 3}{gpl[1]}."
    assert [x[0] for x in scan(near)] == ["GPL-3.0-or-later"] and scan(far) == []
    # the order of a rule counts, each sentence serves once, and the rule listed first wins
    assert scan(f"{gpl[1]}. {gpl[0]};") == []
    assert [x[0] for x in scan(f"{grant}:\n{grant}:\n{condition}.")] == ["MIT", "MIT"]
    assert [x[0] for x in scan("Licensed under the Apache License, Version 2.0. Licensed under CC BY-NC 4.0. Released under the MIT License!")] == ["Apache-2.0", "CC-BY-NC-4.0", "MIT"]
    assert scan("The licensed text under the MIT sun") == [] and scan("") == []
    long = "word " * 200_000 + "\n" * 100_000 + "SPDX-License-Identifier: MIT"
    assert [x[0] for x in scan(long)] == ["MIT"]


def test_license_rules_over_rows(spark):
    rows = [(1, "SPDX-License-Identifier: MPL-2.0"), (1, "SPDX-License-Identifier: MPL-2.0"), (2, None), (None, "Released under the MIT License.")]
    got = licenses.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r["doc_id"] or 0, [tuple(s) for s in r["spans"]]) for r in got) == [(0, [("MIT", 0, 31)]), (1, [("MPL-2.0", 0, 32)]), (1, [("MPL-2.0", 0, 32)]), (2, [])]


def test_neighbours_vote_exactly_and_ties_go_by_place():
    import numpy as np

    r = np.random.default_rng(1)
    v = r.standard_normal((200, 8)).astype(np.float32)
    v[100:] = v[:100]  # every reference stands twice
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    labels = np.concatenate([np.ones(100), np.zeros(100)])
    m = knnquality.Model(np.zeros(1, np.int32), np.zeros((1, 8), np.float32), v, labels, 0.5)
    x = r.standard_normal((30, 8)).astype(np.float32)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    for row, got in zip(x, m.score(x), strict=True):
        sim = row @ v.T
        near = sorted(range(200), key=lambda i: (-sim[i], i))[: knnquality.NEIGHBOURS]
        w = np.maximum(sim[near], 0).astype(float) ** knnquality.SHARPNESS
        assert got == pytest.approx((w * labels[near]).sum() / w.sum(), abs=1e-5)


def _shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def test_pipeline_equals_brute_force(spark, sf, documents):
    """Each stage in plain Python on what the one before kept; the tokens come from the library."""
    from pyspark.sql import functions as F
    from tokenizers import Tokenizer

    docs = spark.read.parquet(f"{sf}/documents.parquet")
    model = langid.fit(spark, docs.where(~langid.held_out() & F.col("doc_id").isNotNull()).select("text", "lang"))
    ids = sorted(documents)
    known = model.accepts([documents[i]["text"] or "" for i in ids])
    kept = {i: documents[i]["text"] for i, k in zip(ids, known, strict=True) if k}
    sites, first = {}, {}
    for i, t in kept.items():
        for at, line in enumerate(t.split("\n")):
            sites.setdefault(line, set()).add(documents[i]["source"])
            first.setdefault(line, (i, at))
    bad = {x for x, s in sites.items() if len(s - {None}) >= linedup.MIN_SITES and re.search(r"[^\x20\x09-\x0D]", x)}
    kept = {i: "\n".join(x for at, x in enumerate(t.split("\n")) if x not in bad or first[x] == (i, at)) for i, t in kept.items()}
    sets, comp = {i: _shingles(t) for i, t in kept.items()}, {i: i for i in kept}
    for a in kept:
        for b in kept:
            both = len(sets[a] & sets[b]) if a < b else 0
            if both and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both) and comp[a] != comp[b]:
                low, high = sorted((comp[a], comp[b]))
                comp = {i: low if c == high else c for i, c in comp.items()}
    kept = {i: t for i, t in kept.items() if comp[i] == i}
    items = [_shingles(r["text"]) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    kept = {i: t for i, t in kept.items() if not any(s and 100 * len(s & sets[i]) >= 80 * len(s) for s in items)}
    t = Tokenizer.from_file(queries.tokenizer_path())
    t.no_padding(), t.no_truncation()
    want = {i: hashlib.sha256(struct.pack(f"<{len(x)}I", *x)).hexdigest() for i, text in kept.items() for x in [t.encode(text, add_special_tokens=False).ids]}
    assert {r["doc_id"]: r["ids_sha256"] for r in queries.pipeline(spark, sf).collect()} == want
    assert len(documents) > len(want) > len(documents) / 2
