"""Secret thresholds, chat merging, hot keys of the containment search, and what the language stage learns, against brute force."""

import random
import re
import string
from collections import Counter, defaultdict

import numpy as np
import pytest

from quillon.llm import chat, decontam, langid, licenses, linedup, lmquality, queries, secrets

MASK = ""


def _token(r, n=40):
    return "".join(r.choice(string.ascii_letters + string.digits) for _ in range(n))


def test_private_use_characters_beside_tokens(spark):
    """They are no token characters, whether or not the text has a base span."""
    r = random.Random(1)
    rows = []
    for before in ("", "password=abcdefghijkl1 "):
        for mark in ("", "", " "):
            t = _token(r)
            rows.append((len(rows), f"{before}see {mark}{t}{mark} there", t))
    got = {x["doc_id"]: [(s["start"], s["end"], s["text"]) for s in x["added"]] for x in secrets.find_secrets(spark, spark.createDataFrame([x[:2] for x in rows], "doc_id long, text string")).collect()}
    for i, text, t in rows:
        assert got[i] == [(text.index(t), text.index(t) + 40, t)]


def test_thresholds_and_added_spans_equal_brute_force(spark):
    """Benjamini and Hochberg by class of length on the histogram, and what stands after it."""
    import math

    r = random.Random(4)
    words = "the reader takes another line from table after other columns were written into this store".split()
    tokens = [_token(r, r.choice((16, 20, 24, 40, 64, 200))) for _ in range(150)] + ["_".join(r.choice(words) for _ in range(r.choice((4, 6, 9)))) for _ in range(400)]
    docs = spark.createDataFrame([(i, f"a {t} b") for i, t in enumerate(tokens)], "doc_id long, text string")
    df = spark.createDataFrame([(t,) for t in set(tokens)], "t string")
    p = {x["t"]: x["p"] for x in df.select("t", secrets.battery(df["t"]).alias("p")).collect()}
    of_class = lambda t: min(int(math.floor(math.log2(len(t) / 16) * 2)), secrets.CLASSES - 1)
    of_bin = lambda x: min(int(math.floor(-4 * math.log10(max(x, 1e-99)))), secrets.BINS - 1)
    long = [t for t in tokens if re.fullmatch("[A-Za-z0-9+/_=-]{16,}", t)]
    cut = {}
    for c in range(secrets.CLASSES):
        bins = Counter(of_bin(p[t]) for t in long if of_class(t) == c)
        passing = [b for b in bins if 10 ** (-b / 4) * sum(bins.values()) <= secrets.RATE * sum(n for k, n in bins.items() if k >= b)]
        cut[c] = min(passing, default=secrets.BINS)
    got = {x["doc_id"]: {s["text"] for s in [*x["base"], *x["added"]]} for x in secrets.find_secrets(spark, docs).collect()}
    for i, t in enumerate(tokens):
        want = len(t) >= 16 and of_bin(p[t]) < cut[of_class(t)]
        assert (t in got[i]) == (want or bool(re.fullmatch("[0-9a-f]+", t))), (t, p[t])


def test_few_runs_of_prose_letters_are_flagged(spark):
    """Words of invented prose run together: at 16 letters at most three in a hundred, at 24 at most one."""
    r = random.Random(11)
    parts = ["ka", "lo", "mi", "nen", "ru", "tas", "so", "vi", "per", "du", "ba", "gi", "fol", "he", "ju", "zen", "th", "er", "ver", "sch", "lich", "zu", "ung", "ein"]
    rows = []
    for n in (16, 24):
        for _ in range(300):
            t = ""
            while len(t) < n:
                t += r.choice(parts)
            rows.append((n, t[:n]))
    real = [_token(r, 24) for _ in range(600)]
    docs = spark.createDataFrame([(i, f"see {t} there") for i, t in enumerate([t for _, t in rows] + real)], "doc_id long, text string")
    got = {x["doc_id"]: bool(x["added"]) for x in secrets.find_secrets(spark, docs).collect()}
    assert sum(got[i] for i, (n, _) in enumerate(rows) if n == 16) <= 9 and sum(got[i] for i, (n, _) in enumerate(rows) if n == 24) <= 3
    assert sum(got[i] for i in range(len(rows), len(got))) >= 0.9 * len(real)


@pytest.mark.parametrize("chunk", [1, 3, 256])
def test_turns_are_merged_by_aggregation(spark, monkeypatch, chunk):
    """Blocks equal those of itertools.groupby, over chunk borders too, and the round trip holds."""
    from itertools import groupby

    monkeypatch.setattr(chat, "CHUNK", chunk)
    r = random.Random(chunk)
    convs = {i: [(r.choice(["user", "assistant", "", "a\nb<"]), r.choice(["", "x", "<part>", "\\l", "</turn>\n"])) for _ in range(n)] for i, n in enumerate((1, 2, 3, 7, 40))}
    convs[9] = [("user", str(i)) for i in range(700)] + [("assistant", "z")]
    rows = [(i, k, role, t) for i, c in convs.items() for k, (role, t) in enumerate(c)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    done = chat.format_conversations(df).select("conv_id", "formatted", chat.read_turns("formatted").alias("t"), chat.loss_text("segments").alias("loss")).collect()
    for x in done:
        want = convs[x["conv_id"]]
        assert [(t["role"], t["text"]) for t in x["t"]] == want
        assert x["formatted"].count(chat.TURN) == len(list(groupby(want, key=lambda t: t[0])))
        assert x["loss"] == "".join(t for role, t in want if role == "assistant")


def test_hot_shingles_and_items_are_spread(spark, monkeypatch):
    """A passage that most documents and many items share, with nulls among the ids, against brute force; keys of over ten rows are dealt out."""
    monkeypatch.setattr(decontam, "HOT_ROWS", 10)
    r = random.Random(5)
    common = " ".join(f"c{i}" for i in range(12))
    own = [" ".join(f"i{k}x{i}" for i in range(10)) for k in range(8)]
    items = [(k, f"{common} {own[k]}") for k in range(8)] + [(100, common), (100, own[0]), (None, own[1]), (200, None), (201, " "), (202, "c0 c1")]
    docs = [(i, f"start {common} {r.choice(own) if i % 3 == 0 else 'else'} end{i}") for i in range(120)] + [(None, own[1]), (3, own[2]), (500, None), (501, "c0 c1"), (3, own[2])]
    shingle = lambda t: {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w := (t or "").split()) >= 5 else {tuple(w)} if w else set()
    want = defaultdict(lambda: (0, 0))
    for d, t in docs:
        for k, s in items:
            both, n = len(shingle(t) & shingle(s)), len(shingle(s))
            if n and 100 * both >= 80 * n:
                want[d, k] = (max(want[d, k][0], n), max(want[d, k][1], both))
    df, bench = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    got = {(x["doc_id"], x["item_id"]): (x["n_item"], x["n_shared"]) for x in decontam.find_leaks(spark, df, bench).collect()}
    assert got == dict(want) and len(got) > 120


def test_bitmaps_follow_the_benchmark(spark, monkeypatch):
    """A bitmap that is far too small lets too much through, and the joins still tell what is contained."""
    texts = [" ".join(f"w{k}x{i}" for i in range(30)) for k in range(50)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame([(k, " ".join(t.split()[5:25])) for k, t in enumerate(texts)], "item_id long, text string")
    for bits in (1 << 6, 1 << 20):
        monkeypatch.setattr(decontam, "LEAST_BITS", bits)
        monkeypatch.setattr(decontam, "MOST_BITS", bits)
        assert {(x["doc_id"], x["item_id"]) for x in decontam.find_leaks(spark, docs, bench).collect()} == {(k, k) for k in range(50)}


def test_every_language_is_learned(spark):
    """Ninety languages, each with letters of its own."""
    r = random.Random(2)
    rows = []
    for k in range(90):
        letters = [chr(0x4E00 + 40 * k + i) for i in range(30)]
        rows += [(16 * k + i, " ".join("".join(r.choices(letters, k=4)) for _ in range(30)), f"l{k:02d}") for i in range(16)]
    got = langid.identify(spark, spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()
    assert all(x["lang_pred"] == rows[x["doc_id"]][2] for x in got) and len({x["lang_pred"] for x in got}) == 90


def test_kernel_scores_equal_plain_python(spark):
    """The kernel of presence n-grams, Nystroem landmarks and one-versus-rest ridge regression, in plain numpy on sets of n-grams."""
    r = random.Random(7)
    rows = [(" ".join("".join(r.choices(a, k=5)) for _ in range(12)), lang) for lang, a in (("x", "abcdefgh"), ("y", "efghijkl"), ("z", "ijklmnop")) for _ in range(8)]
    model = langid.fit(spark, spark.createDataFrame(rows, "text string, lang string"))
    grams = lambda t: set(langid._grams(t).tolist())
    by = {}
    for t, lang in rows:
        by.setdefault(lang, []).append(grams(t))
    names = sorted(by)
    marks = [g for n in names for g in by[n]]
    kernel = lambda a, b: len(a & b) / (len(a) * len(b)) ** 0.5
    k = np.array([[kernel(a, b) for b in marks] for a in marks])
    values, vectors = np.linalg.eigh(k)
    root = vectors / np.sqrt(np.maximum(values, 1e-6 * values.max()))
    phi = np.hstack([k @ root, np.ones((len(marks), 1))])
    y = np.array([[1.0 if i // 8 == j else -1.0 for j in range(3)] for i in range(24)])
    w = np.full((24, 1), 1 / 24)
    left = phi.T @ (w * phi) + np.diag([langid.RIDGE] * len(marks) + [0]) + 1e-9 * np.eye(len(marks) + 1)
    beta = np.linalg.solve(left, phi.T @ (w * y))
    tests = [t for t, _ in rows[::5]] + ["abcd efgh ijkl", "mnop"]
    want = np.array([[kernel(grams(t), m) for m in marks] for t in tests]) @ root @ beta[:-1] + beta[-1]
    assert model.scores(tests)[0] == pytest.approx(want, abs=2e-3)


def test_short_junk_goes_and_short_prose_stays(spark, sf):
    import corpus_pipeline

    r = random.Random(3)
    docs = spark.read.parquet(f"{sf}/documents.parquet").select(*corpus_pipeline.COLUMNS)
    texts = [x["text"] for x in docs.where("text IS NOT NULL").collect()]
    prose = [" ".join(t.split()[10 : 10 + n]) for t in texts[:40] for n in (4, 8, 15) if re.search("[a-z]{3} [a-z]{3} ", t[:200])]
    junk = ["".join(r.choice("бвгджзклмнпрстфхцчшщ") for _ in range(n)) for n in (12, 20, 40)] + ["".join(r.choice("qxzjkvw") for _ in range(30)) for _ in range(10)]
    more = spark.createDataFrame([(10**6 + i, t, None, "s", 1) for i, t in enumerate(prose + junk)], docs.schema)
    kept = {x["doc_id"] - 10**6 for x in corpus_pipeline.language(spark, docs.union(more), sf).collect() if x["doc_id"] >= 10**6}
    assert sum(i in kept for i in range(len(prose))) >= 0.9 * len(prose)
    assert not {i for i in kept if i >= len(prose)}


def test_short_lines_are_judged_too(spark):
    rows = [(i, f"own {i}\nshare this\n\n", f"s{i}") for i in range(6)]
    got = {x["doc_id"]: x["text"] for x in linedup.drop_boilerplate(spark, spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert got == {i: f"own {i}\nshare this\n\n" if i == 0 else f"own {i}\n\n" for i in range(6)}


def test_kept_equals_the_bands_by_brute_force(spark, sf):
    """Medians and deviations by language in numpy on the measured perplexities; a null language and an empty name are told apart."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    lang = {x["doc_id"]: x["lang"] for x in docs.collect()}
    rows = queries.op4_quality_rules(spark, sf).collect()
    usable = defaultdict(list)
    for x in rows:
        if x["log_ppl"] is not None and x["n_words"] >= 50:
            usable[lang[x["doc_id"]]].append(x["log_ppl"])
    bands = {}
    for name, v in usable.items():
        v = sorted(v)
        mid = v[(len(v) - 1) // 2]
        off = sorted(abs(x - mid) for x in v)
        bands[name] = (mid, 1.4826 * off[(len(off) - 1) // 2])
    wrong = 0
    for x in rows:
        mid, spread = bands[lang[x["doc_id"]]]
        wider = lmquality.LENGTH / max(x["word_chars"], 1) ** 0.5
        low, high = mid - lmquality.LOWER * spread - wider, mid + lmquality.UPPER * spread + wider
        inside = x["log_ppl"] is not None and low <= x["log_ppl"] <= high
        wrong += x["kept"] != (inside and not x["base_failed"])
    assert wrong == 0


def _licences(text):
    """Every run of pieces looked up as a whole, the longest first; then every rule over every start, in order."""
    words = lambda t: re.sub("[^a-z0-9]+", " ", t.lower()).strip()
    known = {words(x): name for name, forms in licenses.SENTENCES.items() for x in forms}
    longest = max(len(k) for k in known)
    cuts = [0, *[x for m in re.finditer(r"(?<=[.;:!?])\s+|\n", text) for x in m.span()], len(text)]
    pieces = [(a, b, words(text[a:b])) for a, b in zip(cuts[::2], cuts[1::2])]
    found, i, n = [], 0, 0
    while i < len(pieces):
        best, j, joined = None, i, ""
        while j < len(pieces) and pieces[j][2] and len(joined) <= longest:
            joined = f"{joined} {pieces[j][2]}".strip()
            best = (j, known[joined]) if joined in known else best
            j += 1
        if best:
            found.append((n, n + best[0] - i + 1, pieces[i][0], pieces[best[0]][1], best[1]))
            n += best[0] - i + 1
            i = best[0] + 1
        else:
            n += bool(pieces[i][2])
            i += 1
    free, out = set(range(len(found))), []
    for name, wanted in licenses.RULES:
        for start in range(len(found)):
            chain = []
            for k in range(start, len(found)):
                if chain and found[k][0] - found[chain[-1]][1] > licenses.GAP:
                    break
                if k in free and found[k][4] == wanted[len(chain)]:
                    chain.append(k)
                    if len(chain) == len(wanted):
                        break
                elif not chain:
                    break
            if len(chain) == len(wanted):
                free -= set(chain)
                out.append((name, found[chain[0]][2], found[chain[-1]][3]))
    return sorted(out, key=lambda x: (x[1], x[2], x[0]))


def test_licences_equal_brute_force(spark, sf):
    """Over all documents, and over texts put together from sentences, fillers, breaks and comment signs."""
    r = random.Random(12)
    forms = [x for f in licenses.SENTENCES.values() for x in f]
    texts = []
    for _ in range(300):
        out = []
        for name in (r.choice(licenses.RULES)[1] if r.random() < 0.7 else [r.choice(list(licenses.SENTENCES))]):
            t = r.choice(licenses.SENTENCES[name])
            out.append((re.sub(" ", lambda m: r.choice([" "] * 9 + ["\n", "\n * "]), t) if r.random() < 0.5 else t) + r.choice([".", ";", ":", ""]) + r.choice(["\n", "\n\n", " "]))
            out += r.choice([[], [], ["Some other words stand here. "], ["Un. Deux. Trois. "]])
        texts.append("".join(out) + r.choice(["", r.choice(forms)]))
    rows = [(x["doc_id"], x["text"]) for x in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()] + [(10**6 + i, t) for i, t in enumerate(texts)]
    got = {x["doc_id"]: [tuple(s) for s in x["spans"]] for x in licenses.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, t in rows:
        assert got[i] == _licences(t or ""), i
    assert len({s[0] for spans in got.values() for s in spans}) > 30


def test_whole_licences_are_one_span():
    for name, wanted in (("MIT", ("mit-name", "mit-grant", "mit-condition", "as-is", "mit-liability")), ("BSD-3-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse", "bsd-as-is", "bsd-liability")), ("Zlib", ("zlib-as-is", "zlib-liability", "zlib-grant", "zlib-origin", "zlib-altered", "zlib-notice")), ("GPL-3.0-or-later", ("gpl-free", "gpl-3-later", "gpl-warranty", "gpl-merchantability", "gpl-details", "gpl-copy"))):
        text = "\n".join(licenses.SENTENCES[w][0] + "." for w in wanted)
        assert [x[0] for x in licenses.match_rules(licenses.recognise(text))] == [name]


def test_repeated_rows_over_several_model_parts(spark, monkeypatch):
    """Rows that repeat get the perplexity of one, however many parts the model comes in."""
    words = [a + b for a in ("ka", "lo", "mi", "ne") for b in ("ru", "ta", "so", "vi")]
    r = random.Random(9)
    rows = [(i, " ".join(r.choices(words, k=80)), r.choice(["en", "EN", None, ""])) for i in range(30)]
    rows += rows[:10] + [(3, None, "en"), (None, rows[4][1], "en")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    whole = sorted(str(tuple(x)) for x in lmquality.judge(spark, df).select("doc_id", "n_words", "base_failed", lmquality.F.round("log_ppl", 4)).collect())
    monkeypatch.setattr(lmquality, "PART", 200)
    parts = sorted(str(tuple(x)) for x in lmquality.judge(spark, df).select("doc_id", "n_words", "base_failed", lmquality.F.round("log_ppl", 4)).collect())
    assert whole == parts and len(whole) == len(rows) and len(set(whole)) == 32


def test_labels_of_one_class_only(spark):
    from quillon.llm import knnquality

    docs = spark.createDataFrame([(i, f"some words of text number {i} that go on") for i in range(40)] + [(40, None), (41, "")], "doc_id long, text string")
    for quality in (0, 1):
        labels = spark.createDataFrame([(i, quality) for i in range(40)], "doc_id long, quality int")
        got = knnquality.classify(spark, docs, labels).collect()
        assert len(got) == 42 and all(0 <= x["score"] <= 1 and x["predicted"] == (x["score"] >= 0.5) for x in got)
        assert all(x["predicted"] == quality for x in got if x["doc_id"] < 40)


def test_stages_on_repeated_rows_and_clashing_columns(spark, sf):
    """Each stage on rows that stand twice, rows without ids and columns of the operators' own names: the columns of documents come back, and equal rows fare alike."""
    import corpus_pipeline

    docs = spark.read.parquet(f"{sf}/documents.parquet").select(*corpus_pipeline.COLUMNS)
    odd = spark.createDataFrame([(None, "the " * 60, "en", "s", 1), (None, None, None, None, None), (10**7, "", "en", None, 0)], docs.schema)
    both = docs.union(docs).union(odd).selectExpr("*", "1 AS hash", "'x' AS tag", "2 AS comp", "'y' AS gone", "3 AS node", "4 AS item", "5 AS starts", "'z' AS leak", "6 AS u")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        rows = stage(spark, both, sf)
        assert tuple(rows.columns) == corpus_pipeline.COLUMNS, name
        times = Counter((x["doc_id"], x["text"]) for x in rows.collect() if x["doc_id"] is not None and x["doc_id"] < 10**7)
        assert set(times.values()) == {2} and len(times) > 100, name
