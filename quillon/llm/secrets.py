"""Secret scans with a randomness test battery, with DataFrame functions only.

Base rules find assignments, access keys and hexadecimal runs. The battery looks at every other run
of 16 or more token characters: its encoding is inferred (digits, hexadecimal, letters of one case or
both, these with digits, base32, base64), and under the hypothesis
that it is a random string of that encoding's alphabet, tests give p-values: chi-squared
uniformity over the alphabet, runs above and below the alphabet's middle, serial correlation of
neighbouring symbols and, where all letters may stand, the share of those that are common in prose and
of neighbouring letters that are common pairs there and that are a vowel and another letter (short words would pass the other three). Their Fisher combination is controlled for false discoveries by Benjamini and
Hochberg within classes of length, over all tokens of the corpus: a token whose randomness is rejected
is ordinary text, and one that stands is a secret. So the rate bounds how many random tokens are lost, and
what ordinary text is flagged is bounded by the tests' power, which grows with length: of prose letters in
runs of 16 some stand, of runs of 24 next to none. Random identifiers, such as UUIDs, are random and are
reported as such. The control needs the p-values' histogram for each
length class, whose size is fixed, so a threshold for each class is all that comes to the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillon.llm._store import Store

ASSIGN = r"""(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
#: Longest runs, so the least lengths (18 and 16) may stand in the pattern.
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
ASSIGN_LEAST = 12
TOKEN = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{16,}"
#: Stands for each character of a base span where tokens are looked for, and the tokens and touching spans of such a text. A text's own MASKs, which are no token characters, are taken for OTHER there.
MASK, OTHER = "\uE000", "\uE001"
MASKED_TOKEN = TOKEN.replace("=-]", f"=-{MASK}]")
KINDS = ("assign", "access", "hex", "random")

#: Matches of one text that are added up one by one.
BLOCK = 256

#: False discovery rate, bins of the p-values' histogram (by -log10 p, four to a decade), classes of length.
RATE, BINS, CLASSES = 0.05, 400, 8

_DIGITS = "0123456789"
_HEXA = "0123456789abcdef"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_LOWER = "abcdefghijklmnopqrstuvwxyz"
_B32 = _UPPER + "234567"
_B64 = _UPPER + _LOWER + _DIGITS + "+/"
#: The ten letters that are most common in prose of Latin script, its vowels, and pairs of letters that are common in one language of it or another.
_COMMON, _VOWELS = "aehilnorst", "aeiou"
_PAIRS = "th he in er an re on es en at ed nd to or ea ti ar te ng al it as is ha et se ou of le sa ve ro ra ri hi ne me de co ta ec si ll so na li la el ei ie ch sc un ge be ke au ss ue ai nt os ad do io qu us is ic um zu ht st tr pa ur il".split()
#: The first pattern that a token without padding fits gives its alphabet; digits and hexadecimal, dashes aside, come before, all others are base64.
_ALPHABETS = (("^[A-Z]+$", _UPPER), ("^[a-z]+$", _LOWER), ("^[A-Za-z]+$", _UPPER + _LOWER), ("^[A-Z2-7]+$", _B32), ("^[A-Z0-9]+$", _UPPER + _DIGITS), ("^[a-z0-9]+$", _LOWER + _DIGITS), ("^[A-Za-z0-9]+$", _UPPER + _LOWER + _DIGITS))


def spans_of(text: Column, pattern: str, kind: str, group: int = 0, least: int = 0) -> Column:
    """array<struct<kind, start, end, text>> of a pattern's matches, positions in code points.

    The pieces between matches give the positions. A match whose group is shorter than least is
    passed over and dropped. Matches are added up in blocks of BLOCK, so that a text of very many costs
    in proportion to them.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    groups = F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    pieces = F.split(text, pattern, -1)
    empty = F.array().cast("array<struct<kind:string,start:int,end:int,text:string>>")
    rows = F.filter(F.arrays_zip(pieces.alias("piece"), found.alias("found"), groups.alias("group")), lambda x: x["found"].isNotNull())
    blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(rows) - 1) / BLOCK).cast("int")), lambda i: F.slice(rows, i * BLOCK + 1, F.lit(BLOCK)))

    def length(block: Column) -> Column:
        return F.aggregate(block, F.lit(0), lambda s, x: s + F.length(x["piece"]) + F.length(x["found"]))

    def starts(blocks: Column) -> Column:
        """Where each block begins."""
        step = lambda acc, block: F.struct((acc["at"] + length(block)).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out"))
        return F.aggregate(blocks, F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out")), step, lambda acc: acc["out"])

    def spans(block: Column, begin: Column) -> Column:
        def step(acc: Column, x: Column) -> Column:
            start = acc["at"] + F.length(x["piece"])
            end = start + F.length(x["found"])
            span = F.array(F.struct(F.lit(kind).alias("kind"), start.alias("start"), end.alias("end"), x["found"].alias("text")))
            return F.struct(end.alias("at"), F.when(F.length(x["group"]) >= least, F.concat(acc["out"], span)).otherwise(acc["out"]).alias("out"))

        return F.aggregate(block, F.struct(begin.alias("at"), empty.alias("out")), step, lambda acc: acc["out"])

    both = _let(blocks, lambda b: F.flatten(F.zip_with(b, starts(b), spans)))
    return F.when(text.rlike(pattern), both).otherwise(empty)


def base_spans(text: Column) -> Column:
    return F.concat(spans_of(text, ASSIGN, "assign", 1, ASSIGN_LEAST), spans_of(text, ACCESS, "access"), spans_of(text, HEX, "hex"))


def _masked(text: Column, pattern: str, group: int = 0, least: int = 0) -> Column:
    """text with each match, but for those whose group is shorter than least, replaced by as many MASKs."""
    zipped = F.arrays_zip(F.split(text, pattern, -1).alias("piece"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("found"), F.regexp_extract_all(text, F.lit(pattern), F.lit(group)).alias("group"))
    shown = lambda x: F.when(F.length(x["group"]) >= least, F.repeat(F.lit(MASK), F.length(x["found"]))).otherwise(F.coalesce(x["found"], F.lit("")))
    return F.array_join(F.transform(zipped, lambda x: F.concat(x["piece"], shown(x))), "")


def candidates(text: Column, base: Column) -> Column:
    """Tokens that touch no base span: they are looked for where these are masked, and those with a mask in them go."""
    masked = _let(_masked(F.replace(text, F.lit(MASK), F.lit(OTHER)), ASSIGN, 1, ASSIGN_LEAST), lambda t: _let(_masked(t, ACCESS), lambda u: _masked(u, HEX)))
    bare = F.filter(_let(masked, lambda t: spans_of(t, MASKED_TOKEN, "random")), lambda s: ~F.contains(s["text"], F.lit(MASK)))
    return F.when(F.size(base) > 0, bare).otherwise(spans_of(text, TOKEN, "random"))


def _upper_tail(z: Column) -> Column:
    """1 - Phi(z), by a rational approximation (absolute error under 1e-7)."""
    poly = lambda t: t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    tail = 0.3989422804 * F.exp(-z * z / 2) * _let(1 / (1 + 0.2316419 * F.abs(z)), poly)
    return _let(tail, lambda p: F.when(z >= 0, p).otherwise(1 - p))


def _let(value: Column, body) -> Column:
    """body(value) with the value computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _sum(a: Column) -> Column:
    return F.aggregate(a, F.lit(0.0), lambda s, e: s + e)


def battery(token: Column) -> Column:
    """The combined p-value of the hypothesis that the token is random in its inferred encoding."""
    hexa = token.rlike("^[0-9a-fA-F-]+$")
    bare = F.when(hexa, F.lower(F.replace(token, F.lit("-"), F.lit("")))).otherwise(F.translate(F.regexp_replace(token, "=+$", ""), "-_", "+/"))
    plain = F.regexp_replace(token, "=+$", "")
    alphabet = F.when(token.rlike("^[0-9-]+$"), F.lit(_DIGITS)).when(hexa, F.lit(_HEXA))
    for pattern, letters in _ALPHABETS:
        alphabet = alphabet.when(plain.rlike(pattern), F.lit(letters))
    alphabet = alphabet.otherwise(F.lit(_B64))
    return _let(F.struct(bare.alias("t"), alphabet.alias("a")), lambda x: _let(_symbols(x), lambda y: _let(_statistics(y), _combined)))


def _symbols(x: Column) -> Column:
    """v: each character's place in the alphabet, k: the alphabet's size, l and c: how many letters, and common ones, m, d and e: how many pairs of neighbouring letters, those that are common in prose, and those of a vowel and another letter (0 where the alphabet isn't of all letters)."""
    places = F.transform(F.split(x["t"], ""), lambda c: F.instr(x["a"], c).cast("double"))
    letters = lambda other: F.when(F.length(x["a"]) > 16, F.length(F.regexp_replace(x["t"], other, "")).cast("double")).otherwise(F.lit(0.0))
    pairs = lambda between: F.when(F.length(x["a"]) > 16, F.length(F.regexp_replace(x["t"], between, " ")).cast("double") - F.length(x["t"])).otherwise(F.lit(0.0))
    return F.struct(F.filter(places, lambda e: e > 0).alias("v"), F.length(x["a"]).cast("double").alias("k"), letters("[^A-Za-z]").alias("l"), letters(f"[^{_COMMON}{_COMMON.upper()}]").alias("c"), pairs(r"(?<=[A-Za-z])(?=[A-Za-z])").alias("m"), pairs(f"(?i)(?={'|'.join(_PAIRS)})").alias("d"), pairs(f"(?i)(?<=[{_VOWELS}])(?=[a-z&&[^{_VOWELS}]])|(?<=[a-z&&[^{_VOWELS}]])(?=[{_VOWELS}])").alias("e"))


def _statistics(y: Column) -> Column:
    v, k = y["v"], y["k"]
    last = F.greatest(F.size(v) - 1, F.lit(0))
    pairs = F.arrays_zip(F.slice(v, F.lit(1), last).alias("a"), F.slice(v, F.lit(2), last).alias("b"))
    squares = _sum(F.transform(F.array_distinct(v), lambda d: F.pow(F.size(F.filter(v, lambda e: e == d)).cast("double"), 2)))
    return F.struct(
        k.alias("k"),
        y["l"].alias("l"),
        y["c"].alias("c"),
        y["m"].alias("m"),
        y["d"].alias("d"),
        y["e"].alias("e"),
        F.size(v).cast("double").alias("n"),
        squares.alias("squares"),
        F.size(F.filter(v, lambda e: e > k / 2)).cast("double").alias("high"),
        _let(pairs, lambda p: F.struct(F.size(F.filter(p, lambda q: (q["a"] > k / 2) != (q["b"] > k / 2))).cast("double").alias("turns"), _sum(F.transform(p, lambda q: (q["a"] - (k + 1) / 2) * (q["b"] - (k + 1) / 2))).alias("serial"))).alias("pairs"),
    )


def _combined(x: Column) -> Column:
    n, k = x["n"], x["k"]
    df = k - 1
    # chi-squared uniformity, by the Wilson-Hilferty cube root
    chi = F.pow(F.greatest(k / n * x["squares"] - n, F.lit(0.0)) / df, F.lit(1 / 3))
    z1 = (chi - (1 - 2 / (9 * df))) / F.sqrt(2 / (9 * df))
    # runs above and below the alphabet's middle
    mean = 2 * x["high"] * (n - x["high"]) / n + 1
    z2 = _let(mean, lambda m: F.when(m > 2, F.abs(1 + x["pairs"]["turns"] - m) / F.sqrt((m - 1) * (m - 2) / (n - 1))).otherwise(F.lit(8.0)))
    # serial correlation about the middle
    z3 = F.abs(x["pairs"]["serial"]) / ((k * k - 1) / 12) / F.sqrt(F.greatest(n - 1, F.lit(1.0)))
    # letters that are common in prose, more than ten in 26
    q = len(_COMMON) / 26
    z4 = (x["c"] - q * x["l"]) / F.sqrt(F.greatest(q * (1 - q) * x["l"], F.lit(1e-9)))
    # neighbouring letters that are common pairs, more than so many in 26 * 26
    r = len(set(_PAIRS)) / 26**2
    z5 = (x["d"] - r * x["m"]) / F.sqrt(F.greatest(r * (1 - r) * x["m"], F.lit(1e-9)))
    # neighbours of a vowel and another letter, more than so many in 26 * 26
    v = 2 * len(_VOWELS) * (26 - len(_VOWELS)) / 26**2
    z6 = (x["e"] - v * x["m"]) / F.sqrt(F.greatest(v * (1 - v) * x["m"], F.lit(1e-9)))
    tails = F.array(_let(z1, _upper_tail), 2 * _let(z2, _upper_tail), 2 * _let(z3, _upper_tail), F.when(x["l"] > 0, _let(z4, _upper_tail)).otherwise(1.0), F.when(x["l"] > 0, _let(z5, _upper_tail)).otherwise(1.0), F.when(x["l"] > 0, _let(z6, _upper_tail)).otherwise(1.0))
    # half of Fisher's statistic, which has twelve degrees of freedom, or six without letters
    half = -_sum(F.transform(tails, lambda q: F.ln(F.least(F.greatest(q, F.lit(1e-30)), F.lit(1.0)))))
    return F.when(n >= 16, _let(half, lambda h: F.exp(-h) * (1 + h + h * h / 2 + F.when(x["l"] > 0, h * h * h / 6 + h * h * h * h / 24 + h * h * h * h * h / 120).otherwise(0.0)))).otherwise(F.lit(0.0))


def _length_class(length: Column) -> Column:
    return F.least(F.floor(F.log2(length / 16.0) * 2), F.lit(CLASSES - 1)).cast("int")


def _bin(p: Column) -> Column:
    return F.least(F.floor(-4 * F.log10(F.greatest(p, F.lit(1e-99)))), F.lit(BINS - 1)).cast("int")


def thresholds(tokens: DataFrame) -> dict[int, int]:
    """For each class of length the first bin whose tokens are rejected, over tokens(len, p).

    Benjamini-Hochberg on the histogram: the largest p such that p * all <= RATE * (tokens up to p).
    """
    rows = tokens.groupBy(_length_class(F.col("len")).alias("c"), _bin(F.col("p")).alias("b")).count().collect()  # at most CLASSES * BINS rows
    out = {}
    for c in range(CLASSES):
        n = {r["b"]: r["count"] for r in rows if r["c"] == c}
        total, below, first = sum(n.values()), 0, BINS
        for b in sorted(n, reverse=True):
            below += n[b]
            if 10 ** (-b / 4) * total <= RATE * below:
                first = b
        out[c] = first
    return out


def find_secrets(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """docs(doc_id, text, ...) -> (doc_id, base, added), arrays of spans (kind, start, end, text).

    Whole texts; positions in code points, end exclusive; added holds the battery's spans, which touch
    no base span. A null text counts as empty and has no spans. Repeated rows are scanned as often as
    they stand; other columns are ignored; an empty table gives no rows.
    """
    store = Store(spark, "secrets")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    with_base = rows.select("doc_id", "text", base_spans(F.col("text")).alias("base"))
    empty = F.array().cast("array<struct<kind:string,start:int,end:int,text:string>>")
    tokens = with_base.select("doc_id", "base", F.when(F.col("text").rlike(TOKEN), candidates(F.col("text"), F.col("base"))).otherwise(empty).alias("tokens"))
    # spans and p-values are found once; the corpus isn't read again for the thresholds
    found = store.keep(tokens.select("doc_id", "base", F.transform("tokens", lambda s: F.struct(s.alias("span"), battery(s["text"]).alias("p"))).alias("tokens")), "tokens")
    cut = thresholds(found.select(F.explode("tokens").alias("t")).select(F.length("t.span.text").alias("len"), "t.p"))
    limit = F.create_map(*[F.lit(x) for kv in cut.items() for x in kv])
    stands = F.filter("tokens", lambda t: _bin(t["p"]) < F.element_at(limit, _length_class(F.length(t["span"]["text"]))))
    return found.select("doc_id", "base", F.transform(stands, lambda t: t["span"]).alias("added"))


def join_spans(spans: Column) -> Column:
    """kind:start:end by start, then kind as listed, comma-joined."""
    order = F.create_map(*[x for i, k in enumerate(KINDS) for x in (F.lit(k), F.lit(i))])
    keyed = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("a"), F.element_at(order, s["kind"]).alias("b"), s["end"].alias("c"), s["kind"].alias("kind"))))
    return F.array_join(F.transform(keyed, lambda s: F.concat_ws(":", s["kind"], s["a"], s["c"])), ",")
