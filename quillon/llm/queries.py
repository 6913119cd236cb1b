"""The registered queries of this subpackage and the SQL they are held against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillon.llm import bpe, chat, decontam, divergence, knnquality, langid, licenses, linedup, lmquality, neardup, rans, secrets, vectorcodes
from quillon.llm._ship import ship

TOKENIZER, BYTE_TOKENIZER = "word_bpe_49k.json", "byte_bpe_50k.json"


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(spark, _read(spark, sf_dir, "documents"))


def op2_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(spark, _read(spark, sf_dir, "documents"))


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_digests(spark, _read(spark, sf_dir, "documents"), tokenizer_path())


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lmquality.judge(spark, _read(spark, sf_dir, "documents")).select("doc_id", *lmquality.FEATURES, "base_failed", "kept", "log_ppl")


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return knnquality.classify(spark, _read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find_secrets(spark, _read(spark, sf_dir, "documents"))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", count("assign"), count("access"), count("hex"), F.sha2(secrets.join_spans(F.col("base")), 256).alias("base_sha256"), secrets.join_spans(F.concat("base", "added")).alias("spans"))


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan_licenses(_read(spark, sf_dir, "documents"))
    return found.select("doc_id", F.size("spans").cast("long").alias("n_licenses"), F.array_join(F.transform("spans", lambda s: F.concat_ws(":", s["license"], s["start"], s["end"])), ",").alias("licenses"))


def op8_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "\\### Assistant: </turn> ok"
    own = spark.range(1).select(F.lit(-7).cast("long").alias("conv_id"), F.explode(F.array(F.struct(F.lit(0).cast("long").alias("turn"), F.lit("user").alias("role")), F.struct(F.lit(1).cast("long").alias("turn"), F.lit("assistant").alias("role")))).alias("x"))
    own = own.select("conv_id", "x.turn", "x.role", F.lit(said).alias("text"))
    done = chat.format_conversations(_read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(own))
    back = done.select("conv_id", chat.read_turns(F.col("formatted")).alias("turns"), chat.loss_text(F.col("segments")).alias("loss"), F.length("formatted").cast("long").alias("formatted_chars"))
    said_all = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(said_all, 256).alias("turns_sha256"), F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars")


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linedup.drop_boilerplate(spark, _read(spark, sf_dir, "documents")).select("doc_id", "n_lines", "n_removed", "text")


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.find_leaks(spark, _read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(spark, _read(spark, sf_dir, "documents"))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectorcodes.compress(spark, _read(spark, sf_dir, "embeddings")).select("vec_id", "code", "error", "label_error", "codebooks_sha256")


def op13_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rans.round_trip(spark, _read(spark, sf_dir, "documents"), tokenizer_path(BYTE_TOKENIZER))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    ship(spark)
    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = [op1_language_id, op2_near_duplicates, op3_bpe, op4_quality_rules, op5_quality_classifier, op6_secret_scan, op7_license_scan, op8_chat_format, op9_line_dedup, op10_decontamination, op11_source_divergence, op12_vector_codes, op13_token_files, pipeline]
    return {f.__name__: f for f in found}


_SETS = r"""
w AS (SELECT {id} AS id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM {table}),
s AS (SELECT id, list_distinct(CASE WHEN len(w) >= 5 THEN [array_to_string(w[i:i + 4], ' ') for i in range(1, len(w) - 3)] WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE []::VARCHAR[] END) AS s FROM w)
"""

ORACLE_OP2 = (
    "WITH RECURSIVE "
    + _SETS.format(id="doc_id", table="documents")
    + """,
e AS (SELECT id, len(s) AS n, unnest(s) AS g FROM s),
c AS (SELECT a.id AS x, b.id AS y, any_value(a.n) AS na, any_value(b.n) AS nb, count(*) AS k FROM e a JOIN e b ON a.g = b.g AND a.id <> b.id GROUP BY 1, 2),
l AS (SELECT x, y FROM c WHERE 100 * k >= 85 * (na + nb - k)),
r(id, root) AS (SELECT id, id FROM s UNION SELECT l.y, r.root FROM r JOIN l ON l.x = r.id)
SELECT s.id AS doc_id, len(s.s)::BIGINT AS n_shingles, m.root AS component_id, s.id = m.root AS kept
FROM s JOIN (SELECT id, min(root) AS root FROM r GROUP BY 1) m ON m.id = s.id
"""
)

ORACLE_OP8 = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
p AS (SELECT *, role IS NOT DISTINCT FROM lag(role) OVER w AND lag(turn) OVER w IS NOT NULL AS joined FROM t WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text)),
f AS (SELECT *, length(replace(replace(text, '\', '\b'), '<', '\l')) + CASE WHEN joined THEN 6 ELSE 15 + length(replace(replace(role, '\', '\b'), '<', '\l')) END AS chars FROM p)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256, sum(chars)::BIGINT AS formatted_chars
FROM f GROUP BY conv_id
"""

ORACLE_OP9 = r"""
WITH l AS (SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM documents WHERE text IS NOT NULL),
b AS (SELECT line, min((doc_id, pos)) AS first FROM l WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY line HAVING count(DISTINCT source) >= 5),
k AS (SELECT l.*, b.line IS NOT NULL AND (l.doc_id, l.pos) <> b.first AS gone FROM l LEFT JOIN b USING (line))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_removed, coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '') AS text FROM k GROUP BY doc_id
"""

ORACLE_OP10 = (
    "WITH "
    + _SETS.format(id="doc_id", table="documents")
    + ", "
    + _SETS.format(id="item_id", table="benchmark").replace("w AS", "bw AS").replace("FROM w)", "FROM bw)").replace("s AS (SELECT id, list", "bs AS (SELECT id, list")
    + """
SELECT d.id AS doc_id, b.id AS item_id, any_value(b.n)::BIGINT AS n_item, count(*) AS n_shared
FROM (SELECT id, unnest(s) AS g FROM s) d JOIN (SELECT id, len(s) AS n, unnest(s) AS g FROM bs) b ON d.g = b.g
GROUP BY 1, 2 HAVING 100 * count(*) >= 80 * any_value(b.n)
"""
)

ORACLE_OP11 = r"""
WITH d AS (SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, row_number() OVER () AS row,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
t AS (SELECT lang, source, row, unnest(w) AS term FROM d),
k AS MATERIALIZED (SELECT lang, term, count(*) AS n FROM t GROUP BY ALL HAVING count(DISTINCT row) >= 3),
g AS (SELECT DISTINCT lang, source FROM d),
c AS MATERIALIZED (SELECT g.lang, g.source, k.term, coalesce(x.n, 0) AS n FROM g JOIN k USING (lang) LEFT JOIN (SELECT lang, source, term, count(*) AS n FROM t GROUP BY ALL) x ON x.lang = g.lang AND x.source = g.source AND x.term = k.term),
p AS MATERIALIZED (SELECT lang, source, term, n, 1 + 1000000000::HUGEINT * (n + 1) // (sum(n) OVER w + count(*) OVER w) AS p FROM c WINDOW w AS (PARTITION BY lang, source)),
q AS (SELECT lang, term, 1 + 1000000000::HUGEINT * (n + 1) // (sum(n) OVER w + count(*) OVER w) AS q FROM k WINDOW w AS (PARTITION BY lang)),
f AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
r AS (SELECT g.lang, g.source, 'pair' AS part, h.source AS item, coalesce(f.value, 0)::BIGINT AS value FROM g JOIN g h ON g.lang = h.lang AND g.source <> h.source LEFT JOIN f ON f.lang = g.lang AND f.source = g.source AND f.item = h.source
  UNION ALL SELECT lang, source, 'term', term, ((p - q) * (p - q) // q)::BIGINT FROM p JOIN q USING (lang, term) WHERE n > 0 AND p > q)
SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank FROM r QUALIFY part = 'pair' OR rank <= 200
"""

_NEAREST = """
d{i} AS (SELECT x.row, x.part, c.entry, list_sum([(z[1] - z[2]) * (z[1] - z[2]) for z in list_zip(x.v, c.v)])::BIGINT AS far FROM parts x JOIN c{i} c USING (part)),
a{i} AS MATERIALIZED (SELECT row, part, min((far, entry)) AS best FROM d{i} GROUP BY ALL)"""
_ROUND = """,
s{i} AS (SELECT a.part, a.best[2] AS entry, u.place, sum(x.v[u.place])::HUGEINT AS s, count(*)::HUGEINT AS n FROM a{i} a JOIN parts x USING (row, part) JOIN places u ON true GROUP BY ALL),
c{j} AS MATERIALIZED (SELECT c.part, c.entry, coalesce(any_value(m.v), any_value(c.v)) AS v FROM c{i} c LEFT JOIN (SELECT part, entry, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY place) AS v FROM s{i} GROUP BY ALL) m ON m.part = c.part AND m.entry = c.entry GROUP BY ALL),"""

ORACLE_OP12 = (
    """
WITH kept AS MATERIALIZED (SELECT vec_id, label, row_number() OVER (ORDER BY vec_id, embedding) AS row, [floor(256 * x::DOUBLE)::BIGINT for x in embedding] AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
width AS (SELECT any_value(len(v)) // 16 AS w FROM kept),
places AS (SELECT unnest(range(1, w + 1)) AS place FROM width),
parts AS MATERIALIZED (SELECT row, part, v[part * w + 1:part * w + w] AS v FROM kept, width, (SELECT unnest(range(16)) AS part)),
c0 AS MATERIALIZED (SELECT part, row - 1 AS entry, v FROM parts WHERE row <= 64),"""
    + "".join(_NEAREST.format(i=i) + (_ROUND.format(i=i, j=i + 1) if i < 2 else "") for i in range(3))
    + """,
e AS (SELECT row, string_agg(printf('%02x', best[2]), '' ORDER BY part) AS code, sum(best[1])::BIGINT AS error FROM a2 GROUP BY row),
h AS (SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY part, entry)) AS h FROM c2)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, h AS codebooks_sha256 FROM kept JOIN e USING (row), h
"""
)


def oracle_sql() -> dict[str, str]:
    """The others learn or tokenize, which SQL can't express; their tests use brute force."""
    return {"op2_near_duplicates": ORACLE_OP2, "op8_chat_format": ORACLE_OP8, "op9_line_dedup": ORACLE_OP9, "op10_decontamination": ORACLE_OP10, "op11_source_divergence": ORACLE_OP11, "op12_vector_codes": ORACLE_OP12}
