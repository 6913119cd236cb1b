"""Queries over the test tables that show each operator, with the SQL they are held against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillon import landing_queries, table_queries
from quillon.functions import dates, numbers, text
from quillon.operators import canonical, profile, quarantine
from quillon.operators.quality import Rule, run_rules
from quillon.plans import gold, regional, silver
from quillon.sources import landing, readers

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_SQL: dict[str, str] = {}


def _query(sql: str | None = None):
    def add(f):
        _QUERIES[f.__name__] = f
        if sql:
            _SQL[f.__name__] = sql
        return f

    return add


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return _QUERIES | table_queries.queries() | landing_queries.queries()


def oracle_sql() -> dict[str, str]:
    return _SQL | table_queries.oracle_sql() | landing_queries.oracle_sql()


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- gold marts -----------------------------------------------------------------------------------

_C = lambda x: f"CAST(floor({x} * 100 + 0.5) AS BIGINT)"
_BUDGET_SQL = f"""b AS (SELECT year(l_shipdate) AS year, CAST(sum({_C('l_extendedprice')}) AS BIGINT) AS opening,
  CAST(sum({_C('l_extendedprice * (1 + l_tax)')}) AS BIGINT) AS modified, CAST(sum({_C('l_extendedprice * (1 - l_discount)')}) AS BIGINT) AS executed FROM lineitem GROUP BY 1)"""
_EXECUTION_SQL = """round(100.0::DOUBLE * executed / nullif(modified, 0), 6) AS execution_percent, round(100.0::DOUBLE * (modified - opening) / nullif(opening, 0), 6) AS modification_percent"""


def _execution(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "lineitem").withColumn("year", F.year("l_shipdate"))
    price = F.col("l_extendedprice")
    return gold.execution(rows, ["year"], price, price * (1 + F.col("l_tax")), price * (1 - F.col("l_discount")))


@_query(f"WITH {_BUDGET_SQL} SELECT year, opening, modified, executed, modified - executed AS balance, {_EXECUTION_SQL} FROM b")
def gold_execution_annual(spark, sf_dir):
    return _execution(spark, sf_dir)


@_query(f"""WITH {_BUDGET_SQL}, g AS (SELECT year(o_orderdate) AS year, count(*) AS grants FROM orders GROUP BY 1)
SELECT year, grants, executed, round((executed / 100.0::DOUBLE) / nullif(grants, 0)::DOUBLE, 4) AS cost_per_grant FROM g FULL JOIN b USING (year)""")
def gold_grants_vs_budget(spark, sf_dir):
    grants = _table(spark, sf_dir, "orders").groupBy(F.year("o_orderdate").alias("year")).agg(F.count("*").alias("grants"))
    return gold.unit_cost(grants, _execution(spark, sf_dir).select("year", "executed"), "year")


@_query("""WITH c AS (SELECT r_name AS region, n_name AS member, count(c_custkey) AS customers FROM nation JOIN region ON n_regionkey = r_regionkey LEFT JOIN customer ON c_nationkey = n_nationkey GROUP BY 1, 2)
SELECT *, round(100.0::DOUBLE * customers / nullif(sum(customers) OVER (PARTITION BY region), 0)::BIGINT, 6) AS share_percent, rank() OVER (PARTITION BY region ORDER BY customers DESC) AS rank,
  CAST(sum(customers) OVER (PARTITION BY region ORDER BY customers DESC, member ROWS UNBOUNDED PRECEDING) AS BIGINT) AS running FROM c""")
def gold_territorial_coverage(spark, sf_dir):
    nation = _table(spark, sf_dir, "nation").join(_table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    count = _table(spark, sf_dir, "customer").groupBy("c_nationkey").agg(F.count("c_custkey").alias("customers"))
    counts = nation.join(count, F.col("n_nationkey") == F.col("c_nationkey"), "left").select(F.col("r_name").alias("region"), F.col("n_name").alias("member"), F.coalesce("customers", F.lit(0)).alias("customers"))
    return gold.coverage_shares(counts, "region", "customers")


@_query(f"""SELECT 'orders' AS indicator, year(o_orderdate) AS period, o_orderpriority AS member, count(*) AS value FROM orders GROUP BY 2, 3
UNION ALL SELECT 'shipped_cents', year(l_shipdate), l_returnflag, CAST(sum({_C('l_extendedprice')}) AS BIGINT) FROM lineitem GROUP BY 2, 3
UNION ALL SELECT 'users', year(ts), event_type, count(DISTINCT user_id) FROM events GROUP BY 2, 3""")
def gold_indicator_union(spark, sf_dir):
    o, li, e = (_table(spark, sf_dir, t) for t in ("orders", "lineitem", "events"))
    return gold.union_indicators(
        [
            gold.indicator(o, "orders", F.year("o_orderdate"), F.col("o_orderpriority"), F.count("*")),
            gold.indicator(li, "shipped_cents", F.year("l_shipdate"), F.col("l_returnflag"), F.sum(gold.cents(F.col("l_extendedprice")))),
            gold.indicator(e, "users", F.year("ts"), F.col("event_type"), F.countDistinct("user_id")),
        ]
    )


@_query(f"""WITH {_BUDGET_SQL} SELECT (SELECT count(*) FROM orders) AS grants, (SELECT count(DISTINCT o_custkey) FROM orders) AS grantees,
  CAST(sum(executed) AS BIGINT) AS executed, min(year) AS first_year, max(year) AS last_year FROM b""")
def gold_executive_summary(spark, sf_dir):
    g = _table(spark, sf_dir, "orders").agg(F.count("*").alias("grants"), F.countDistinct("o_custkey").alias("grantees")).withColumn("one", F.lit(1))
    b = _execution(spark, sf_dir).agg(F.sum("executed").alias("executed"), F.min("year").alias("first_year"), F.max("year").alias("last_year")).withColumn("one", F.lit(1))
    return g.join(b, "one").drop("one")


# --- text, numbers, dates -------------------------------------------------------------------------


@_query(r"""SELECT p_partkey, nullif(trim(regexp_replace(regexp_replace(upper(strip_accents(trim(regexp_replace(p_type || ' - ' || p_name, '\s+', ' ', 'g')))), '[[:punct:]]', ' ', 'g'), '\s+', ' ', 'g')), '') AS key FROM part""")
def text_match_key(spark, sf_dir):
    return _table(spark, sf_dir, "part").select("p_partkey", text.match_key(F.concat("p_type", F.lit(" - "), "p_name")).alias("key"))


_ISSUE_SQL = {
    "LEADING_OR_TRAILING_SPACE": r"regexp_matches(t, '^[\s\x{A0}]|[\s\x{A0}]$')",
    "REPEATED_SPACES": "contains(t, '  ')",
    "TAB_OR_NEWLINE": r"regexp_matches(t, '[\t\r\n]')",
    "MOJIBAKE_PATTERN": "regexp_matches(t, '[ÃÂâðÐ�]')",
    "REPLACEMENT_CHARACTER": "contains(t, chr(65533))",
    "ACCENTED_CHARACTER": "strip_accents(t) <> t",
    "NON_ASCII_CHARACTER": r"regexp_matches(t, '[^\x00-\x7F]')",
    "SUSPICIOUS_SYMBOL": r"regexp_matches(t, '[@#$%^*_=+~`|\\<>\[\]{}]')",
    "LOWERCASE_OR_MIXED_CASE": r"regexp_matches(t, '\p{Ll}')",
    "PUNCTUATION_VARIANT": "regexp_matches(t, '[-/()]')",
    "LONG_TEXT_VARIANT": r"length(trim(regexp_replace(t, '[\s\x{A0}]+', ' ', 'g'))) >= 50",
}


@_query("SELECT doc_id, " + ", ".join(f"{test} AS {code.lower()}" for code, test in _ISSUE_SQL.items()) + r" FROM (SELECT doc_id, text AS t FROM documents) WHERE regexp_matches(t, '[^\s\x{A0}]')")
def text_issue_codes(spark, sf_dir):
    filled = _table(spark, sf_dir, "documents").where(F.col("text").rlike(r"(?U)\S"))  # before the codes, so that these are found once
    d = filled.select("doc_id", text.issues(F.col("text")).alias("i"))
    return d.select("doc_id", *[F.array_contains("i", code).alias(code.lower()) for code in _ISSUE_SQL])


@_query(" UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count(*) AS n, count(DISTINCT t) AS distinct_values, count(*) FILTER (coalesce(trim(t), '') = '') AS empty_or_whitespace, 0::BIGINT AS control_character, {', '.join(f"count(*) FILTER (trim(t) <> '' AND {test}) AS {code.lower()}" for code, test in _ISSUE_SQL.items())} FROM (SELECT {c} AS t FROM documents)"""
    for c in ("text", "source")))
def text_issue_summary(spark, sf_dir):
    return profile.issue_summary(_table(spark, sf_dir, "documents"), ["text", "source"])


@_query(f"""WITH v AS (SELECT c_mktsegment || repeat(' ', (c_custkey % 3)::INT) || CASE WHEN c_custkey % 4 = 0 THEN '_x' ELSE '' END AS t, count(*) AS times, min(c_custkey) AS example_id FROM customer GROUP BY 1)
SELECT 'segment' AS "column", t AS value, issue, times, trim(regexp_replace(t, '\\s+', ' ', 'g')) AS suggested, trim(regexp_replace(replace(t, '_x', ' X'), '\\s+', ' ', 'g')) AS key, example_id FROM (
  {' UNION ALL '.join(f"SELECT *, '{code}' AS issue FROM v WHERE {_ISSUE_SQL[code]}" for code in ('LEADING_OR_TRAILING_SPACE', 'REPEATED_SPACES', 'SUSPICIOUS_SYMBOL'))})""")
def text_anomalies(spark, sf_dir):
    k = F.col("c_custkey")
    c = _table(spark, sf_dir, "customer").select("c_custkey", F.concat("c_mktsegment", F.element_at(F.array(F.lit(""), F.lit(" "), F.lit("  ")), (k % 3 + 1).cast("int")), F.when(k % 4 == 0, "_x").otherwise("")).alias("segment"))
    return profile.anomalies(c, ["segment"], "c_custkey")


@_query("""WITH v AS (SELECT 'Señor ' || chr(9) || event_type AS t, count(*) AS times FROM events GROUP BY 1), r AS (SELECT *, row_number() OVER (ORDER BY times DESC, t)::INTEGER AS place FROM v QUALIFY place <= 3)
SELECT 'kind' AS "column", times, place, t AS original_value, t AS after_fix_mojibake, replace(t, chr(9), ' ') AS after_remove_control_chars, replace(t, ' ' || chr(9), ' ') AS after_normalize_whitespace, replace(replace(t, ' ' || chr(9), ' '), 'ñ', 'n') AS after_strip_accents,
  trim(regexp_replace(upper(replace(replace(t, ' ' || chr(9), ' '), 'ñ', 'n')), '[_ ]+', ' ', 'g')) AS after_normalize_for_matching FROM r""")
def text_preview(spark, sf_dir):
    e = _table(spark, sf_dir, "events").select(F.concat(F.lit("Señor \t"), "event_type").alias("kind"))
    return profile.normalisation_preview(e, ["kind"], 3).drop("issues")


@_query("""WITH v AS (SELECT event_type AS value, count(*) AS times FROM events WHERE trim(event_type) <> '' GROUP BY 1)
SELECT 'event_type' AS "column", value, times, round(100 * times / (SELECT sum(times) FROM v), 4)::DOUBLE AS share_percent, row_number() OVER (ORDER BY times DESC, value)::INTEGER AS place FROM v QUALIFY place <= 10""")
def text_frequent_values(spark, sf_dir):
    return profile.top_values(_table(spark, sf_dir, "events"), ["event_type"])


@_query("""WITH v AS (SELECT CASE c_custkey % 3 WHEN 0 THEN c_mktsegment WHEN 1 THEN lower(c_mktsegment) ELSE ' ' || c_mktsegment || '.' END AS value, count(*) AS times FROM customer GROUP BY 1)
SELECT 'segment' AS "column", trim(upper(replace(value, '.', ' '))) AS key, count(*) AS spellings, CAST(sum(times) AS BIGINT) AS times, string_agg(value, ' | ' ORDER BY value) AS originals FROM v GROUP BY 2 HAVING count(*) > 1""")
def text_alias_groups(spark, sf_dir):
    c, m = F.col("c_mktsegment"), F.col("c_custkey") % 3
    spelled = F.when(m == 0, c).when(m == 1, F.lower(c)).otherwise(F.concat(F.lit(" "), c, F.lit(".")))
    return profile.alias_groups(_table(spark, sf_dir, "customer").select(spelled.alias("segment")), ["segment"])


@_query("WITH d AS (SELECT doc_id, regexp_replace(text, '[ÃÂâðÐ]', '', 'g') AS t FROM documents WHERE text IS NOT NULL) SELECT doc_id, t AS repaired, strip_accents(t) <> t AS had_accents FROM d")
def mojibake_repair(spark, sf_dir):
    """Whole texts in four languages, spoiled by one wrong decoding, come back as they were.

    A column a document: what was spoiled and repaired, and whether it holds accents that could be spoiled.
    """
    plain = _table(spark, sf_dir, "documents").where("text IS NOT NULL").select("doc_id", F.regexp_replace("text", "[ÃÂâðÐ]", "").alias("plain"))
    spoiled = F.decode(F.encode(F.col("plain"), "UTF-8"), "ISO-8859-1")
    return plain.select("doc_id", text.repair_mojibake(spoiled).alias("repaired"), text.has_accents(F.col("plain")).alias("had_accents"))


def _price_text(k: int) -> Column:
    """Cents of a price as text in one of three spellings."""
    c = gold.cents(F.col("l_extendedprice"))
    whole, part = F.floor(c / 100).cast("string"), F.lpad((c % 100).cast("string"), 2, "0")
    return F.concat(F.lit("$ "), whole, F.lit(".,"[k]), part, F.lit(" "))


_LINE = f"SELECT l_orderkey, l_linenumber, {_C('l_extendedprice')} AS c FROM lineitem"


@_query(f"""SELECT l_orderkey, l_linenumber, c / 100.0::DOUBLE AS dotted, c / 100.0::DOUBLE AS comma, NULL::DOUBLE AS ambiguous, (c // 100) AS whole FROM ({_LINE})""")
def num_parse_safe(spark, sf_dir):
    c = gold.cents(F.col("l_extendedprice"))
    ambiguous = F.concat(F.floor(c / 100 % 900 + 1).cast("string"), F.lit(",123"))
    return _table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", numbers.numeric_safe(_price_text(0)).alias("dotted"), numbers.numeric_safe(_price_text(1)).alias("comma"), numbers.numeric_safe(ambiguous).alias("ambiguous"), numbers.int_safe((c / 100).cast("decimal(20,2)").cast("string")).alias("whole"))


@_query(f"""SELECT l_orderkey, l_linenumber, ((c // 100) % 900 + 1) * 1000.0 + 123 AS thousands, c / 100.0::DOUBLE AS comma, NULL::DOUBLE AS dash FROM ({_LINE})""")
def num_parse_budget(spark, sf_dir):
    c = gold.cents(F.col("l_extendedprice"))
    thousands = F.concat((F.floor(c / 100) % 900 + 1).cast("string"), F.lit(",123"))
    comma = F.concat(F.floor(c / 100).cast("string"), F.lit(","), F.lpad((c % 100).cast("string"), 2, "0"))
    return _table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", numbers.budget_numeric(thousands).alias("thousands"), numbers.budget_numeric(comma).alias("comma"), numbers.budget_numeric(F.lit("-")).alias("dash"))


@_query("""SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN NULL WHEN o_orderkey % 5 = 1 THEN 0 ELSE o_custkey END AS with_zero, CASE WHEN o_orderkey % 5 > 1 THEN o_custkey::DOUBLE END AS number FROM orders""")
def num_parse_report(spark, sf_dir):
    m = F.col("o_orderkey") % 5
    raw = F.when(m == 0, "N.D.").when(m == 1, "-").otherwise(F.concat(F.lit(" "), F.col("o_custkey").cast("string")))
    return _table(spark, sf_dir, "orders").select("o_orderkey", numbers.report_int(raw, zero_dash=True).alias("with_zero"), numbers.report_numeric(F.when(m > 1, F.concat(F.col("o_custkey").cast("string"), F.lit(".0"))).otherwise(raw)).alias("number"))


@_query("SELECT o_orderkey, CASE WHEN o_orderkey % 7 > 0 THEN o_orderdate::DATE END AS day, date_trunc('month', o_orderdate)::DATE AS month FROM orders")
def date_parse(spark, sf_dir):
    shown = F.when(F.col("o_orderkey") % 7 > 0, F.date_format("o_orderdate", "dd/MM/yyyy")).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    return _table(spark, sf_dir, "orders").select("o_orderkey", dates.snapshot_date(shown).alias("day"), dates.month_start(F.year("o_orderdate"), F.month("o_orderdate")).alias("month"))


@_query(f"""SELECT l_orderkey, l_linenumber, CAST((CAST(c AS HUGEINT) * 10000000000 // ((l_orderkey % 9) * 7)) // 10 + CASE WHEN (CAST(c AS HUGEINT) * 10000000000 // ((l_orderkey % 9) * 7)) % 10 >= 5 THEN 1 ELSE 0 END AS BIGINT) AS nano FROM ({_LINE}) WHERE l_orderkey % 9 > 0
UNION ALL SELECT l_orderkey, l_linenumber, NULL FROM ({_LINE}) WHERE l_orderkey % 9 = 0""")
def ratio_half_up(spark, sf_dir):
    r = numbers.ratio9(gold.cents(F.col("l_extendedprice")), F.col("l_orderkey") % 9 * 7)
    return _table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", (r * 1_000_000_000).cast("bigint").alias("nano"))


@_query("""WITH y AS (SELECT unnest(range(1995, 2002)) AS year), p AS (SELECT DISTINCT o_orderpriority FROM orders)
SELECT o_orderpriority, y.year::VARCHAR AS year, count(o_orderkey) AS orders FROM p CROSS JOIN y LEFT JOIN orders o USING (o_orderpriority) WHERE o.o_orderkey IS NULL OR year(o_orderdate) = y.year GROUP BY 1, 2""")
def unpivot_wide_annual(spark, sf_dir):
    years = list(range(1995, 2002))
    wide = _table(spark, sf_dir, "orders").groupBy("o_orderpriority").agg(*[F.count_if(F.year("o_orderdate") == y).alias(str(y)) for y in years])
    return silver.unpivot_years(wide, ["o_orderpriority"], "orders").select("o_orderpriority", F.col("ano_convocatoria").cast("string").alias("year"), F.col("orders").cast("bigint").alias("orders"))


# --- validation, canonical values, landing --------------------------------------------------------


def _checked_orders(spark, sf_dir):
    k = F.col("o_orderkey")
    o = _table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(k % 11 == 0, F.lit(None)).when(k % 13 == 0, F.lit(" ")).otherwise(F.col("o_orderpriority")).alias("priority"),
        F.when(k % 17 == 0, F.lit("x1")).when(k % 19 == 0, F.lit("-5")).otherwise(F.col("o_custkey").cast("string")).alias("amount"),
    )
    return quarantine.with_errors(o, [*quarantine.required(o, ["priority"]), *quarantine.numeric_range("amount", low=0)])


_ERRORS_SQL = """concat_ws(',', CASE WHEN o_orderkey % 11 = 0 THEN 'MISSING_FIELD' WHEN o_orderkey % 13 = 0 THEN 'BLANK_FIELD' END,
  CASE WHEN o_orderkey % 17 = 0 THEN 'INVALID_NUMERIC' WHEN o_orderkey % 19 = 0 THEN 'NUMERIC_BELOW_MIN' END)"""


@_query(f"SELECT * FROM (SELECT o_orderkey, {_ERRORS_SQL} AS codes FROM orders) WHERE codes <> ''")
def silver_quarantine_split(spark, sf_dir):
    _, bad = quarantine.split(_checked_orders(spark, sf_dir))
    return bad.select("o_orderkey", F.array_join("validation_errors.code", ",").alias("codes"))


@_query(f"""WITH c AS (SELECT {_ERRORS_SQL} = '' AS ok FROM orders) SELECT count(*) AS records_read, count(*) FILTER (ok) AS records_valid, count(*) FILTER (NOT ok) AS records_rejected,
  round(count(*) FILTER (NOT ok)::DOUBLE / count(*), 6) AS rejection_rate, 'COMPLETED_WITH_REJECTIONS' AS status FROM c""")
def silver_summary(spark, sf_dir):
    ok = F.size("validation_errors") == 0
    c = _checked_orders(spark, sf_dir).agg(F.count("*").alias("records_read"), F.count_if(ok).alias("records_valid"), F.count_if(~ok).alias("records_rejected"))
    return quarantine.summary(spark, c)


@_query("""SELECT c_custkey, CASE c_mktsegment WHEN 'BUILDING' THEN 'Construction' WHEN 'MACHINERY' THEN 'Industry' END AS segment_canonical, CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN 'manual_alias' END AS method,
  CASE c_mktsegment WHEN 'BUILDING' THEN false WHEN 'MACHINERY' THEN true END AS review FROM customer""")
def canonical_lookup(spark, sf_dir):
    entry = lambda value, alias, review: {"canonical_value": value, "aliases": [alias], "normalized_key": alias.upper(), "match_method": "manual_alias", "confidence": "high", "review_required": review}
    index = canonical.checked_index(canonical.load_catalog(spark, {"segment": [entry("Construction", "building", False), entry("Industry", "Machinery.", True)]}))
    c = _table(spark, sf_dir, "customer").select("c_custkey", F.lower("c_mktsegment").alias("segment"))
    return canonical.apply_canonical(c, index, {"segment": "segment"}).select("c_custkey", "segment_canonical", F.col("segment_canonical_match_method").alias("method"), F.col("segment_canonical_review_required").alias("review"))


@_query("""SELECT c_custkey, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE n_nationkey % 4 > 0""")
def region_key_join(spark, sf_dir):
    n = _table(spark, sf_dir, "nation")
    dim = n.where("n_nationkey % 4 > 0").select(text.region_key(F.col("n_name")).alias("region_key"), F.col("n_name").alias("region"))
    named = _table(spark, sf_dir, "customer").join(n, F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", F.concat(F.lit(" "), F.lower("n_name")).alias("name"))
    return canonical.join_region(named, dim, "name").select("c_custkey", F.col("canonical_region").alias("n_name"))


@_query("""SELECT event_id // 50 AS page, event_id::VARCHAR AS source_row_id, event_type AS kind, CASE WHEN event_id % 9 > 0 THEN props END AS props FROM events""")
def json_payload_flatten(spark, sf_dir):
    """Events as stored payloads of 50 rows, flattened again; some rows are a cell short."""
    cells = F.when(F.col("event_id") % 9 == 0, F.array("event_type")).otherwise(F.array("event_type", "props"))
    rows = F.collect_list(F.struct(F.col("event_id").cast("string").alias("id"), cells.alias("cell")))
    pages = _table(spark, sf_dir, "events").groupBy(F.floor(F.col("event_id") / 50).alias("page")).agg(rows.alias("rows"))
    payloads = pages.select(F.to_json(F.struct(F.col("page").cast("string").alias("page"), F.lit("9").alias("total"), F.lit("50").alias("records"), "rows")).alias("payload"))
    return readers.assert_columns(readers.flatten_pages(payloads, ["kind", "props"]), ["kind", "props"]).select("page", "source_row_id", "kind", "props")


@_query("SELECT event_type AS dataset, 50::BIGINT AS reported_records, count(DISTINCT event_id // 50) AS pages_read, min(event_id // 50) AS first_page, max(event_id // 50) AS last_page FROM events GROUP BY 1")
def json_page_totals(spark, sf_dir):
    pages = _table(spark, sf_dir, "events").select(F.col("event_type").alias("dataset"), F.floor(F.col("event_id") / 50).alias("page")).distinct()
    return readers.page_totals(pages.select("dataset", F.to_json(F.struct(F.col("page").cast("string").alias("page"), F.lit("50").alias("records"))).alias("payload")))


@_query("WITH c AS (SELECT o_orderpriority AS dataset, count(*) AS n FROM orders GROUP BY 1), d AS (SELECT dataset, (n + 99) // 100 AS pages FROM c) SELECT dataset, i AS chunk, (i - 1) * 7 + 1 AS page_start, least(i * 7, pages) AS page_end FROM (SELECT *, unnest(range(1, (pages + 6) // 7 + 1)) AS i FROM d)")
def page_range_split(spark, sf_dir):
    d = _table(spark, sf_dir, "orders").groupBy(F.col("o_orderpriority").alias("dataset")).agg(F.ceil(F.count("*") / 100).alias("total_pages")).withColumn("chunk_size", F.lit(7))
    return landing.split_pages(d).select("dataset", F.substring_index("chunk_id", "_", -1).cast("bigint").alias("chunk"), "page_start", "page_end")


@_query("""WITH e AS (SELECT year(o_orderdate)::VARCHAR AS dataset, count(*) AS expected FROM orders GROUP BY 1), w AS (SELECT year(l_shipdate)::VARCHAR AS dataset, count(DISTINCT l_orderkey) AS written FROM lineitem GROUP BY 1)
SELECT dataset, coalesce(expected, 0) AS expected, coalesce(written, 0) AS written, coalesce(expected, 0) = coalesce(written, 0) AS passed FROM e FULL JOIN w USING (dataset)""")
def count_reconciliation(spark, sf_dir):
    e = _table(spark, sf_dir, "orders").groupBy(F.year("o_orderdate").cast("string").alias("dataset")).agg(F.count("*").alias("records"))
    w = _table(spark, sf_dir, "lineitem").groupBy(F.year("l_shipdate").cast("string").alias("dataset")).agg(F.countDistinct("l_orderkey").alias("records"))
    return landing.reconcile_counts(w, e)


_LABEL_SQL = "trim(regexp_replace(replace(replace(replace(replace(replace(replace(regexp_replace(a, '(?s)<[^>]*>', ' ', 'g'), '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), '&#39;', chr(39)), '&amp;', '&'), '[\\s\\x{A0}]+', ' ', 'g'))"


@_query(rf"""WITH l AS (SELECT page_id, url, regexp_extract_all(html, '(?is)<a\b[^>]*>.*?</a>') AS l FROM pages), x AS (SELECT page_id, url, unnest(l) AS a, generate_subscripts(l, 1)::INTEGER - 1 AS link_no FROM l)
SELECT page_id, url, link_no, regexp_extract(a, '(?is)href\s*=\s*["'']([^"'']*)', 1) AS href, {_LABEL_SQL} AS label FROM x""")
def html_link_rows(spark, sf_dir):
    return readers.links(_table(spark, sf_dir, "pages"))


@_query("SELECT n_regionkey AS page_id, 0::INTEGER AS table_no, row_number() OVER (PARTITION BY n_regionkey ORDER BY n_name)::INTEGER AS row_no, n_name AS name, n_nationkey::VARCHAR AS code FROM nation JOIN customer ON c_nationkey = n_nationkey GROUP BY n_regionkey, n_name, n_nationkey")
def html_table_rows(spark, sf_dir):
    """Nations that have customers as HTML tables, a page a region, read back as records."""
    n = _table(spark, sf_dir, "nation").join(_table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("n_nationkey")).distinct(), "n_nationkey")
    row = F.concat(F.lit("<tr><td><b>"), "n_name", F.lit("</b>&nbsp;</td>\n<TD>"), F.col("n_nationkey").cast("string"), F.lit("</TD></tr>"))
    pages = n.groupBy(F.col("n_regionkey").alias("page_id")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("n_name", row.alias("row")))), lambda x: x["row"]), "").alias("rows"))
    html = pages.select("page_id", F.concat(F.lit("<p>x</p><table class='Data'><tr><th>name</th><th>code</th></tr>"), "rows", F.lit("<tr><td> </td></tr></table>")).alias("html"))
    return readers.table_records(html).select("page_id", "table_no", "row_no", F.col("record")["name"].alias("name"), F.col("record")["code"].alias("code"))


@_query("""WITH f AS (SELECT o_orderkey // 400 AS file, 'o_orderkey,o_custkey' || chr(10) || string_agg(o_orderkey || ',' || o_custkey, chr(10) ORDER BY o_orderkey) || chr(10) AS content, count(*) AS n FROM orders GROUP BY 1)
SELECT file, sha256(content) AS sha256, length(content) AS length, n AS n_rows, 2::BIGINT AS n_columns, 'o_orderkey|o_custkey' AS header FROM f""")
def file_fingerprint(spark, sf_dir):
    """Orders as CSV files of up to 400 keys, fingerprinted."""
    line = F.concat_ws(",", F.col("o_orderkey").cast("string"), F.col("o_custkey").cast("string"))
    files = _table(spark, sf_dir, "orders").groupBy(F.floor(F.col("o_orderkey") / 400).alias("file")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("o_orderkey", line.alias("line")))), lambda x: x["line"]), "\n").alias("lines"))
    content = F.encode(F.concat(F.lit("o_orderkey,o_custkey\n"), "lines", F.lit("\n")), "UTF-8")
    return files.select("file", readers.fingerprint(content).alias("f")).select("file", "f.sha256", "f.length", "f.n_rows", "f.n_columns", F.array_join("f.header", "|").alias("header"))


@_query("""SELECT dataset, CASE WHEN dataset % 3 = 0 THEN 'MISSING' WHEN dataset % 3 = 1 THEN 'STATUS_MISMATCH' END AS faults FROM (SELECT DISTINCT c_nationkey AS dataset FROM customer) WHERE dataset % 3 < 2""")
def manifest_gate(spark, sf_dir):
    d = _table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("dataset")).distinct()
    expected = d.select("dataset", F.lit("mef").alias("system"), F.lit("2026-06-15").alias("extraction_date"), F.lit("SUCCESS").alias("status"))
    found = expected.where("dataset % 3 > 0").withColumn("status", F.when(F.col("dataset") % 3 == 1, "FAILED").otherwise(F.col("status")))
    return landing.manifest_faults(expected, found).select("dataset", F.array_join("faults", ",").alias("faults"))


@_query("""WITH c AS (SELECT o_orderpriority AS dataset, count(*) AS n FROM orders GROUP BY 1), r AS (SELECT dataset, i, (i - 1) * 7 + 1 AS a, least(i * 7, (n + 99) // 100) AS b FROM (SELECT *, unnest(range(1, ((n + 99) // 100 + 6) // 7 + 1)) AS i FROM c))
SELECT dataset, i AS chunk, 'GAP' AS fault FROM r WHERE i = 3 AND a <= b""")
def page_range_gaps(spark, sf_dir):
    """Chunks of pages of which every dataset has lost the second."""
    d = _table(spark, sf_dir, "orders").groupBy(F.col("o_orderpriority").alias("dataset")).agg(F.ceil(F.count("*") / 100).alias("total_pages")).withColumn("chunk_size", F.lit(7))
    chunks = landing.split_pages(d).withColumn("chunk", F.substring_index("chunk_id", "_", -1).cast("bigint")).where("chunk <> 2")
    return landing.page_faults(chunks).select("dataset", F.substring_index("chunk_id", "_", -1).cast("bigint").alias("chunk"), "fault")


# --- profiles and rules ---------------------------------------------------------------------------

_PART = ("p_name", "p_brand", "p_type", "p_size")


@_query(" UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count(*) AS rows, count(*) - count({c}) AS nulls, count(*) FILTER (trim({c}::VARCHAR) = '') AS empty, count(DISTINCT {c}) FILTER (trim({c}::VARCHAR) <> '') AS distinct_values,
  coalesce(max(length({c}::VARCHAR)), 0)::INTEGER AS max_length, round(100.0 * count(*) FILTER (trim(coalesce({c}::VARCHAR, '')) = '') / count(*), 4)::DOUBLE AS null_percent, array_to_string((list_sort(list_distinct(list({c}::VARCHAR))))[:3], '|') AS samples FROM part""" for c in _PART))
def profile_columns(spark, sf_dir):
    return profile.columns_profile(_table(spark, sf_dir, "part").select(*_PART), 3).withColumn("samples", F.array_join("samples", "|"))


_CLASS_SQL = r"""CASE WHEN trim(coalesce(v, '')) = '' THEN 'EMPTY' WHEN regexp_full_match(v, '[+-]?\d+') THEN 'INTEGER' WHEN regexp_full_match(v, '[+-]?\d{1,3}([.,]\d{3})*([.,]\d+)?|[+-]?\d+[.,]\d+') THEN 'NUMERIC' WHEN regexp_matches(v, '^\d{4}-\d{2}-\d{2}[ T]\d{2}:\d{2}') THEN 'TIMESTAMP' WHEN regexp_full_match(v, '\d{4}-\d{2}-\d{2}') THEN 'DATE' ELSE 'TEXT' END"""


@_query(f"""WITH c AS ({' UNION ALL '.join(f"SELECT '{n}' AS name, {e} AS v FROM orders" for n, e in (('cust_key', 'o_custkey::VARCHAR'), ('amount', 'CASE WHEN o_orderkey % 40 = 0 THEN NULL ELSE o_custkey::VARCHAR END'), ('priority', 'o_orderpriority'), ('day', "strftime(o_orderdate, '%Y-%m-%d')"), ('mixed', "CASE WHEN o_orderkey % 3 = 0 THEN 'x' ELSE o_custkey::VARCHAR END")))}),
k AS (SELECT name, {_CLASS_SQL} AS k FROM c), g AS (SELECT name, count(*) FILTER (k <> 'EMPTY') AS f, count(*) FILTER (k = 'DATE') AS d, count(*) FILTER (k = 'INTEGER') AS i, count(*) FILTER (k IN ('INTEGER', 'NUMERIC')) AS n FROM k GROUP BY 1)
SELECT name AS "column", CASE WHEN f = 0 THEN 'UNKNOWN' WHEN name = 'cust_key' THEN 'STRING' WHEN d >= 0.95 * f THEN 'DATE' WHEN i >= 0.95 * f THEN 'INTEGER' WHEN n >= 0.95 * f THEN 'NUMERIC' ELSE 'STRING' END AS suggested_type,
  CASE WHEN name = 'cust_key' THEN 1.0 WHEN d >= 0.95 * f THEN round(d::DOUBLE / f, 4) WHEN i >= 0.95 * f THEN round(i::DOUBLE / f, 4) WHEN n >= 0.95 * f THEN round(n::DOUBLE / f, 4) ELSE 1.0 END::DOUBLE AS confidence FROM g""")
def profile_types(spark, sf_dir):
    k, c = F.col("o_orderkey"), F.col("o_custkey").cast("string")
    o = _table(spark, sf_dir, "orders").select(c.alias("cust_key"), F.when(k % 40 > 0, c).alias("amount"), F.col("o_orderpriority").alias("priority"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"), F.when(k % 3 == 0, "x").otherwise(c).alias("mixed"))
    return profile.type_suggestions(o)


@_query("""WITH d AS (SELECT p_partkey % 50 AS g, avg(p_size) AS m FROM part GROUP BY 1) SELECT 'p_size' AS "column", count(*) AS rows, 0::BIGINT AS null_like, count(DISTINCT p_size) AS distinct_values, round(count(DISTINCT p_size)::DOUBLE / count(*), 6) AS uniqueness, count(*) AS numeric_valid, min(p_size)::DOUBLE AS min_value, max(p_size)::DOUBLE AS max_value, round(avg(p_size), 6) AS mean_value FROM part
UNION ALL SELECT 'p_brand', count(*), 0, count(DISTINCT p_brand), round(count(DISTINCT p_brand)::DOUBLE / count(*), 6), 0, NULL, NULL, NULL FROM part""")
def profile_sample(spark, sf_dir):
    return profile.sample_profile(_table(spark, sf_dir, "part").select("p_size", "p_brand"))


@_query("WITH g AS (SELECT count(*) AS n FROM lineitem GROUP BY l_partkey, l_suppkey) SELECT CAST(sum(n) AS BIGINT) AS rows, CAST(sum(n - 1) AS BIGINT) AS duplicates FROM g")
def profile_duplicates(spark, sf_dir):
    return profile.duplicate_rows(_table(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey"))


@_query("""SELECT * FROM (SELECT 'ruc' AS "column", 'POSSIBLE_IDENTIFIER_AS_NUMBER' AS warning, count(*) AS n FROM customer UNION ALL SELECT 'nota', 'POSSIBLE_DECIMAL_COMMA', count(*) FROM customer UNION ALL SELECT 'mixed', 'MIXED_TYPE_VALUES', count(*) FROM customer
UNION ALL SELECT 'mostly_null', 'HIGH_NULL_PERCENTAGE', count(*) FROM customer HAVING 100 * count(*) FILTER (c_custkey % 9 > 0) >= 80 * count(*) UNION ALL SELECT 'empty', w, count(*) FROM customer CROSS JOIN (VALUES ('HIGH_NULL_PERCENTAGE'), ('ALL_EMPTY')) v(w) GROUP BY w
UNION ALL SELECT 'one', 'LOW_DISTINCT', count(*) FROM customer) WHERE n > 1""")
def profile_warnings(spark, sf_dir):
    k = F.col("c_custkey")
    c = _table(spark, sf_dir, "customer")
    w = c.select(k.alias("ruc"), F.concat((k % 20).cast("string"), F.lit(",5")).alias("nota"), F.when(k % 2 == 0, "x").otherwise(k.cast("string")).alias("mixed"), F.when(k % 9 == 0, F.col("c_name")).alias("mostly_null"), F.lit(" ").alias("empty"), F.lit("same").alias("one"))
    return profile.warnings(w).crossJoin(w.agg(F.count("*").alias("n")))


@_query("""WITH r AS (SELECT c_custkey AS id, CASE WHEN c_custkey % 4 = 0 THEN '' ELSE c_mktsegment END AS region, CASE c_custkey % 6 WHEN 0 THEN 'Total' WHEN 1 THEN 'perú' WHEN 2 THEN 'Extranjero' ELSE c_name END AS provincia FROM customer),
t AS (SELECT *, CASE WHEN region <> '' THEN 'region' ELSE '' END AS parent_column FROM r WHERE id % 6 < 3)
SELECT id, parent_column, region AS parent_value, 'provincia' AS "column", provincia AS value, issue, CASE id % 6 WHEN 0 THEN 'REVIEW_EXCLUDE_FROM_DETAIL_SILVER' WHEN 1 THEN 'REVIEW_MAP_TO_NATIONAL_TOTAL' ELSE 'REVIEW_KEEP_AS_AGGREGATE_TABLE' END AS action FROM (
  SELECT *, 'TERRITORIAL_TOTAL_VALUE' AS issue FROM t UNION ALL SELECT *, CASE WHEN parent_column <> '' OR id % 6 = 0 THEN 'AGGREGATE_TOTAL_ROW' ELSE 'POSSIBLE_NON_TERRITORIAL_VALUE' END FROM t)""")
def territorial_rows(spark, sf_dir):
    k = F.col("c_custkey")
    value = F.when(k % 6 == 0, "Total").when(k % 6 == 1, "perú").when(k % 6 == 2, "Extranjero").otherwise(F.col("c_name"))
    return profile.territorial_rows(_table(spark, sf_dir, "customer").select(k.alias("id"), F.when(k % 4 == 0, "").otherwise(F.col("c_mktsegment")).alias("region"), value.alias("provincia")), ["id"])


@_query("""SELECT 'distrito' AS "column", count(*) FILTER (c_custkey % 10 = 0) AS totals, count(*) FILTER (c_custkey % 10 > 0) AS details, true AS mixed FROM customer UNION ALL SELECT 'region', 0, count(*), false FROM customer""")
def mixed_granularity(spark, sf_dir):
    k = F.col("c_custkey")
    return profile.mixed_granularity(_table(spark, sf_dir, "customer").select(F.col("c_mktsegment").alias("region"), F.when(k % 10 == 0, "SUBTOTAL").otherwise(F.col("c_name")).alias("distrito")))


@_query("""SELECT 'R1' AS check_id, CASE WHEN count(*) = 0 THEN 1 ELSE 0 END::BIGINT AS failed_rows FROM orders
UNION ALL SELECT 'R2', count(*) FILTER (o_custkey IS NULL OR o_orderpriority IS NULL) FROM orders
UNION ALL SELECT 'R3', count(*) FILTER (o_totalprice < 1000) FROM orders
UNION ALL SELECT 'R4', count(*) FILTER (o_orderstatus IS NULL OR o_orderstatus NOT IN ('F', 'O')) FROM orders
UNION ALL SELECT 'R5', count(*) FROM (SELECT 1 FROM orders GROUP BY o_custkey, o_orderpriority HAVING count(*) > 1)
UNION ALL SELECT 'R6', count(*) FROM (VALUES ('AIR'), ('FRANCE')) m(x) WHERE x NOT IN (SELECT n_name FROM nation)
UNION ALL SELECT 'R7', 1 FROM orders HAVING count(*) >= 0""")
def quality_results(spark, sf_dir):
    rules = [
        Rule("R1", "orders", "not_empty"),
        Rule("R2", "orders", "nulls", {"fields": ["o_custkey", "o_orderpriority"]}),
        Rule("R3", "orders", "where", {"condition": "o_totalprice < 1000"}, "WARNING"),
        Rule("R4", "orders", "allowed", {"column": "o_orderstatus", "values": ["F", "O"]}),
        Rule("R5", "orders", "unique", {"keys": ["o_custkey", "o_orderpriority"]}),
        Rule("R6", "nation", "required_members", {"column": "n_name", "members": ["AIR", "FRANCE"]}),
        Rule("R7", "absent", "not_empty"),
    ]
    tables = {t: _table(spark, sf_dir, t) for t in ("orders", "nation")}
    return run_rules(spark, tables, rules).select("check_id", "failed_rows")


# --- regional analytics ---------------------------------------------------------------------------

_CONTEXT_SQL = f"""c AS (SELECT c_nationkey AS k, count(*) AS enrolled, count(*) FILTER (c_acctbal < 0) AS poor, count(*) FILTER (c_mktsegment = 'BUILDING') AS young FROM customer GROUP BY 1),
s AS (SELECT s_nationkey AS k, count(*) AS suppliers FROM supplier GROUP BY 1),
o AS (SELECT c_nationkey AS k, year(o_orderdate) AS year, count(*) AS demand, count(*) FILTER (o_orderstatus = 'O') AS open, count(DISTINCT o_custkey) AS grantees, CAST(sum({_C('o_totalprice')}) AS BIGINT) AS spend FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2),
x AS (SELECT n_name AS region, year, enrolled, demand, grantees, spend, 100.0::DOUBLE * poor / enrolled AS poverty, 100.0::DOUBLE * young / enrolled AS youth, suppliers::DOUBLE AS digital, 100.0::DOUBLE * open / demand AS rurality
  FROM o JOIN nation ON o.k = n_nationkey JOIN c ON c.k = o.k LEFT JOIN s ON s.k = o.k)"""
_MM = lambda c: f"CASE WHEN {c} IS NOT NULL THEN coalesce(({c} - min({c}) OVER (PARTITION BY year))::DOUBLE / nullif((max({c}) OVER (PARTITION BY year) - min({c}) OVER (PARTITION BY year))::DOUBLE, 0), 0) END"


def _weighted_sql(weights: dict[str, float]) -> str:
    total = " + ".join(f"{w}::DOUBLE * coalesce({c}, 0)" for c, w in weights.items())
    present = " + ".join(f"CASE WHEN {c} IS NOT NULL THEN {w}::DOUBLE ELSE 0 END" for c, w in weights.items())
    return f"CAST(floor(({total}) / nullif({present}, 0) * 1e9::DOUBLE + 0.5001::DOUBLE) AS BIGINT) / 1e9::DOUBLE"


_TIER = lambda s: f"CASE WHEN {s} IS NULL THEN 'Insuficiente' WHEN {s} >= 0.8 THEN 'Muy alta' WHEN {s} >= 0.6 THEN 'Alta' WHEN {s} >= 0.4 THEN 'Media' ELSE 'Baja' END"
_PRIORITY_SQL = (
    f"{_CONTEXT_SQL}, m AS (SELECT region, year, {', '.join(f'{_MM(c)} AS {c}' for c in regional.PRIORITY_WEIGHTS)} FROM x), p AS (SELECT *, {_weighted_sql(regional.PRIORITY_WEIGHTS)} AS priority_score FROM m)"
)
_COVERAGE_SQL = f""", v0 AS (SELECT *, round(1000.0::DOUBLE * grantees / nullif(enrolled, 0), 6) AS per_1000 FROM x),
v AS (SELECT region, year, enrolled, grantees, greatest(enrolled - grantees, 0) AS uncovered, per_1000, round(1 - coalesce({_MM('per_1000')}, 0), 9) AS gap_score, round({_MM('rurality')}, 9) AS first_generation_score FROM v0)"""
_V2_SQL = f"""{_PRIORITY_SQL}{_COVERAGE_SQL}, z AS (SELECT *, {_weighted_sql(regional.COMBINED_WEIGHTS)} AS score_v2 FROM p JOIN v USING (region, year))"""


def _context(spark, sf_dir) -> DataFrame:
    c, s, o, n = (_table(spark, sf_dir, t) for t in ("customer", "supplier", "orders", "nation"))
    people = c.groupBy(F.col("c_nationkey").alias("k")).agg(F.count("*").alias("enrolled"), F.count_if(F.col("c_acctbal") < 0).alias("poor"), F.count_if(F.col("c_mktsegment") == "BUILDING").alias("young"))
    firms = s.groupBy(F.col("s_nationkey").alias("k")).agg(F.count("*").alias("suppliers"))
    grants = (
        o.join(c, F.col("o_custkey") == F.col("c_custkey"))
        .groupBy(F.col("c_nationkey").alias("k"), F.year("o_orderdate").alias("year"))
        .agg(F.count("*").alias("demand"), F.count_if(F.col("o_orderstatus") == "O").alias("open"), F.countDistinct("o_custkey").alias("grantees"), F.sum(gold.cents(F.col("o_totalprice"))).alias("spend"))
    )
    x = grants.join(n.select(F.col("n_nationkey").alias("k"), F.col("n_name").alias("region")), "k").join(people, "k").join(firms, "k", "left")
    rate = lambda a, b: 100.0 * F.col(a) / F.col(b)
    return x.select("region", "year", "enrolled", "demand", "grantees", "spend", rate("poor", "enrolled").alias("poverty"), rate("young", "enrolled").alias("youth"), F.col("suppliers").cast("double").alias("digital"), rate("open", "demand").alias("rurality"))


def _coverage(x: DataFrame) -> DataFrame:
    return regional.coverage(x.withColumn("first_generation", F.col("rurality")))


def _v2(spark, sf_dir) -> DataFrame:
    x = _context(spark, sf_dir)
    return regional.priority_v2(regional.priority(x), _coverage(x))


@_query(f"WITH {_CONTEXT_SQL} SELECT region, year, enrolled, demand, grantees, spend, round(poverty, 9) AS poverty, round(youth, 9) AS youth, digital, round(rurality, 9) AS rurality FROM x")
def regional_context(spark, sf_dir):
    return _context(spark, sf_dir).withColumns({c: F.round(c, 9) for c in ("poverty", "youth", "rurality")})


@_query(f"WITH {_PRIORITY_SQL} SELECT region, year, priority_score, {_TIER('priority_score')} AS tier, rank() OVER (PARTITION BY year ORDER BY priority_score DESC NULLS LAST) AS priority_rank FROM p")
def regional_priority(spark, sf_dir):
    return regional.priority(_context(spark, sf_dir)).select("region", "year", "priority_score", "tier", "priority_rank")


@_query(f"WITH {_PRIORITY_SQL}{_COVERAGE_SQL} SELECT * FROM v")
def regional_coverage(spark, sf_dir):
    return _coverage(_context(spark, sf_dir))


@_query(f"WITH {_V2_SQL} SELECT region, year, score_v2, {_TIER('score_v2')} AS tier_v2, rank() OVER (PARTITION BY year ORDER BY score_v2 DESC NULLS LAST) AS rank_v2 FROM z")
def regional_priority_v2(spark, sf_dir):
    return _v2(spark, sf_dir).select("region", "year", "score_v2", "tier_v2", "rank_v2")


_SCENARIO_ROWS = ", ".join("('{}', '{}', {})".format(s[0], s[1], ", ".join(f"{v}::DOUBLE" for v in s[2:])) for s in regional.SCENARIOS)


@_query(f"""WITH {_V2_SQL}, {_BUDGET_SQL}, sc(scenario_id, method, bf, gf, wp, wd, wn, wc, wf) AS (VALUES {_SCENARIO_ROWS}),
g AS (SELECT year, executed / 100.0::DOUBLE AS budget, executed / 100.0::DOUBLE / (SELECT count(*) FROM orders o WHERE year(o.o_orderdate) = b.year) AS unit_cost FROM b WHERE year IN (SELECT year(o_orderdate) FROM orders)),
r AS (SELECT scenario_id, region, year, bf, gf, budget, unit_cost, CAST(floor((CASE WHEN method = 'priority_score_v2' THEN coalesce(score_v2, 0) ELSE wp * coalesce(poverty, 0) + wd * coalesce(demand, 0) + wn * coalesce(youth, 0) + wc * coalesce(gap_score, 0) + wf * coalesce(first_generation_score, 0) END) * 1e9::DOUBLE + 0.5001::DOUBLE) AS BIGINT) AS raw FROM z JOIN g USING (year) CROSS JOIN sc),
w AS (SELECT *, raw::DOUBLE / nullif(sum(raw) OVER (PARTITION BY year, scenario_id)::DOUBLE, 0) AS weight, row_number() OVER (PARTITION BY year, scenario_id ORDER BY raw DESC, region) AS scenario_rank FROM r)
SELECT scenario_id, region, year, round(weight, 9) AS weight, scenario_rank, max(scenario_rank) FILTER (scenario_id = 'base_priority') OVER (PARTITION BY year, region) - scenario_rank AS rank_change, CAST(floor(budget * bf * weight * 100 + 0.500001) AS BIGINT) AS region_budget_cents, round(budget * bf * weight / nullif(unit_cost, 0) * gf, 6) AS grants FROM w""")
def regional_allocation(spark, sf_dir):
    grants = _table(spark, sf_dir, "orders").groupBy(F.year("o_orderdate").alias("year")).agg(F.count("*").alias("n"))
    budget = _execution(spark, sf_dir).select("year", (F.col("executed") / 100.0).alias("budget")).join(grants, "year").select("year", "budget", (F.col("budget") / F.col("n")).alias("unit_cost"))
    return regional.allocate(_v2(spark, sf_dir), regional.scenarios(spark), budget)


@_query()
def regional_clusters(spark, sf_dir):
    return regional.clusters(_context(spark, sf_dir), ["poverty", "demand", "youth", "digital", "rurality"])


@_query(f"""WITH m AS (SELECT year(l_shipdate) * 12 + month(l_shipdate) AS t, sum({_C('l_extendedprice')})::DOUBLE AS value FROM lineitem GROUP BY 1), f AS (SELECT regr_slope(value, t) AS a, regr_intercept(value, t) AS b, max(t) AS last FROM m),
s AS (SELECT t % 12 AS m, avg(value - b - a * t) AS e FROM m, f GROUP BY 1), n AS (SELECT a, b, unnest(range(last + 1, last + 13)) AS t FROM f)
SELECT n.t AS month, round((b + a * n.t + coalesce(e, 0)) / 1e6) AS millions FROM n LEFT JOIN s ON n.t % 12 = s.m""")
def monthly_forecast(spark, sf_dir):
    m = _table(spark, sf_dir, "lineitem").groupBy((F.year("l_shipdate").cast("bigint") * 12 + F.month("l_shipdate")).alias("t")).agg(F.sum(gold.cents(F.col("l_extendedprice"))).cast("double").alias("value"))
    return regional.monthly_forecast(m).select(F.col("t").alias("month"), F.round(F.col("forecast") / 1e6, 0).alias("millions"))
