"""Queries over the test tables for files, runs, reloads, markers and page texts, with the SQL they are held against."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillon.functions import dates, headers, numbers, text
from quillon.operators import inventory, profile, quarantine
from quillon.operators.quality import Rule, run_rules
from quillon.plans import silver
from quillon.sources import contracts, landing, readers, scratch, sinks
from quillon.table_queries import _POPULATION_ERROR_SQL, CONTEXT, _raw_population, _table

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_SQL: dict[str, str] = {}


def _query(sql: str):
    def add(f):
        _QUERIES[f.__name__], _SQL[f.__name__] = f, sql
        return f

    return add


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


_c = F.col


def _json(*columns: Column) -> Column:
    return F.to_json(F.struct(*columns))


# --- HTML -------------------------------------------------------------------------------------------


def _td(content: Column, attributes: str | Column = "") -> Column:
    return F.concat(F.lit("<td"), attributes if isinstance(attributes, Column) else F.lit(attributes), F.lit(">"), content, F.lit("</td>"))


@_query("""WITH o AS (SELECT o_custkey, o_orderkey, o_orderpriority AS p, o_orderstatus AS s, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderpriority, o_orderkey)::INTEGER AS i FROM orders)
SELECT o_custkey AS page_id, 0::INTEGER AS table_no, i AS row_no, concat_ws('|', p, o_orderkey, s, CASE WHEN o_orderkey % 2 = 0 THEN s ELSE 'x' END, CASE WHEN i = 1 THEN 'note' ELSE o_custkey::VARCHAR END) AS cells FROM o
UNION ALL SELECT DISTINCT o_custkey, 0::INTEGER, 0::INTEGER, 'priority|key|status|status|note' FROM orders""")
def html_rowspan_grid(spark, sf_dir):
    """A page a customer: a priority stands once for its orders, a status over two columns of some rows, and a note beside all further rows."""
    o = _table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderpriority", "o_orderstatus")
    turns = o.groupBy(_c("o_custkey").alias("page_id")).agg(F.array_sort(F.collect_list(F.struct("o_orderpriority", "o_orderkey", "o_orderstatus"))).alias("o"))

    def row(x: Column, i: Column) -> Column:
        first = F.get("o", i - 1)["o_orderpriority"].eqNullSafe(x["o_orderpriority"])
        many = F.size(F.filter("o", lambda y: y["o_orderpriority"] == x["o_orderpriority"])).cast("string")
        spread = F.when(x["o_orderkey"] % 2 == 0, _td(x["o_orderstatus"], " class='s' colspan=2")).otherwise(F.concat(_td(x["o_orderstatus"]), _td(F.lit("x"))))
        note = F.when(i == 1, _td(_c("page_id").cast("string"), " rowspan='999'")).otherwise("")
        return F.concat(F.lit("<tr>"), F.when(first, "").otherwise(_td(x["o_orderpriority"], F.concat(F.lit(' rowspan="'), many, F.lit('"')))), _td(x["o_orderkey"].cast("string")), spread, note, F.lit("</tr>\n<tr></tr>"))

    head = '<table><tr><th>priority</th><th>key</th><th colspan="2">status</th><th rowspan="2">note</th></tr>'
    pages = turns.select("page_id", F.concat(F.lit(head), F.array_join(F.transform("o", row), ""), F.lit("</table>")).alias("html"))
    return readers.table_grid(pages).withColumn("cells", F.array_join("cells", "|"))


@_query("""SELECT o_custkey AS page_id, o_orderkey::VARCHAR AS code, o_orderstatus AS status FROM orders""")
def html_section_rows(spark, sf_dir):
    """A page a customer: rows before the section and after it, with other numbers of cells, don't come back."""
    o = _table(spark, sf_dir, "orders").groupBy(_c("o_custkey").alias("page_id")).agg(F.array_sort(F.collect_list(F.struct("o_orderkey", "o_orderstatus"))).alias("o"))
    row = lambda *cells: F.concat(F.lit("<tr>"), *map(_td, cells), F.lit("</tr>"))
    rows = F.array_join(F.transform("o", lambda x: row(x["o_orderkey"].cast("string"), x["o_orderstatus"])), "")
    html = F.concat(F.lit("<table>"), row(F.lit("0"), F.lit("before")), row(F.lit("Total Región")), rows, row(F.lit("TOTAL  provincia")), row(F.lit("9"), F.lit("after")), row(F.lit("Total región")), F.lit("</table>"))
    grid = readers.table_grid(o.select("page_id", html.alias("html")))
    found = readers.section_rows(grid, "page_id", "TOTAL REGION", ["TOTAL PROVINCIA"])
    return found.select("page_id", F.get("cells", F.lit(0)).alias("code"), F.get("cells", F.lit(1)).alias("status"))


_METRICS = ["pia", "pim", "certificacion", "compromiso", "atencion", "devengado", "girado", "avance"]


@_query(f"""WITH l AS (SELECT l_orderkey AS page_id, l_returnflag || ': ' || l_linestatus AS descriptor, row_number() OVER (PARTITION BY l_orderkey, l_returnflag, l_linestatus ORDER BY l_linenumber, l_suppkey, l_partkey) AS i, * FROM lineitem WHERE l_linenumber % 5 > 0)
SELECT page_id, descriptor, {', '.join(f"(l_partkey + {i})::VARCHAR AS {m}" for i, m in enumerate(_METRICS))} FROM l WHERE i = 1""")
def html_budget_rows(spark, sf_dir):
    """A page an order, a row a line with its metrics; header rows, rows without figures and repeated descriptors go."""
    row = lambda *cells: F.concat(F.lit("<tr>"), *map(_td, cells), F.lit("</tr>"))

    def line(x: Column) -> Column:
        own = [(x["l_partkey"] + i).cast("string") for i in range(len(_METRICS))]
        return F.when(x["l_linenumber"] % 5 == 0, row(F.lit("no figures"), *[F.lit("-")] * len(_METRICS))).otherwise(row(F.lit("mark"), F.concat(x["l_returnflag"], F.lit(": "), x["l_linestatus"]), *own))

    # the marks are put around a line after the shuffle
    pages = _table(spark, sf_dir, "lineitem").groupBy(_c("l_orderkey").alias("page_id")).agg(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_suppkey", "l_partkey", "l_returnflag", "l_linestatus"))).alias("rows"))
    html = F.concat(F.lit("<table><tr><th>descriptor</th><th>metrics</th></tr>"), F.array_join(F.transform("rows", line), ""), F.lit("</table>"))
    return readers.budget_rows(readers.table_grid(pages.select("page_id", html.alias("html"))), "page_id", _METRICS)


# --- runs and reloads -------------------------------------------------------------------------------


@_query(f"""WITH e AS (SELECT {_POPULATION_ERROR_SQL} AS e FROM customer) SELECT count(*) AS records_read, count(*) - count(e) AS records_valid, count(e) AS records_rejected, round(count(e)::DOUBLE / count(*), 6) AS rejection_rate, 'COMPLETED_WITH_REJECTIONS' AS status, 0::BIGINT AS records_dropped,
  count(*) - count(e) AS written_valid, count(e) AS written_rejects FROM e""")
def silver_run_counters(spark, sf_dir):
    """Counts that the one write observed, beside those of what was written."""
    done = silver.run(_raw_population(spark, sf_dir), "inei_reports", "inei_population_youth_region", CONTEXT, scratch.new_folder(spark, "run"))
    one = lambda df, name: df.agg(F.count("*").alias(name))
    # three tables of one row each
    return done.summary().join(one(done.valid, "written_valid")).join(one(done.rejects, "written_rejects"))


def _sliced(o: DataFrame) -> DataFrame:
    date = F.when(_c("o_orderstatus") == "O", "2026-06-15").when(_c("o_orderstatus") == "F", "2026-06-16").otherwise("2026-06-17")
    return o.select("o_orderkey", "o_custkey", date.alias("extraction_date"), F.lit("mef").alias("source_system"), F.left("o_orderpriority", F.lit(1)).alias("source_dataset"))


@_query("""WITH s AS (SELECT o_orderkey, o_custkey, CASE o_orderstatus WHEN 'O' THEN '2026-06-15' WHEN 'F' THEN '2026-06-16' ELSE '2026-06-17' END AS d, left(o_orderpriority, 1) AS t FROM orders), r AS (SELECT DISTINCT d, t FROM s WHERE d = '2026-06-16' AND o_custkey % 2 = 0)
SELECT d AS extraction_date, t AS source_dataset, count(*) AS records, sum(CASE WHEN d = '2026-06-16' THEN o_orderkey * 2 ELSE o_orderkey END)::BIGINT AS keys FROM s
WHERE NOT (d = '2026-06-17' AND t = '1') AND ((d, t) NOT IN (SELECT (d, t) FROM r) OR o_custkey % 2 = 0) GROUP BY 1, 2""")
def slice_reload(spark, sf_dir):
    """A load of all slices, a reload of those of one date with fewer rows, twice, and an empty reload of one slice."""
    path = scratch.new_folder(spark, "slices")
    rows = _sliced(_table(spark, sf_dir, "orders"))
    sinks.overwrite_slices(rows, path)
    again = rows.where("extraction_date = '2026-06-16' AND o_custkey % 2 = 0").withColumn("o_orderkey", _c("o_orderkey") * 2)
    for _ in range(2):
        sinks.overwrite_slices(again, path)
    sinks.replace_slice(rows.limit(0), path, extraction_date="2026-06-17", source_system="mef", source_dataset="1")
    back = spark.read.schema("o_orderkey long, o_custkey long, extraction_date string, source_system string, source_dataset string").parquet(path)
    return back.groupBy("extraction_date", "source_dataset").agg(F.count("*").alias("records"), F.sum("o_orderkey").alias("keys"))


@_query(f"""SELECT 'transform' AS processing_stage, 'TRANSFORM_ERROR' AS error_code, 'INEI' AS source_system, 'inei_population_youth_region' AS source_dataset, '2026-06-15' AS extraction_date, count(*) AS records, sum(c_custkey * 1000)::BIGINT AS raw_total FROM customer WHERE {_POPULATION_ERROR_SQL} IS NOT NULL
UNION ALL SELECT 'parse', 'PARSE_ERROR', 'mef', 'orders', '2026-06-15', count(*), NULL FROM orders WHERE o_orderkey % 10 = 3""")
def reject_files(spark, sf_dir):
    """Rejects of parsing and of transforming together, written by two runs of one load and read back from their lines."""
    _, bad = silver.process(_raw_population(spark, sf_dir), "inei_reports", "inei_population_youth_region", CONTEXT)
    lines, root = scratch.new_folder(spark, "lines"), scratch.new_folder(spark, "rejects")
    o = _c("o_orderkey")
    _table(spark, sf_dir, "orders").select(F.when(o % 10 == 3, F.concat(F.lit("{broken "), o.cast("string"))).otherwise(_json(o)).alias("value")).write.text(lines)
    _, unparsed = readers.read_jsonl(spark, lines, ["o_orderkey"])
    unparsed = unparsed.withColumnRenamed("stage", "processing_stage").withColumns({"source_system": F.lit("mef"), "source_dataset": F.lit("orders"), "extraction_date": F.lit("2026-06-15").cast("date")})
    for _ in range(2):
        sinks.write_rejects(quarantine.union_rejects(bad, unparsed), root)
    back = sinks.read_rejects(spark, root, ["processing_stage", "error_code", "raw_record"])
    total = F.replace(F.get_json_object("raw_record", "$.poblacion_total"), F.lit(","), F.lit("")).cast("bigint")
    return back.groupBy("processing_stage", "error_code", "source_system", "source_dataset", "extraction_date").agg(F.count("*").alias("records"), F.sum(total).alias("raw_total"))


@_query("""SELECT 'SCHEMA_MISMATCH' AS error_code, 'validation' AS stage, c_custkey::VARCHAR AS c_custkey, CASE WHEN c_custkey % 7 = 0 THEN 'alpha' ELSE 'zeta' END AS failed_field, CASE WHEN c_custkey % 7 = 0 THEN '[1,2]' ELSE c_name END AS failed_value,
  'columns that the contract doesn''t have: ' || concat_ws(', ', CASE WHEN c_custkey % 7 = 0 THEN 'alpha' END, CASE WHEN c_custkey % 5 = 0 THEN 'zeta' END) AS error_message FROM customer WHERE c_custkey % 7 = 0 OR c_custkey % 5 = 0
UNION ALL SELECT 'kept', NULL, count(*)::VARCHAR, NULL, NULL, NULL FROM customer WHERE c_custkey % 7 > 0 AND c_custkey % 5 > 0""")
def schema_mismatch_rejects(spark, sf_dir):
    """JSON lines of customers, some with keys that the contract lacks, judged one by one; and how many are kept."""
    k, path = _c("c_custkey"), scratch.new_folder(spark, "lines")
    _table(spark, sf_dir, "customer").select(_json("c_custkey", "c_name", F.when(k % 5 == 0, _c("c_name")).alias("zeta"), F.when(k % 7 == 0, F.array(F.lit(1), F.lit(2))).alias("alpha")).alias("value")).write.text(path)
    rows, bad = quarantine.unknown_keys(readers.json_records(spark, path).select("record"), ["c_custkey", "c_name", "c_address"])
    bad = bad.select("error_code", "stage", F.get_json_object("raw_record", "$.c_custkey").alias("c_custkey"), "failed_field", "failed_value", "error_message")
    return bad.unionByName(rows.agg(F.lit("kept").alias("error_code"), F.count("*").cast("string").alias("c_custkey")), allowMissingColumns=True)


# --- landing files ------------------------------------------------------------------------------------


def _bronze(spark: SparkSession, sf_dir: str) -> str:
    """Orders of a system with years, and customers of one without, as JSON lines, a file for each date and year."""
    root = scratch.new_folder(spark, "bronze")
    o, k = _table(spark, sf_dir, "orders"), _c("o_orderkey")
    year = F.year("o_orderdate")
    date = F.when(k % 2 == 0, "2026-06-15").otherwise("2026-06-16")
    lines = o.select(_json(k, "o_custkey", (year + 20).cast("string").alias("ano"), F.when(k % 7 == 0, F.lit("x")).alias("extra")).alias("value"), date.alias("extraction_date"), year.alias("year"))
    lines.repartition("extraction_date", "year").write.partitionBy("extraction_date", "year").text(f"{root}/MEF/presupuesto")
    c = _table(spark, sf_dir, "customer").select(_json("c_custkey", "c_name", F.lit("2020").alias("ano")).alias("value"), F.lit("2026-06-15").alias("extraction_date"))
    c.repartition(1, "extraction_date").write.partitionBy("extraction_date").text(f"{root}/PRONABEC/becarios")
    c.limit(1).select(F.lit(" ")).repartition(1).write.text(f"{root}/PRONABEC/vacios/extraction_date=2026-06-17")
    return root


_SUMMARY_SQL = """f AS (SELECT CASE WHEN o_orderkey % 2 = 0 THEN '2026-06-15' ELSE '2026-06-16' END AS date, year(o_orderdate) AS y, count(*) AS n, max(o_orderkey % 7 = 0) AS extra FROM orders GROUP BY 1, 2),
y AS (SELECT string_agg(y, '|' ORDER BY y) AS years FROM (SELECT y::VARCHAR AS y FROM f UNION SELECT (y + 20)::VARCHAR FROM f)),
s AS (SELECT 'MEF' AS source_system, 'presupuesto' AS dataset, count(*) AS file_count, sum(n)::BIGINT AS row_count, (3 + max(extra)::INT)::BIGINT AS column_count, string_agg(date, '|' ORDER BY date) AS extraction_dates_detected, any_value(years) AS years_detected FROM f, y
UNION ALL SELECT 'PRONABEC', 'becarios', 1, count(*), 3, '2026-06-15', '' FROM customer UNION ALL SELECT 'PRONABEC', 'vacios', 1, 0, 0, '2026-06-17', '')"""


@_query(f"WITH {_SUMMARY_SQL} SELECT * FROM s")
def bronze_dataset_summary(spark, sf_dir):
    return inventory.dataset_summary(spark, _bronze(spark, sf_dir), "*.txt")


@_query(f"WITH {_SUMMARY_SQL} SELECT source_system, count(*) AS total_datasets, sum(file_count)::BIGINT AS total_files, sum(row_count)::BIGINT AS total_rows FROM s GROUP BY ROLLUP (source_system)")
def bronze_profile_totals(spark, sf_dir):
    return inventory.summary_totals(inventory.dataset_summary(spark, _bronze(spark, sf_dir), "*.txt"))


@_query("""SELECT dataset::VARCHAR AS dataset, CASE dataset % 5 WHEN 0 THEN 'MISSING' WHEN 1 THEN 'STATUS_MISMATCH' WHEN 2 THEN 'MARKER_MISSING' ELSE 'EXTRACTION_DATE_MISMATCH,MARKER_STATUS_MISMATCH' END AS faults FROM (SELECT DISTINCT c_nationkey AS dataset FROM customer) WHERE dataset % 5 < 4""")
def manifest_marker_gate(spark, sf_dir):
    """Manifests and success markers as files of their own, read back with their datasets from the paths."""
    root, d = scratch.new_folder(spark, "manifests"), _c("dataset")
    known = _table(spark, sf_dir, "customer").select(_c("c_nationkey").alias("dataset")).distinct()

    def write(folder: str, rows: DataFrame, status: Column, date: Column) -> DataFrame:
        value = _json(F.lit("mef").alias("system"), status.alias("status"), date.alias("extraction_date"))
        rows.select(d, F.lit("2026-06-15").alias("extraction_date"), value.alias("value")).repartition("dataset").write.partitionBy("dataset", "extraction_date").text(f"{root}/{folder}/mef")
        return readers.json_documents(spark, f"{root}/{folder}", "*.txt", ["status", "extraction_date"])

    day = F.lit("2026-06-15")
    manifests = write("manifest", known.where(d % 5 > 0), F.when(d % 5 == 1, "FAILED").otherwise("SUCCESS"), F.when(d % 5 == 3, "2026-06-14").otherwise(day))
    markers = write("success", known.where(d % 5 != 2), F.when(d % 5 == 3, "RUNNING").otherwise("SUCCESS"), day)
    expected = known.select(d.cast("string").alias("dataset"), F.lit("mef").alias("system"), day.alias("extraction_date"), F.lit("SUCCESS").alias("status"))
    return landing.manifest_faults(expected, manifests, markers=markers).select("dataset", F.array_join("faults", ",").alias("faults"))


@_query("""SELECT 'latin' AS kind, c_custkey, c_name || ' Ñandú é' AS name FROM customer UNION ALL SELECT 'utf8', c_custkey, c_name || ' Ñandú é' FROM customer""")
def encoding_fallback(spark, sf_dir):
    """Customers as CSV files in Latin-1, and in UTF-8 with a BOM, read in splits."""
    root = scratch.new_folder(spark, "encodings")
    c = _table(spark, sf_dir, "customer").select(_c("c_custkey").alias("﻿key"), F.concat("c_name", F.lit(" Ñandú é")).alias("name"))
    c.withColumnRenamed("﻿key", "key").write.option("header", True).option("encoding", "ISO-8859-1").csv(f"{root}/latin")
    c.write.option("header", True).csv(f"{root}/utf8")
    rows = readers.read_csv_decoded(spark, f"{root}/*", ["key", "name"])
    return rows.select(F.regexp_extract("path", "/(latin|utf8)/", 1).alias("kind"), _c("key").cast("bigint").alias("c_custkey"), "name")


@_query("SELECT c_custkey::VARCHAR AS n_cliente, c_name AS porcentaje_avance, NULL::VARCHAR AS anio_2012, c_mktsegment AS anio_2026_preliminar, 'carga' AS source_name, CASE WHEN c_custkey % 2 = 0 THEN '2026-06-15' ELSE '2026-06-16' END AS extraction_date FROM customer")
def landing_csv_files(spark, sf_dir):
    """Customers as CSV files under date folders, with a BOM and headers as landing files spell them; the names of columns are part of the comparison."""
    root = scratch.new_folder(spark, "csv")
    k = _c("c_custkey")
    c = _table(spark, sf_dir, "customer").select(k.alias("﻿Nº Cliente"), _c("c_name").alias("% Avance"), F.lit(None).cast("string").alias("2012"), _c("c_mktsegment").alias("2026 (*)"), F.when(k % 2 == 0, "2026-06-15").otherwise("2026-06-16").alias("extraction_date"))
    c.write.partitionBy("extraction_date").option("header", True).csv(f"{root}/mef/clientes")
    found = readers.list_files(spark, root, "*.csv", ["clientes"])
    if [r["dataset"] for r in found.select("system", "dataset").distinct().collect()] != ["clientes"]:
        raise ValueError("other datasets than the one that was written")
    rows = readers.read_csv(spark, f"{root}/mef/clientes", base_path=f"{root}/mef/clientes")
    return headers.rename_landing(rows, {"source_name": "carga"}).withColumn("extraction_date", _c("extraction_date").cast("string"))


_CHUNK_SQL = "p AS (SELECT dataset, i, i AS chunk FROM (SELECT o_orderpriority AS dataset, unnest(range(1, ((count(*) + 99) // 100 + 6) // 7 + 1)) AS i FROM orders GROUP BY 1))"


@_query(f"""WITH {_CHUNK_SQL}, m AS (SELECT *, left(dataset, 1) AS d, NOT (left(dataset, 1) = '1' AND chunk = 1) AS there, CASE WHEN left(dataset, 1) = '2' AND chunk = 1 THEN 'FAILED' ELSE 'SUCCESS' END AS status, CASE WHEN left(dataset, 1) = '3' AND chunk = 1 THEN 'b' ELSE 'a' END AS run FROM p)
SELECT dataset, count(*) AS chunks, count(*) FILTER (there) AS chunks_found, count(*) FILTER (there AND status = 'SUCCESS') AS chunks_ok, count(DISTINCT run) FILTER (there)::INTEGER AS runs, sum(chunk * 10) FILTER (there)::BIGINT AS records_written, min(chunk) FILTER (there) AS started_at, max(chunk + 5) FILTER (there) AS finished_at,
  count(*) FILTER (there AND status = 'SUCCESS') = count(*) AND count(DISTINCT run) FILTER (there) = 1 AS ok FROM m GROUP BY dataset""")
def chunk_consolidation(spark, sf_dir):
    """Chunk plans of orders by priority: one lost a manifest, one has a failed chunk, one mixes runs."""
    plan = _chunks(spark, sf_dir)
    one = _c("chunk") == 1
    of = lambda n: F.left("dataset", F.lit(1)) == str(n)
    m = plan.where(~(of(1) & one)).select("dataset", "chunk_id", F.when(of(2) & one, "FAILED").otherwise("SUCCESS").alias("status"), F.lit("2026-06-15").alias("extraction_date"), F.when(of(3) & one, "b").otherwise("a").alias("run_id"), F.lit(100).alias("page_size"), (_c("chunk") * 10).alias("records_written"), _c("chunk").alias("started_at"), (_c("chunk") + 5).alias("finished_at"))
    return landing.consolidate_chunks(plan, m).select("dataset", "chunks", "chunks_found", "chunks_ok", "runs", "records_written", "started_at", "finished_at", "ok")


def _chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = _table(spark, sf_dir, "orders").groupBy(_c("o_orderpriority").alias("dataset")).agg(F.ceil(F.count("*") / 100).alias("total_pages")).withColumn("chunk_size", F.lit(7))
    return landing.split_pages(d).withColumn("chunk", F.substring_index("chunk_id", "_", -1).cast("bigint"))


@_query("""WITH d AS (SELECT DISTINCT c_nationkey AS n FROM customer), c AS (SELECT n, i, i * 10 - 9 - CASE WHEN n % 4 = 1 AND i = 2 THEN 3 ELSE 0 END AS a, i * 10 AS b FROM d, range(1, 5) r(i) WHERE NOT (n % 4 = 2 AND i = 2) AND NOT (n % 4 = 0 AND i = 4))
SELECT n AS dataset, CASE WHEN n % 4 = 3 THEN 'DUPLICATE' WHEN n % 4 = 1 THEN 'OVERLAP' WHEN n % 4 = 2 THEN 'GAP' END AS fault, n % 4 > 0 AS covered, CASE WHEN n % 4 = 3 THEN 2 ELSE 1 END::BIGINT AS times FROM d WHERE n % 4 > 0
UNION ALL SELECT n, NULL, false, 0 FROM d WHERE n % 4 = 0""")
def page_range_faults(spark, sf_dir):
    """Ranges of four chunks a nation: by turns one lacks its end, one overlaps, one has a gap and one stands twice."""
    d = _table(spark, sf_dir, "customer").select(_c("c_nationkey").alias("dataset")).distinct()
    n, i = _c("dataset"), _c("i")
    c = d.select("dataset", F.explode(F.sequence(F.lit(1), F.lit(4))).alias("i")).where(~((n % 4 == 2) & (i == 2)) & ~((n % 4 == 0) & (i == 4)))
    c = c.select("dataset", i.cast("string").alias("chunk_id"), (i * 10 - 9 - F.when((n % 4 == 1) & (i == 2), 3).otherwise(0)).alias("page_start"), (i * 10).alias("page_end"))
    c = c.union(c.where((n % 4 == 3) & (_c("chunk_id") == "3")).withColumn("chunk_id", F.lit("3b")))
    faults = landing.page_faults(c).groupBy("dataset", "fault").agg(F.count("*").alias("times"))
    covered = landing.covers_all(c, d.withColumn("total_pages", F.lit(40)))
    return covered.join(faults, "dataset", "left").select("dataset", "fault", "covered", F.coalesce("times", F.lit(0)).alias("times"))


@_query("SELECT c_custkey FROM customer")
def wrapped_json_records(spark, sf_dir):
    """Customers by nation in documents that wrap their list under one key or another, are a list, or one record."""
    record = F.struct("c_custkey", "c_name")
    c = _table(spark, sf_dir, "customer").groupBy("c_nationkey", F.floor(_c("c_custkey") / 20).alias("g")).agg(F.collect_list(record).alias("r"))
    kind = _c("c_nationkey") % 4
    body = F.when(kind == 0, _json(F.lit(1).alias("n"), _c("r").alias("data"))).when(kind == 1, _json(_c("r").alias("records"))).when(kind == 2, F.to_json("r"))
    single = c.where(kind == 3).select(F.explode("r").alias("r")).select(F.to_json("r").alias("payload"))
    records = readers.read_wrapped(c.where(kind < 3).select(body.alias("payload")).union(single))
    return records.select(F.get_json_object("record", "$.c_custkey").cast("bigint").alias("c_custkey"))


@_query("SELECT year(o_orderdate)::VARCHAR AS year, count(*) AS records, sum(o_orderkey)::BIGINT AS keys FROM orders GROUP BY 1")
def year_folders(spark, sf_dir):
    """Orders written by the year in a label, read back by folder."""
    path = scratch.new_folder(spark, "years")
    sinks.write_by_year(_table(spark, sf_dir, "orders").select("o_orderkey", F.concat(F.lit("Año fiscal "), F.year("o_orderdate").cast("string"), F.lit(" (*)")).alias("ano")), path)
    back = spark.read.schema("o_orderkey long, ano string, year string").parquet(path)
    return back.groupBy("year").agg(F.count("*").alias("records"), F.sum("o_orderkey").alias("keys"))


@_query("SELECT row_number() OVER (ORDER BY CASE WHEN o_orderkey % 6 > 0 THEN o_orderpriority END ASC NULLS FIRST, o_totalprice DESC, o_orderkey) AS row_no, o_orderkey, CASE WHEN o_orderkey % 6 > 0 THEN o_orderpriority END AS priority FROM orders")
def ordered_report(spark, sf_dir):
    """Orders in a total order over several tasks' files, nulls first, numbered through."""
    path = scratch.new_folder(spark, "ordered")
    o = _table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", F.when(_c("o_orderkey") % 6 > 0, _c("o_orderpriority")).alias("priority"))
    sinks.write_ordered(o, path, F.asc_nulls_first("priority"), F.desc("o_totalprice"), F.asc("o_orderkey"), files=7)
    return sinks.read_ordered(spark, path).select("row_no", "o_orderkey", "priority")


def current_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The results of rules over one date of a partitioned table."""
    path = scratch.new_folder(spark, "runs")
    k = _c("o_orderkey")
    o = _table(spark, sf_dir, "orders").select((k - k % 3).alias("key"), F.when(k % 11 == 0, " ").otherwise(_c("o_orderpriority")).alias("priority"), "o_totalprice", F.when(k % 4 == 0, "2026-06-15").otherwise("2026-06-16").alias("extraction_date"))
    o.write.partitionBy("extraction_date").parquet(path)
    table = spark.read.schema(o.schema).parquet(path)
    rules = [Rule("filled", "orders", "not_empty"), Rule("priority", "orders", "nulls", {"fields": ["priority"]}), Rule("price", "orders", "where", {"condition": "o_totalprice > 200000"}), Rule("grain", "orders", "unique", {"keys": ["key"]}), Rule("no_column", "orders", "where", {"condition": "nothing > 1"}), Rule("no_table", "elsewhere", "not_empty")]
    return run_rules(spark, {"orders": table}, rules, {"extraction_date": "2026-06-16"})


@_query("""WITH o AS (SELECT o_orderkey - o_orderkey % 3 AS key, o_orderkey % 11 = 0 AS blank, o_totalprice FROM orders WHERE o_orderkey % 4 > 0), r AS (
SELECT 'filled' AS check_id, 0 AS failed_rows UNION ALL SELECT 'priority', count(*) FILTER (blank) FROM o UNION ALL SELECT 'price', count(*) FILTER (o_totalprice > 200000) FROM o
UNION ALL SELECT 'grain', count(*) FROM (SELECT key FROM o GROUP BY key HAVING count(*) > 1) UNION ALL SELECT 'no_column', 1 UNION ALL SELECT 'no_table', 1) SELECT check_id, failed_rows, failed_rows = 0 AS passed FROM r""")
def rules_current_run(spark, sf_dir):
    return current_run(spark, sf_dir).select("check_id", "failed_rows", "passed")


@_query("SELECT o_orderpriority AS ano, count(*) AS records, 2 * count(*) AS twice FROM orders GROUP BY 1")
def managed_table(spark, sf_dir):
    """A table made from a contract, filled while empty, replaced and added to; a dry run changes nothing."""
    name = f"t_{uuid.uuid4().hex}"
    fields = [{"name": "key", "type": "INT64", "mode": "REQUIRED"}, {"name": "ano", "type": "STRING"}]
    contracts.create_table(spark, name, fields)
    rows = contracts.project(_table(spark, sf_dir, "orders").select(_c("o_orderkey").alias("key"), _c("o_orderpriority").alias("ano")), fields)
    sinks.write_table(spark, rows, name, "EMPTY", create="NEVER")
    sinks.write_table(spark, rows, name, "TRUNCATE")
    sinks.dry_run(rows)
    once = spark.table(name).groupBy("ano").agg(F.count("*").alias("records"))
    once = spark.createDataFrame(once.collect(), once.schema)  # a row a priority
    sinks.write_table(spark, rows, name, "APPEND")
    return spark.table(name).groupBy("ano").agg(F.count("*").alias("twice")).join(once, "ano")


# --- texts, numbers, periods ----------------------------------------------------------------------------


@_query("""WITH p AS (SELECT *, p_partkey % 6 AS m FROM part) SELECT p_partkey, CASE m WHEN 0 THEN 'categoria_presupuestal' WHEN 1 THEN 'producto' WHEN 2 THEN 'actividad' WHEN 3 THEN 'generica' WHEN 4 THEN 'categoria' ELSE 'entidad' END AS level,
  CASE m WHEN 0 THEN '0066' WHEN 1 THEN '3000123' WHEN 2 THEN '5000123' WHEN 3 THEN '2.3' WHEN 4 THEN '12-3.4' ELSE '' END AS code, p_name AS description, m IN (0, 1, 2, 3) AS coded, contains(p_type, 'STEEL') AND contains(p_type, 'BRUSHED') AS brushed_steel, upper(p_name) || ' ACCION UNICA' AS portal FROM p""")
def text_descriptors(spark, sf_dir):
    """Budget descriptors of every kind, their terms and portal keys."""
    m = _c("p_partkey") % 6
    start = F.element_at(F.array(*map(F.lit, ("0066: ", " 3000123:  ", "5000123: ", "2.3: ", "Categoría 12-3.4 :  ", ""))), (m + 1).cast("int"))
    d = F.concat(start, "p_name")
    p = _table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type", text.hierarchy(d).alias("h"), text.code_and_description(d).alias("s"))
    return p.select("p_partkey", "h.level", "h.code", "h.description", (~_c("s.code").isin("") & ~_c("s.code").startswith("Categ")).alias("coded"), text.contains_all(F.lower("p_type"), ["Stéel", "brushed"]).alias("brushed_steel"), text.portal_key(F.concat(F.lower("p_name"), F.lit("  acción  única "))).alias("portal"))


_OC = "CAST(floor(o_totalprice * 100 + 0.5) AS BIGINT)"


@_query(f"""SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN 0 ELSE {_OC} / 100.0::DOUBLE END AS portal, CASE WHEN o_orderkey % 5 = 1 THEN 0 ELSE o_custkey * 1000 END AS enrollment, CASE o_orderkey % 4 WHEN 0 THEN true WHEN 1 THEN false END AS flag,
  upper(o_orderstatus || ' x') AS upper_case, lower(o_orderpriority) AS lower_case FROM orders""")
def numbers_portal(spark, sf_dir):
    """Figures as portals and enrollment tables spell them, flags and cases."""
    k, c = _c("o_orderkey"), F.floor(_c("o_totalprice") * 100 + 0.5).cast("bigint")
    shown = F.concat(F.lit("S/ "), F.format_number(F.floor(c / 100), 0), F.lit("."), F.lpad((c % 100).cast("string"), 2, "0"), F.lit(" soles"))
    flag = F.element_at(F.array(*map(F.lit, (" Sí ", "N", "maybe", ""))), (k % 4 + 1).cast("int"))
    return _table(spark, sf_dir, "orders").select("o_orderkey", numbers.portal_number(F.when(k % 10 == 0, "-").when(k % 5 == 0, " ").otherwise(shown)).alias("portal"), numbers.enrollment_number(F.when(k % 5 == 1, "—").otherwise(F.concat(F.format_number(_c("o_custkey") * 1000, 0), F.lit(" alumnos")))).alias("enrollment"), numbers.bool_safe(flag).alias("flag"), text.to_case(F.concat("o_orderstatus", F.lit(" x")), "upper").alias("upper_case"), text.to_case(_c("o_orderpriority"), "lower").alias("lower_case"))


_MONTHS_SQL = "['ENERO','FEBRERO','MARZO','ABRIL','MAYO','JUNIO','JULIO','AGOSTO','SETIEMBRE','OCTUBRE','NOVIEMBRE','DICIEMBRE']"


@_query(f"""WITH o AS (SELECT o_orderkey, year(o_orderdate) AS y, month(o_orderdate) AS m, quarter(o_orderdate) AS q, o_orderkey % 5 AS k FROM orders)
SELECT o_orderkey, CASE WHEN k = 0 THEN 'ANUAL' WHEN k = 1 THEN 'MENSUAL' ELSE 'TRIMESTRAL' END AS kind, CASE WHEN k = 0 THEN y::VARCHAR WHEN k = 1 THEN y || '-' || lpad(m::VARCHAR, 2, '0') ELSE y || '-Q' || q END AS value,
  CASE WHEN k > 0 THEN q END::INTEGER AS quarter, CASE WHEN k = 1 THEN m END::INTEGER AS month, CASE WHEN k = 1 THEN {_MONTHS_SQL}[m] END AS month_name, y::INTEGER AS year, k = 4 AS preliminary, (o_orderkey % 86400)::DOUBLE + 0.25 AS seconds FROM o""")
def period_labels(spark, sf_dir):
    """Months, and quarters in figures, ordinals and Roman numerals, with their years and durations."""
    y, m, q, k = F.year("o_orderdate"), F.month("o_orderdate"), F.quarter("o_orderdate"), _c("o_orderkey") % 5
    named = F.element_at(F.array(*[F.lit(x.title()) for x in dates.MONTHS[:8]], F.lit("septiembre"), *[F.lit(x.lower()) for x in dates.MONTHS[9:]]), m)
    ordinal = F.element_at(F.array(*map(F.lit, ("1er", "2do.", "3er", "4to"))), q)
    roman = F.element_at(F.array(*map(F.lit, dates.ROMAN)), q)
    label = F.when(k == 0, "Total").when(k == 1, named).when(k == 2, F.concat(F.lit("Trimestre "), q.cast("string"))).when(k == 3, F.concat(ordinal, F.lit(" Trimestre"))).otherwise(F.concat(roman, F.lit("  trimestre (*)")))
    start = F.to_timestamp(F.lit("2026-01-01 00:00:00"))
    end = F.timestamp_micros(F.unix_micros(start) + _c("o_orderkey") % 86400 * 1_000_000 + 250_000)
    o = _table(spark, sf_dir, "orders").select("o_orderkey", dates.period(label, y).alias("p"), dates.year_token(F.concat(F.lit("Al "), y.cast("string"), label)).alias("year"), dates.is_preliminary(label).alias("preliminary"), dates.duration_seconds(start, end).alias("seconds"))
    return o.select("o_orderkey", "p.*", "year", "preliminary", "seconds")


@_query("""SELECT c_custkey, concat_ws(',', CASE WHEN c_custkey % 7 = 0 THEN 'publica+privada' END, CASE WHEN c_custkey % 11 = 0 THEN 'urbana+rural' END) AS wrong FROM customer WHERE c_custkey % 7 = 0 OR c_custkey % 11 = 0""")
def enrollment_footing(spark, sf_dir):
    """Totals that their parts miss by more than one."""
    k = _c("c_custkey")
    half = F.floor(k / 2)
    rows = _table(spark, sf_dir, "customer").select("c_custkey", k.alias("total"), half.alias("publica"), (k - half + F.when(k % 7 == 0, 2).otherwise(1)).alias("privada"), half.alias("urbana"), (k - half - F.when(k % 11 == 0, 2).otherwise(0)).alias("rural"))
    judged = quarantine.with_errors(rows, [quarantine.cross_foot("total", ["publica", "privada"]), quarantine.cross_foot("total", ["urbana", "rural"])])
    _, bad = quarantine.split(judged)
    return bad.select("c_custkey", F.array_join(F.transform("validation_errors", lambda e: F.substring_index(e["message"], " ", 1)), ",").alias("wrong"))


@_query("""SELECT 'fecha' AS "column", round(count(*) FILTER (o_orderkey % 9 > 0) / count(*), 6)::DOUBLE AS valid_ratio, min(o_orderdate) FILTER (o_orderkey % 9 > 0)::DATE AS first, max(o_orderdate) FILTER (o_orderkey % 9 > 0)::DATE AS last FROM orders WHERE o_orderkey % 8 > 0
UNION ALL SELECT 'ship_date', 1.0, min(l_shipdate)::DATE, max(l_shipdate)::DATE FROM lineitem""")
def date_columns(spark, sf_dir):
    """Dates in two spellings among blanks and other texts."""
    k, d = _c("o_orderkey"), _c("o_orderdate")
    o = _table(spark, sf_dir, "orders").select(F.when(k % 8 == 0, " ").when(k % 9 == 0, "pronto").when(k % 2 == 0, F.date_format(d, "dd/MM/yyyy HH:mm")).otherwise(F.date_format(d, "yyyy-MM-dd")).alias("fecha"))
    li = _table(spark, sf_dir, "lineitem").select(F.date_format("l_shipdate", "yyyy-MM-dd").alias("ship_date"))
    return profile.date_profile(o, ["fecha"]).union(profile.date_profile(li, ["ship_date"]))


@_query("SELECT c_name AS carrera_estudio, c_mktsegment AS universidad, NULL::VARCHAR AS region, c_custkey::VARCHAR AS source_page FROM customer")
def header_mapping(spark, sf_dir):
    """Columns of a report found under other spellings and aliases; a name that no column has is null."""
    raw = _table(spark, sf_dir, "customer").select(_c("c_name").alias("﻿Carrera  de Estudio"), _c("c_mktsegment").alias("IES"), _c("c_custkey").cast("string").alias("Source_Page"))
    found = headers.resolve(raw.columns, {"carrera_estudio": [], "universidad": ["institucion", "ies"], "region": ["departamento"], "source_page": []}, ["carrera_estudio", "universidad"])
    return raw.select(*[(F.col(f"`{c}`") if c else F.lit(None).cast("string")).alias(n) for n, c in found.items()])


@_query("""SELECT 'blank' AS "column", 'DROP' AS recommendation UNION ALL SELECT 'constant', 'REVIEW' UNION ALL SELECT 'rare', 'REVIEW' UNION ALL SELECT 'name', 'KEEP'""")
def column_recommendations(spark, sf_dir):
    c = _table(spark, sf_dir, "customer").select(F.lit(" ").alias("blank"), F.lit("x").alias("constant"), F.when(_c("c_custkey") % 10 == 0, _c("c_name")).alias("rare"), _c("c_name").alias("name"))
    return profile.columns_profile(c).select("column", profile.recommendation(_c("null_percent"), _c("distinct_values")).alias("recommendation"))


def _sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = _c("o_orderkey")
    whole = F.regexp_replace(F.format_number(_c("o_custkey") * 1000, 0), ",", ".")
    return _table(spark, sf_dir, "orders").select(
        F.when(k % 3 > 0, " - ").otherwise(_c("o_orderstatus")).alias("estado"),
        F.when(k % 10 == 0, "unos").otherwise(F.concat(whole, F.lit(",5"))).alias("monto"),
        F.when(k % 7 == 0, None).when(k % 9 == 0, "luego").otherwise(F.date_format("o_orderdate", "dd/MM/yyyy")).alias("fecha_carga"),
        F.lit("null").alias("vacio"),
        (k - k % 2).cast("string").alias("clave"),
    )


_SAMPLE_SQL = """s AS (SELECT CASE WHEN o_orderkey % 3 = 0 THEN o_orderstatus END AS estado, CASE WHEN o_orderkey % 10 = 0 THEN 'unos' ELSE regexp_replace(format('{:,}', o_custkey * 1000), ',', '.', 'g') || ',5' END AS monto,
  CASE WHEN o_orderkey % 7 = 0 THEN NULL WHEN o_orderkey % 9 = 0 THEN 'luego' ELSE strftime(o_orderdate, '%d/%m/%Y') END AS fecha_carga, NULL::VARCHAR AS vacio, (o_orderkey - o_orderkey % 2)::VARCHAR AS clave,
  CASE WHEN o_orderkey % 10 > 0 THEN o_custkey * 1000 + 0.5::DOUBLE END AS amount, CASE WHEN o_orderkey % 7 > 0 AND o_orderkey % 9 > 0 THEN o_orderdate::DATE END AS day FROM orders)"""


def _column_sql(name: str, number: str, date: str) -> str:
    top = f"(SELECT string_agg(v || '=' || n, '|' ORDER BY n DESC, v) FROM (SELECT {name} AS v, count(*) AS n FROM s WHERE {name} IS NOT NULL GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5))"
    few = f"(SELECT string_agg(v, '|' ORDER BY v) FROM (SELECT DISTINCT {name} AS v FROM s WHERE {name} IS NOT NULL ORDER BY 1 LIMIT 5))"
    much = lambda c: f"count({c}) > 0 AND count({c}) >= 0.8 * count({name})"
    return f"""SELECT '{name}' AS "column", count({name}) AS non_null_count, count(*) - count({name}) AS null_count, round(100.0::DOUBLE * (count(*) - count({name})) / count(*), 2) AS null_percentage, count(DISTINCT {name}) AS unique_count, round(100.0::DOUBLE * count(DISTINCT {name}) / count(*), 2) AS unique_percentage, coalesce({few}, '') AS sample_values, coalesce({top}, '') AS top_values,
  {much(number)} AS is_mostly_numeric, count({number}) AS numeric_valid_count, count({name}) - count({number}) AS numeric_invalid_count, CASE WHEN {much(number)} THEN min({number}) END::DOUBLE AS numeric_min, CASE WHEN {much(number)} THEN max({number}) END::DOUBLE AS numeric_max, CASE WHEN {much(number)} THEN round(avg({number}), 4) END::DOUBLE AS numeric_mean,
  {much(date)} AS is_mostly_date, count({date}) AS date_valid_count, count({name}) - count({date}) AS date_invalid_count, CASE WHEN {much(date)} THEN strftime(min({date}), '%Y-%m-%d') END AS date_min, CASE WHEN {much(date)} THEN strftime(max({date}), '%Y-%m-%d') END AS date_max FROM s"""


_NO = "NULL::DOUBLE"
_COLUMNS_SQL = " UNION ALL ".join([_column_sql("estado", _NO, "NULL::DATE"), _column_sql("monto", "amount", "NULL::DATE"), _column_sql("fecha_carga", _NO, "day"), _column_sql("vacio", _NO, "NULL::DATE"), _column_sql("clave", "clave::DOUBLE", "NULL::DATE")])


@_query(f"WITH {_SAMPLE_SQL} {_COLUMNS_SQL}")
def sample_columns(spark, sf_dir):
    """The whole profile of a sample's columns: nulls by several names, numbers with decimal commas, dates, frequent values."""
    p = profile.profiled_columns(_sample(spark, sf_dir))
    day = lambda c: F.date_format(c, "yyyy-MM-dd").alias(c)
    return p.select(*[c for c in p.columns if c not in ("sample_values", "top_values", "date_min", "date_max")], F.array_join("sample_values", "|").alias("sample_values"), F.array_join(F.transform("top_values", lambda x: F.concat_ws("=", x["value"], x["times"])), "|").alias("top_values"), day("date_min"), day("date_max"))


@_query(f"""WITH {_SAMPLE_SQL} SELECT count(*) AS row_count, 5::BIGINT AS column_count, count(*) - (SELECT count(*) FROM (SELECT DISTINCT estado, monto, fecha_carga, clave FROM s)) AS duplicated_rows,
  concat_ws('|', CASE WHEN count(estado) <= 0.5 * count(*) THEN 'estado' END, 'vacio') AS high_null_columns, 'clave|monto' AS mostly_numeric_columns, 'fecha_carga' AS mostly_date_columns FROM s""")
def sample_facts(spark, sf_dir):
    f = profile.table_facts(_sample(spark, sf_dir))
    return f.select("row_count", "column_count", "duplicated_rows", *[F.array_join(c, "|").alias(c) for c in ("high_null_columns", "mostly_numeric_columns", "mostly_date_columns")])
