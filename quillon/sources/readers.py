"""Scans of all-string landing data: CSV, JSON lines, paged payloads, HTML tables, wrapped JSON."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillon.functions.bind import let
from quillon.functions.text import cell_text, match_key


def _strings(columns: list[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def read_csv(spark: SparkSession, path: str, columns: list[str] | None = None, base_path: str | None = None) -> DataFrame:
    """CSV with a header, every field a string; a BOM is dropped and short rows are filled with null."""
    r = spark.read.option("header", True).option("inferSchema", False).option("multiLine", False)
    r = r.option("basePath", base_path) if base_path else r
    return (r.schema(_strings(columns)) if columns else r).csv(path)


def read_jsonl(spark: SparkSession, path: str, columns: list[str]) -> tuple[DataFrame, DataFrame]:
    """(rows, rejects): JSON lines as strings, and the lines that don't parse as PARSE_ERROR rejects.

    Blank lines are skipped.
    """
    lines = spark.read.text(path).where(F.trim("value") != "")
    schema = _strings([*columns, "_corrupt"])
    parsed = lines.select("value", F.from_json("value", schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}).alias("r"))
    bad = F.col("r._corrupt").isNotNull()
    rows = parsed.where(~bad).select(*[F.col("r")[c].alias(c) for c in columns])
    rejects = parsed.where(bad).select(
        F.lit("parse").alias("stage"), F.lit("PARSE_ERROR").alias("error_code"), F.lit("line is no JSON object").alias("error_message"), F.to_json(F.struct(F.col("value").alias("raw_line"))).alias("raw_record")
    )
    return rows, rejects


def partition_value(path: Column, key: str) -> Column:
    """The value of `key=` in a file's path."""
    return F.nullif(F.regexp_extract(path, rf"(?:^|/){key}=([^/]+)", 1), F.lit(""))


def expand(spark: SparkSession, pattern: str) -> list[str]:
    """The files that a glob matches, sorted; none is an error."""
    try:
        found = sorted(r["path"] for r in spark.read.format("binaryFile").load(pattern).select("path").collect())  # names of the files of one load
    except AnalysisException as e:
        raise FileNotFoundError(f"nothing matches {pattern}") from e
    if not found:
        raise FileNotFoundError(f"nothing matches {pattern}")
    return found


def list_files(spark: SparkSession, root: str, pattern: str = "*", datasets: list[str] | None = None) -> DataFrame:
    """(path, name, length, modified, system, dataset, extraction_date, year) of the files under a root, of some datasets or all."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(root).select("path", "length", F.col("modificationTime").alias("modified"))
    p = F.col("path")
    if datasets is not None:
        files = files.where(F.regexp_extract(p, "/([^/]+)/extraction_date=", 1).isin(*datasets))
    return files.select(
        "path",
        F.regexp_extract(p, "([^/]+)$", 1).alias("name"),
        "length",
        "modified",
        F.regexp_extract(p, "/([^/]+)/[^/]+/extraction_date=", 1).alias("system"),
        F.regexp_extract(p, "/([^/]+)/extraction_date=", 1).alias("dataset"),
        partition_value(p, "extraction_date").alias("extraction_date"),
        partition_value(p, "year").alias("year"),
    )


def decode_bytes(content: Column) -> Column:
    """UTF-8 without BOM if the bytes are that, else Latin-1."""
    text = F.when(F.is_valid_utf8(content.cast("string")), content.cast("string")).otherwise(F.decode(content, "ISO-8859-1"))
    return F.regexp_replace(text, "^\\uFEFF", "")


def decoded_lines(spark: SparkSession, path: str) -> DataFrame:
    """(path, id, is_first, value) of the lines of text files, read in splits: UTF-8 if the whole file is that, else Latin-1.

    Lines come as their bytes; whether they are UTF-8 is folded by file, and the answer, a row a file, is
    joined back. A BOM before a file's first line is dropped. id grows with the lines of a file.
    """
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("path"), F.monotonically_increasing_id().alias("id"), "value")
    files = lines.groupBy("path").agg(F.bool_and(F.is_valid_utf8("value")).alias("utf8"), F.min("id").alias("first"))
    both = lines.join(files, "path").withColumn("value", F.when(F.col("utf8"), F.col("value")).otherwise(F.decode(F.col("value").cast("binary"), "ISO-8859-1")))
    first = F.col("id") == F.col("first")
    return both.select("path", "id", first.alias("is_first"), F.when(first, F.regexp_replace("value", "^\\uFEFF", "")).otherwise(F.col("value")).alias("value"))


def read_csv_decoded(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """Rows of CSV files in either encoding, each with a header line; cells don't hold line breaks."""
    rows = decoded_lines(spark, path).where(~F.col("is_first") & (F.trim("value") != ""))
    return rows.select("path", F.from_csv("value", ", ".join(f"`{c}` string" for c in columns)).alias("r")).select("path", "r.*")


def json_records(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """(path, line, record map<string, string>) of the filled JSON lines under a path; a line that is no object has a null record."""
    lines = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", pattern).text(path).where(F.trim("value") != "")
    return lines.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("line"), F.from_json("value", "map<string,string>").alias("record"))


def json_documents(spark: SparkSession, root: str, name: str, fields: list[str]) -> DataFrame:
    """(path, system, dataset, fields...) of files of one name under a root, each a JSON object; what isn't one has null fields.

    System and dataset are the folders above extraction_date=, the latter with or without a key before it.
    """
    files = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", name).option("wholetext", True).text(root).select(F.col("_metadata.file_path").alias("path"), F.from_json("value", "map<string,string>").alias("r"))
    return files.select("path", F.regexp_extract("path", "/([^/]+)/[^/]+/extraction_date=", 1).alias("system"), F.regexp_extract("path", "/(?:[a-z_]+=)?([^/=]+)/extraction_date=", 1).alias("dataset"), *[F.col("r")[f].alias(f) for f in fields])


def fingerprint(content: Column) -> Column:
    """(sha256, length, n_rows, n_columns, header) of a CSV file's bytes; the header is no row, blank lines aren't either."""
    lines = F.split(F.rtrim(decode_bytes(content)), "\r?\n", -1)

    def of(x: Column) -> Column:
        header = F.split(F.get(x, F.lit(0)), ",", -1)
        rows = (F.size(F.filter(x, lambda line: F.trim(line) != "")) - 1).cast("long")
        return F.struct(F.sha2(content, 256).alias("sha256"), F.length(content).cast("long").alias("length"), rows.alias("n_rows"), F.size(header).cast("long").alias("n_columns"), header.alias("header"))

    return let(lines, of)


def fingerprints(spark: SparkSession, path: str) -> DataFrame:
    """(path, and fingerprint()) of landing files, each of which one task reads; see line_fingerprints for large ones."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.select("path", fingerprint(F.col("content")).alias("f")).select("path", "f.*")


def line_fingerprints(spark: SparkSession, path: str) -> DataFrame:
    """(path, lines_hash, n_rows, header) of text files of any size, read in splits: the hash combines those of the lines, whatever their order."""
    lines = spark.read.text(path).select("value", "_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id().alias("id"))
    g = lines.groupBy(F.col("file_path").alias("path")).agg(F.bit_xor(F.xxhash64("value")).alias("lines_hash"), (F.count_if(F.trim("value") != "") - 1).alias("n_rows"), F.min_by("value", F.struct("file_block_start", "id")).alias("header"))
    return g.withColumn("header", F.split("header", ",", -1))


# --- paged payloads -----------------------------------------------------------------------------

PAYLOAD = "page string, total string, records string, rows array<struct<id:string,cell:array<string>>>"


def flatten_pages(payloads: DataFrame, columns: list[str], body: str = "payload") -> DataFrame:
    """One row for each entry of `rows`: its cells by position, its id as source_row_id, surplus cells in an array.

    payloads holds JSON text {total, page, records, rows: [{id, cell: [...]}]}. A payload that doesn't
    have rows is an error when it is read.
    """
    p = payloads.withColumn("_p", F.from_json(body, PAYLOAD))
    p = p.withColumn("_rows", F.when(F.col("_p.rows").isNotNull(), F.col("_p.rows")).otherwise(F.raise_error(F.lit("payload without rows")).cast("array<struct<id:string,cell:array<string>>>")))
    rows = p.select(*[c for c in payloads.columns if c != body], F.col("_p.page").try_cast("long").alias("page"), F.explode("_rows").alias("_r"))
    cells = F.col("_r.cell")
    n = len(columns)
    return rows.select(*[c for c in rows.columns if c != "_r"], F.col("_r.id").alias("source_row_id"), *[F.get(cells, F.lit(i)).alias(c) for i, c in enumerate(columns)], F.when(F.size(cells) > n, F.slice(cells, n + 1, F.greatest(F.size(cells) - n, F.lit(0)))).alias("surplus_cells"))


def page_totals(payloads: DataFrame, key: str = "dataset", body: str = "payload") -> DataFrame:
    """(key, reported_records, pages_read, first_page, last_page) of stored payloads."""
    p = payloads.select(key, F.from_json(body, PAYLOAD).alias("p"))
    page = F.col("p.page").try_cast("long")
    return p.groupBy(key).agg(F.max(F.col("p.records").try_cast("long")).alias("reported_records"), F.count("*").alias("pages_read"), F.min(page).alias("first_page"), F.max(page).alias("last_page"))


def assert_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    if missing := [c for c in columns if c not in df.columns]:
        raise ValueError(f"columns missing after flattening: {missing}")
    return df


def read_wrapped(payloads: DataFrame, body: str = "payload") -> DataFrame:
    """Each record (JSON text) of documents that keep their list under data, rows, result, results,
    records or items, or are a list or a record themselves."""
    keys = ("data", "rows", "result", "results", "records", "items")
    found = F.coalesce(*[F.from_json(F.get_json_object(body, f"$.{k}"), "array<string>") for k in keys], F.when(F.trim(F.col(body)).startswith("["), F.from_json(body, "array<string>")), F.array(F.col(body)))
    return payloads.select(*[c for c in payloads.columns if c != body], F.explode(found).alias("record"))


# --- HTML tables --------------------------------------------------------------------------------

_TAG = r"(?s)<[^>]*>"


def _text_of(html: Column) -> Column:
    t = F.regexp_replace(html, _TAG, " ")
    for entity, char in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        t = F.replace(t, F.lit(entity), F.lit(char))
    return cell_text(t)


# Patterns take runs without a tag at once and end where a lazy one would.
_TABLE = r"(?is)<table\b[^<]*+(?:<(?!/table>)[^<]*+)*+</table>"
_ROW = r"(?is)<tr\b[^<]*+(?:<(?!/tr>)[^<]*+)*+</tr>"
#: A whole cell, and its content; a cell that ends before its opening tag does is empty.
_TD = r"(?is)<t[dh]\b[^<]*+(?:<(?!/t[dh]>)[^<]*+)*+</t[dh]>"
_CONTENT = r"(?is)<t[dh]\b(?:(?!</t[dh]>)[^>])*+(?:>([^<]*+(?:<(?!/t[dh]>)[^<]*+)*+))?</t[dh]>"
#: Words with single blanks between them and no tag or entity, which _text_of leaves as they are; words here are of Latin and some other letters.
_WORDS = r"(?:[!-%'-;=-~\u00A1-\u167F]++(?: [!-%'-;=-~\u00A1-\u167F]++)*+)?"
#: A table of rows of cells without spans that hold such words alone, and the content of these cells.
_PLAIN_TABLE = r"(?i)^<table\b[^<>]*+>(?:(?:\s*+<t[dh](?:>|\s(?![^<>]*span)[^<>]*+>)" + _WORDS + r"</t[dh]>)++|\s*+</?t(?:r|head|body|foot)(?:>|\s[^<>]*+>))*+\s*+</table>\z"
_PLAIN_CONTENT = r"(?i)<t[dh]\b[^>]*+>([^<]*+)<"


_CELL = "struct<text:string,across:int,down:int>"
_PENDING = "map<int,struct<text:string,left:int>>"


def _span(cell: Column, name: str) -> Column:
    return F.coalesce(F.nullif(F.regexp_extract(cell, rf"(?is)^<t[dh]\b[^>]*\b{name}\s*=\s*[\"']?(\d+)", 1), F.lit("")).cast("int"), F.lit(1))


def _filled(state: Column) -> Column:
    """state(pending, row) with what earlier rows let down into the next columns, as far as they go on without a gap."""
    pending, at = state["pending"], F.size(state["row"])
    reach = F.sequence(F.lit(0), F.size(F.map_keys(pending)))
    run = F.aggregate(reach, F.lit(0), lambda k, i: F.when((k == i) & F.map_contains_key(pending, at + i), k + 1).otherwise(k))

    def take(n: Column) -> Column:
        down = F.transform(F.slice(F.transform(reach, lambda i: at + i), F.lit(1), n), lambda c: pending[c]["text"])
        used = F.transform_values(pending, lambda c, v: F.when((c >= at) & (c < at + n), F.struct(v["text"].alias("text"), (v["left"] - 1).alias("left"))).otherwise(v))
        return F.struct(F.map_filter(used, lambda c, v: v["left"] > 0).alias("pending"), F.concat(state["row"], down).alias("row"))

    return F.when(F.map_contains_key(pending, at), let(run, take)).otherwise(state)


def _placed(state: Column, cell: Column) -> Column:
    """state with a cell put into the next free columns; one of several rows is let down from them."""

    def put(s: Column) -> Column:
        at, n = F.size(s["row"]), cell["across"]
        columns = F.slice(F.transform(F.sequence(F.lit(0), n), lambda i: at + i), F.lit(1), n)
        below = F.map_from_arrays(columns, F.array_repeat(F.struct(cell["text"].alias("text"), (cell["down"] - 1).alias("left")), n)).cast(_PENDING)
        others = F.map_filter(s["pending"], lambda c, v: (c < at) | (c >= at + n))
        return F.struct(F.when(cell["down"] > 1, F.map_concat(others, below)).otherwise(s["pending"]).alias("pending"), F.concat(s["row"], F.array_repeat(cell["text"], n)).alias("row"))

    return let(_filled(state), put)


def span_grid(rows: Column) -> Column:
    """array<array<string>> of array<array<struct<text, across, down>>>: a cell stands in all columns and rows that it spans.

    The rows of one table are folded in their order; the state is a map of the columns into which cells
    of earlier rows reach, with how many rows are left to them. A cell takes the next free columns; columns
    to the right of a row's last cell are filled only as far as they follow on it. Where a span runs over
    columns that are reserved, it takes them.
    """
    start = F.struct(F.create_map().cast(_PENDING).alias("pending"), F.array().cast("array<array<string>>").alias("out"))

    def row(state: Column, cells: Column) -> Column:
        begin = F.struct(state["pending"].alias("pending"), F.array().cast("array<string>").alias("row"))
        done = let(F.aggregate(cells, begin, _placed), _filled)
        return let(done, lambda s: F.struct(s["pending"].alias("pending"), F.concat(state["out"], F.array(s["row"])).alias("out")))

    return F.aggregate(rows, start, row, lambda s: s["out"])


def table_grid(pages: DataFrame, html: str = "html") -> DataFrame:
    """(the other columns, table_no, row_no, cells): every table row that has cells, these repeated over their colspan and rowspan."""
    keep = [c for c in pages.columns if c != html]
    found = lambda c, pattern, group=0: F.regexp_extract_all(c, F.lit(pattern), F.lit(group))
    some = lambda cells: F.filter(cells, lambda r: F.size(r) > 0)
    tables = pages.select(*keep, F.posexplode(found(html, _TABLE)).alias("table_no", "_t"))
    cell = lambda x: F.struct(_text_of(F.regexp_extract(x, r"(?is)^<t[dh]\b[^>]*>(.*?)</t[dh]>$", 1)).alias("text"), _span(x, "colspan").alias("across"), _span(x, "rowspan").alias("down")).cast(_CELL)
    spanned = some(F.transform(found("_t", _ROW), lambda r: F.transform(found(r, _TD), cell)))
    texts = some(F.transform(found("_t", _ROW), lambda r: F.transform(found(r, _CONTENT, 1), _text_of)))
    plain = some(F.transform(found("_t", _ROW), lambda r: found(r, _PLAIN_CONTENT, 1)))
    # most tables have no spans and need no fold, and the cells of most need no cleaning
    grid = F.when(F.col("_t").rlike(_PLAIN_TABLE), plain).when(F.contains(F.lower("_t"), F.lit("span")), span_grid(spanned)).otherwise(texts)
    return tables.select(*keep, "table_no", F.posexplode(grid).alias("row_no", "cells"))


def table_records(pages: DataFrame, html: str = "html") -> DataFrame:
    """(the other columns, table_no, row_no, record map): the first row names the cells; missing cells
    are empty and rows without any text are dropped."""
    keep = [c for c in pages.columns if c != html]
    grid = table_grid(pages, html)
    head = grid.where("row_no = 0").select(*keep, "table_no", F.col("cells").alias("headers"))
    body = grid.where("row_no > 0 AND exists(cells, c -> c <> '')")
    joined = body.join(head, [*keep, "table_no"])
    record = F.map_from_arrays(F.col("headers"), F.transform("headers", lambda h, i: F.coalesce(F.get("cells", i), F.lit(""))))
    return joined.select(*keep, "table_no", "row_no", record.alias("record"))


def section_rows(grid: DataFrame, page: str, start: str, ends: list[str], expected: int | None = None) -> DataFrame:
    """Rows of a page after the row that says start and before the next that says one of ends.

    With expected, pages whose section has another number of rows are left out.
    """
    w = Window.partitionBy(page).orderBy("table_no", "row_no")
    key = match_key(F.get("cells", F.lit(0)))
    is_start, is_end = F.coalesce(key == start, F.lit(False)), F.coalesce(key.isin(*ends), F.lit(False))
    g = grid.withColumn("_s", F.sum(is_start.cast("int")).over(w)).withColumn("_e", F.sum(F.when(F.col("_s") > 0, is_end.cast("int")).otherwise(0)).over(w)).where((F.col("_s") >= 1) & (F.col("_e") == 0) & ~is_start)
    if expected is not None:
        g = g.withColumn("_n", F.count("*").over(Window.partitionBy(page))).where(F.col("_n") == expected).drop("_n")
    return g.drop("_s", "_e")


def budget_rows(grid: DataFrame, page: str, metrics: list[str]) -> DataFrame:
    """Rows whose last cells are the metrics: descriptor, metrics as text, the first row of each descriptor of a page.

    A row counts if it has a descriptor, enough cells and a digit among its metrics.
    """
    n = len(metrics)
    rows = grid.where(F.size("cells") > n).withColumn("_m", F.slice("cells", -n, n)).withColumn("descriptor", F.get("cells", F.size("cells") - n - 1))
    rows = rows.where((F.trim("descriptor") != "") & F.exists("_m", lambda x: x.rlike(r"\d")))
    first = F.row_number().over(Window.partitionBy(page, "descriptor").orderBy("table_no", "row_no"))
    return rows.withColumn("_n", first).where("_n = 1").select(page, "descriptor", *[F.get("_m", F.lit(i)).alias(m) for i, m in enumerate(metrics)])


def links(pages: DataFrame, html: str = "html") -> DataFrame:
    """(the other columns, link_no, href, label) of a page's anchors."""
    keep = [c for c in pages.columns if c != html]
    found = pages.select(*keep, F.posexplode(F.regexp_extract_all(html, F.lit(r"(?is)<a\b[^>]*>.*?</a>"), F.lit(0))).alias("link_no", "_a"))
    return found.select(*keep, "link_no", F.regexp_extract("_a", r"(?is)href\s*=\s*[\"']([^\"']*)", 1).alias("href"), _text_of(F.col("_a")).alias("label"))
