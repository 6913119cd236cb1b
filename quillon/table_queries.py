"""Queries that run the cleaned-table specs, the Gold views, the rules and the analytic tables over the test tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillon.functions.text import region_key
from quillon.operators import canonical
from quillon.operators.quality import run_rules
from quillon.plans import predictive, silver, views
from quillon.plans.rules import all_rules
from quillon.sources import contracts, scratch, tables

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_SQL: dict[str, str] = {}
CONTEXT = silver.Context("2026-06-15", "test-run", "2026-06-16 00:00:00")
_RUN = "'{dataset}' AS source_dataset, 'test-run' AS pipeline_run_id"


def _stamp() -> Column:
    return F.lit("2026-06-16 00:00:00").cast("timestamp_ntz")



def _add(name: str, query: Callable[[SparkSession, str], DataFrame], sql: str) -> None:
    _QUERIES[name], _SQL[name] = query, sql


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles, and of the technical fields those that are text."""
    shown = [c for c in df.columns if c not in ("extraction_date", "ingestion_timestamp", "source_system")]
    return df.select(*[F.col(c).cast("double").alias(c) if dict(df.dtypes)[c].startswith("decimal") else F.col(c) for c in shown])


# --- budget tables: raw text of line items -------------------------------------------------------------

_SPACED = lambda c: F.concat(F.lit("  "), c, F.lit("   x "))


def _raw_budget(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as raw budget rows: grouped thousands, dashes, percent signs and blanks in names."""
    whole = F.floor("l_extendedprice")
    code = lambda c: F.concat(F.lit(" "), F.col(c).cast("string"))
    month = F.month("l_shipdate")
    return _table(spark, sf_dir, "lineitem").select(
        F.year("l_shipdate").cast("string").alias("ano"),
        code("l_suppkey").alias("ejecutora_codigo"),
        _SPACED(F.col("l_returnflag")).alias("ejecutora_nombre"),
        code("l_partkey").alias("codigo_producto"),
        _SPACED(F.col("l_linestatus")).alias("producto_proyecto"),
        code("l_linenumber").alias("codigo_actividad"),
        F.when(F.col("l_linenumber") == 2, F.lit(" ")).otherwise(_SPACED(F.col("l_returnflag"))).alias("actividad"),
        code("l_orderkey").alias("codigo_generica"),
        _SPACED(F.col("l_linestatus")).alias("generica"),
        F.lit("PLIEGO").alias("nivel_jerarquia"),
        F.format_number(whole, 0).alias("pia"),
        F.when(F.col("l_linenumber") == 1, "-").otherwise(F.format_number(whole * 2, 0)).alias("pim"),
        F.format_number("l_extendedprice", 2).alias("devengado"),
        F.concat(F.format_number(F.col("l_discount") * 100, 0), F.lit(",5 %")).alias("avance_porcentaje"),
        F.lit("MENSUAL").alias("periodo_tipo"),
        F.date_format("l_shipdate", "yyyy-MM").alias("periodo_valor"),
        F.ceil(month / 3).cast("string").alias("trimestre"),
        F.format_string("%02d", month).alias("mes_numero"),
        F.lit(None).cast("string").alias("mes_nombre"),
        F.lit("surplus").alias("girado"),
    )


_DIMS_SQL = {"": "l_suppkey::VARCHAR AS codigo_entidad, l_returnflag || ' x' AS nombre_entidad", "_producto": "l_partkey::VARCHAR AS codigo_producto, l_linestatus || ' x' AS producto", "_generica": "l_orderkey::VARCHAR AS codigo_generica, l_linestatus || ' x' AS generica"}
_DIMS_SQL["_actividad"] = f"{_DIMS_SQL['_producto']}, l_linenumber::VARCHAR AS codigo_actividad, CASE WHEN l_linenumber <> 2 THEN l_returnflag || ' x' END AS actividad"
_EXECUTED_SQL = "round(l_extendedprice, 2) AS devengado"
_MONEY_SQL = f"floor(l_extendedprice) AS pia, CASE WHEN l_linenumber > 1 THEN floor(l_extendedprice) * 2 END AS pim, {_EXECUTED_SQL}, round(l_discount * 100) + 0.5::DOUBLE AS avance_porcentaje"
_PERIOD_SQL = "'MENSUAL' AS periodo_tipo, strftime(l_shipdate, '%Y-%m') AS periodo_valor, quarter(l_shipdate) AS trimestre, month(l_shipdate) AS mes_numero, NULL::VARCHAR AS mes_nombre"


def _budget_query(dataset: str) -> Callable[[SparkSession, str], DataFrame]:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        raw = _raw_budget(spark, sf_dir)
        if dataset.startswith("presupuesto_actividad"):
            raw = raw.withColumnRenamed("producto_proyecto", "producto")
        return _plain(silver.transform(raw, silver.SPECS["mef", dataset], CONTEXT))

    return query


for _end, _dims in _DIMS_SQL.items():
    _add(f"silver_presupuesto{_end}", _budget_query(f"presupuesto{_end}"), f"SELECT year(l_shipdate) AS ano, {_dims}, {_MONEY_SQL}, {_RUN.format(dataset='presupuesto' + _end)} FROM lineitem")
    _own = f"{_dims}, " if _end else ""
    _add(f"silver_presupuesto{_end}_temporal", _budget_query(f"presupuesto{_end}_temporal"), f"SELECT year(l_shipdate) AS ano, {_PERIOD_SQL}, {_own}{_EXECUTED_SQL}, {_RUN.format(dataset=f'presupuesto{_end}_temporal')} FROM lineitem")
_add("silver_presupuesto_hierarchy", _budget_query("presupuesto_hierarchy"), f"SELECT year(l_shipdate) AS ano, 'PLIEGO' AS nivel_jerarquia, {_DIMS_SQL['']}, {_MONEY_SQL}, {_RUN.format(dataset='presupuesto_hierarchy')} FROM lineitem")

# --- open data ----------------------------------------------------------------------------------------

# A few entries of the catalogue of canonical values.
CATALOG = {
    "programa": [{"canonical_value": "BECA 18", "aliases": ["BECA18", "BECA  18"], "normalized_key": "BECA 18", "match_method": "manual_alias", "confidence": "high", "review_required": False}],
    "pais": [{"canonical_value": "PERÚ", "aliases": ["PERU"], "normalized_key": "PERU", "match_method": "manual_alias", "confidence": "high", "review_required": False}],
    "sexo": [{"canonical_value": "Femenino", "aliases": ["F", "MUJER"], "normalized_key": "FEMENINO", "match_method": "manual_alias", "confidence": "medium", "review_required": True}],
    "carrera": [{"canonical_value": "CIVIL ENGINEERING", "aliases": ["1-URGENT"], "normalized_key": "CIVIL ENGINEERING", "match_method": "manual_alias", "confidence": "high", "review_required": True}],
}


def _open_data(dataset: str, raw: Callable[[SparkSession, str], DataFrame], sql: str) -> None:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _plain(silver.transform(raw(spark, sf_dir), silver.SPECS["pronabec", dataset], CONTEXT, canonical.load_catalog(spark, CATALOG)))

    _add(f"silver_{dataset}", query, sql.replace("$RUN", _RUN.format(dataset=dataset)))


def _none(*names: str) -> str:
    return ", ".join(f"NULL::VARCHAR AS {n}_canonical, NULL::VARCHAR AS {n}_canonical_match_method, NULL::BOOLEAN AS {n}_canonical_review_required" for n in names)


def _found(name: str, condition: str, value: str, review: str) -> str:
    return f"CASE WHEN {condition} THEN '{value}' END AS {name}_canonical, CASE WHEN {condition} THEN 'manual_alias' END AS {name}_canonical_match_method, CASE WHEN {condition} THEN {review} END AS {name}_canonical_review_required"


_t = F.col
_open_data(
    "convocatorias",
    lambda s, d: _table(s, d, "orders").select(_t("o_orderkey").cast("string").alias("source_row_id"), F.format_number("o_custkey", 0).alias("id_convocatoria"), F.date_format("o_orderdate", "yyyy-MM").alias("codigo_anual"), F.concat(F.lit("Beca\t"), "o_orderpriority", F.lit("\r\n")).alias("description_conv"), F.concat(F.lit(" "), F.lower("o_orderpriority")).alias("modalidad"), F.when(_t("o_orderkey") % 2 == 0, "beca18").otherwise("otra").alias("programa"), F.when(_t("o_orderkey") % 3 == 0, "n/a").otherwise("50").alias("vacantes")),
    f"SELECT o_orderkey AS source_row_id, o_custkey AS id_convocatoria, strftime(o_orderdate, '%Y-%m') AS codigo_anual, 'Beca ' || o_orderpriority AS descripcion_convocatoria, lower(o_orderpriority) AS modalidad, CASE WHEN o_orderkey % 2 = 0 THEN 'beca18' ELSE 'otra' END AS programa, CASE WHEN o_orderkey % 3 > 0 THEN 50 END AS vacantes, {_none('modalidad')}, {_found('programa', 'o_orderkey % 2 = 0', 'BECA 18', 'false')}, $RUN FROM orders",
)
_open_data(
    "ubigeo_postulacion",
    lambda s, d: _table(s, d, "supplier").select(_t("s_suppkey").cast("string").alias("source_row_id"), F.concat(F.lit("  "), "s_name").alias("region"), F.lit("   ").alias("provincia"), _t("s_nationkey").cast("string").alias("distrito"), F.lpad(_t("s_suppkey").cast("string"), 6, "0").alias("codigo_ubigeo")),
    f"SELECT s_suppkey AS source_row_id, s_name AS region, NULL::VARCHAR AS provincia, s_nationkey::VARCHAR AS distrito, lpad(s_suppkey::VARCHAR, 6, '0') AS codigo_ubigeo, {_none('region')}, $RUN FROM supplier",
)
_open_data(
    "becarios_pais_estudio",
    lambda s, d: _table(s, d, "customer").select(_t("c_custkey").cast("string").alias("source_row_id"), F.lit("2026").alias("convocatoria"), _t("c_mktsegment").alias("modalidad"), F.when(_t("c_nationkey") == 1, "PerÃº").otherwise(_t("c_nationkey").cast("string")).alias("pais_estudio"), F.concat("c_name", F.lit(" ")).alias("institucion"), F.when(_t("c_custkey") % 2 == 0, "f.").otherwise("M").alias("sexo")),
    f"SELECT c_custkey AS source_row_id, '2026' AS convocatoria, c_mktsegment AS modalidad, CASE WHEN c_nationkey = 1 THEN 'Perú' ELSE c_nationkey::VARCHAR END AS pais_estudio, c_name AS institucion, CASE WHEN c_custkey % 2 = 0 THEN 'f.' ELSE 'M' END AS sexo, {_none('modalidad')}, {_found('pais_estudio', 'c_nationkey = 1', 'PERÚ', 'false')}, {_found('sexo', 'c_custkey % 2 = 0', 'Femenino', 'true')}, $RUN FROM customer",
)
_open_data(
    "becarios_provincia",
    lambda s, d: _table(s, d, "customer").select(_t("c_custkey").cast("string").alias("source_row_id"), F.when(_t("c_custkey") % 7 == 0, " ").otherwise(_t("c_mktsegment")).alias("region"), F.when(_t("c_custkey") % 5 == 0, F.concat(F.lit("Total "), "c_mktsegment")).otherwise(_t("c_name")).alias("provincia"), F.when(_t("c_custkey") % 3 == 0, "").otherwise(F.format_number("c_custkey", 0)).alias("b18_n"), F.lit("21/09/2016 00:00:00").alias("fecha_carga")),
    "SELECT c_custkey AS source_row_id, c_mktsegment AS region, c_name AS provincia, CASE WHEN c_custkey % 3 > 0 THEN c_custkey END AS becarios_b18_count, DATE '2016-09-21' AS source_snapshot_date, $RUN FROM customer WHERE c_custkey % 7 > 0 AND c_custkey % 5 > 0",
)
_open_data(
    "colegios_habiles",
    lambda s, d: _table(s, d, "part").select(_t("p_partkey").cast("string").alias("source_row_id"), _t("p_brand").alias("ugel"), F.concat(F.lit(" "), "p_name").alias("institucion_educativa"), _t("p_type").alias("tipo_gestion"), F.lit("JEC").alias("nivel_modalidad"), F.lit("").alias("forma_atencion"), _t("p_size").cast("string").alias("distrito")),
    f"SELECT p_partkey AS source_row_id, p_brand AS ugel, p_name AS institucion_educativa, p_type AS tipo_gestion_colegio, 'JEC' AS nivel_modalidad, NULL::VARCHAR AS forma_atencion, p_size::VARCHAR AS distrito, {_none('ugel', 'tipo_gestion_colegio', 'nivel_modalidad', 'forma_atencion')}, $RUN FROM part",
)

# --- reports ------------------------------------------------------------------------------------------

_DOCUMENT = {"source_document_file": "beca18.pdf", "source_document_title": "Beca 18", "source_page": "7", "source_figure": "F1", "extraction_method": "manual", "source_publication_url": "u", "source_table": "T1"}
_DOCUMENT_SQL = "'beca18.pdf' AS source_document_file, 'Beca 18' AS source_document_title, 7::BIGINT AS source_page, 'F1' AS source_figure, 'manual' AS extraction_method"
_OF_TABLE_SQL = "'beca18.pdf' AS source_document_file, 'Beca 18' AS source_document_title, 'u' AS source_publication_url, 7::BIGINT AS source_page, 'T1' AS source_table, 'manual' AS extraction_method"


def _documented(df: DataFrame, raw: bool = True) -> DataFrame:
    return df.withColumns({k: F.lit(v) if raw or k != "source_page" else F.lit(7).cast("bigint") for k, v in _DOCUMENT.items()})


def silver_snapshot_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shares by modality and segment, with headers and cells as reports spell them; total rows go."""
    o = _table(spark, sf_dir, "orders").groupBy(F.year("o_orderdate").alias("y"), "o_orderpriority", "o_orderstatus").agg(F.count("*").alias("n"))
    raw = o.select(_t("y").cast("string").alias("﻿Ano de la Encuesta"), F.when(_t("o_orderstatus") == "P", "Total general").otherwise(F.concat(F.lit(" "), "o_orderstatus")).alias("Lengua_Materna"), F.concat(F.lower("o_orderpriority"), F.lit("  ")).alias("MODALIDAD"), F.when(_t("o_orderpriority") == "2-HIGH", "N.D.").otherwise(F.concat(_t("n").cast("string"), F.lit(",5%"))).alias("Porcentaje Becarios"))
    return _plain(silver.transform(_documented(raw), silver.SPECS["pronabec_reports", "report_beca18_lengua_materna_modalidad_2025"], CONTEXT))


_add(
    "silver_snapshot_report",
    silver_snapshot_report,
    f"SELECT year(o_orderdate) AS ano_encuesta, o_orderstatus AS lengua_materna, lower(o_orderpriority) AS modalidad, CASE WHEN o_orderpriority <> '2-HIGH' THEN count(*) + 0.5::DOUBLE END AS porcentaje_becarios, {_DOCUMENT_SQL}, {_RUN.format(dataset='report_beca18_lengua_materna_modalidad_2025')} FROM orders WHERE o_orderstatus <> 'P' GROUP BY year(o_orderdate), o_orderstatus, o_orderpriority",
)


def _report_fields(name: str) -> list[dict]:
    return [f for f in tables.SILVER[f"pronabec_report_beca18_{name}"] if f["name"] not in silver.TECHNICAL and f["name"] not in _DOCUMENT]


def _spelled(field: str, i: int) -> str:
    """A header as reports spell it: capitals, blanks, underscores, stop words, a BOM before the first."""
    return "\ufeff" * (i == 0) + (field.upper(), field.replace("_", " de ").title(), field.replace("_", " "))[i % 3]


def silver_all_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw rows of orders through the specs of all snapshot reports, as (report, field, text, number) with the rows counted; total rows go."""
    o = _table(spark, sf_dir, "orders").groupBy(F.year("o_orderdate").alias("y"), "o_orderpriority", "o_orderstatus").agg(F.count("*").alias("n"))
    out = None
    for name in tables.REPORTS:
        own, texts = _report_fields(name), iter((F.concat(F.lit(" "), F.lower("o_orderpriority"), F.lit("\t  x")), _t("o_orderstatus")))
        cells = []
        for i, f in enumerate(own):
            if i == 0:
                c = _t("y").cast("string")
            elif f["type"] == "STRING":
                c = next(texts)
            elif f["type"] == "INT64":
                c = F.when(_t("o_orderstatus") == "F", "-").otherwise(F.format_number(_t("n") * 1000, 0))
            else:
                c = F.when(_t("o_orderstatus") == "F", "N.D.").otherwise(F.concat(_t("n").cast("string"), F.lit(",5 %")))
            cells.append(F.when(_t("o_orderstatus") == "P", "Total General").otherwise(c).alias(_spelled(f["name"], i)))
        got = silver.transform(_documented(o.select(*cells)), silver.SPECS["pronabec_reports", f"report_beca18_{name}"], CONTEXT)
        text = lambda f: _t(f["name"]).cast("string") if f["type"] == "STRING" else F.lit(None).cast("string")
        number = lambda f: F.lit(None).cast("double") if f["type"] == "STRING" else _t(f["name"]).cast("double")
        rows = got.select(F.explode(F.array(*[F.struct(F.lit(name).alias("report"), F.lit(f["name"]).alias("field"), text(f).alias("text"), number(f).alias("number")) for f in own])).alias("c")).select("c.*")
        out = rows if out is None else out.unionByName(rows)
    return out.groupBy("report", "field", "text", "number").agg(F.count("*").alias("records"))


def _all_reports_sql() -> str:
    parts = []
    for name in tables.REPORTS:
        texts = iter(("lower(p) || ' x'", "s"))
        for i, f in enumerate(_report_fields(name)):
            if i == 0:
                text, number = ("y::VARCHAR", "NULL") if f["type"] == "STRING" else ("NULL", "y")
            elif f["type"] == "STRING":
                text, number = next(texts), "NULL"
            else:
                text, number = "NULL", f"CASE WHEN s <> 'F' THEN {'n * 1000' if f['type'] == 'INT64' else 'n + 0.5'} END"
            parts.append(f"SELECT '{name}' AS report, '{f['name']}' AS field, {text}::VARCHAR AS text, ({number})::DOUBLE AS number FROM r")
    return "WITH r AS (SELECT year(o_orderdate) AS y, o_orderpriority AS p, o_orderstatus AS s, count(*) AS n FROM orders WHERE o_orderstatus <> 'P' GROUP BY 1, 2, 3), a AS (" + " UNION ALL ".join(parts) + ") SELECT *, count(*) AS records FROM a GROUP BY ALL"


_add("silver_all_reports", silver_all_reports, _all_reports_sql())
_YEARS = list(range(1995, 2002))


def silver_wide_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders by priority with a column a year, read back as one row a year; the total row and column go."""
    count = [F.count_if(F.year("o_orderdate") == y) for y in _YEARS]
    cell = lambda c: F.when(c == 0, "-").otherwise(F.format_number(c, 0))
    wide = _table(spark, sf_dir, "orders").groupBy(F.coalesce("o_orderpriority", F.lit("x")).alias("Carrera de Estudio")).agg(*[cell(c).alias(f"{y} (*)" if y == _YEARS[-1] else str(y)) for y, c in zip(_YEARS, count, strict=True)], F.count("*").cast("string").alias("Total"))
    both = wide.union(wide.limit(1).withColumn("Carrera de Estudio", F.lit("TOTAL  General")))
    return _plain(silver.transform(_documented(both), silver.SPECS["pronabec_reports", "report_beca18_universitarios_carrera_anual"], CONTEXT, canonical.load_catalog(spark, CATALOG)))


_add(
    "silver_wide_report",
    silver_wide_report,
    f"""WITH y AS (SELECT unnest(range(1995, 2002)) AS y), p AS (SELECT DISTINCT o_orderpriority AS p FROM orders)
SELECT p AS carrera_estudio, {_found('carrera_estudio', "p = '1-URGENT'", 'CIVIL ENGINEERING', 'true')}, y AS ano_convocatoria, count(o_orderkey) AS cantidad_becarios, y = 2001 AS es_anio_preliminar, {_OF_TABLE_SQL}, {_RUN.format(dataset='report_beca18_universitarios_carrera_anual')}
FROM p CROSS JOIN y LEFT JOIN orders ON o_orderpriority = p AND year(o_orderdate) = y GROUP BY p, y""",
)

# --- regional sources, with quarantine ------------------------------------------------------------------


def _raw_population(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = _t("c_custkey")
    return _table(spark, sf_dir, "customer").select(
        F.when(k % 11 == 0, "x").otherwise((2012 + k % 14).cast("string")).alias("anio"),
        F.when(k % 13 == 0, F.lit("  ")).otherwise(_t("c_name")).alias("region"),
        F.format_number(k * 1000, 0).alias("poblacion_total"),
        F.when(k % 17 == 0, F.lit("abc")).when(k % 19 == 0, F.lit("-5")).otherwise((k * 100).cast("string")).alias("poblacion_15_24"),
        F.lit("").alias("poblacion_15_29"),
        F.when(k % 23 == 0, F.lit("120")).otherwise(F.lit("0.12")).alias("share_15_24_total"),
    )


_POPULATION_ERROR_SQL = """CASE WHEN c_custkey % 11 = 0 THEN 'anio es obligatorio y debe ser numérico.' WHEN c_custkey % 13 = 0 THEN 'region es obligatoria.' WHEN c_custkey % 17 = 0 THEN 'poblacion_15_24 debe ser entero.'
  WHEN c_custkey % 19 = 0 THEN 'poblacion_15_24 no puede ser negativo.' WHEN c_custkey % 23 = 0 THEN 'share_15_24_total debe estar entre 0 y 100.' END"""


def silver_population(spark: SparkSession, sf_dir: str) -> DataFrame:
    valid, _ = silver.process(_raw_population(spark, sf_dir), "inei_reports", "inei_population_youth_region", CONTEXT)
    return _plain(valid)


_add(
    "silver_population",
    silver_population,
    f"SELECT 2012 + c_custkey % 14 AS anio, c_name AS region, c_custkey * 1000 AS poblacion_total, c_custkey * 100 AS poblacion_15_24, NULL::BIGINT AS poblacion_15_29, NULL::BIGINT AS poblacion_17_24, NULL::BIGINT AS poblacion_18_24, 0.12::DOUBLE AS share_15_24_total, {_RUN.format(dataset='inei_population_youth_region')} FROM customer WHERE {_POPULATION_ERROR_SQL} IS NULL",
)


def silver_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rejects by stage, code and message, with the spread of what their raw records hold."""
    _, rejects = silver.process(_raw_population(spark, sf_dir), "inei_reports", "inei_population_youth_region", CONTEXT)
    total = F.replace(F.get_json_object("raw_record", "$.poblacion_total"), F.lit(","), F.lit("")).cast("bigint")
    return rejects.groupBy("processing_stage", "error_code", "error_message", "source_dataset").agg(F.count("*").alias("records"), F.sum(total).alias("raw_total"))


_add("silver_rejects", silver_rejects, f"SELECT 'transform' AS processing_stage, 'TRANSFORM_ERROR' AS error_code, {_POPULATION_ERROR_SQL} AS error_message, 'inei_population_youth_region' AS source_dataset, count(*) AS records, sum(c_custkey * 1000)::BIGINT AS raw_total FROM customer WHERE {_POPULATION_ERROR_SQL} IS NOT NULL GROUP BY 3")


def silver_run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = _raw_population(spark, sf_dir)
    valid, rejects = silver.process(raw, "inei_reports", "inei_population_youth_region", CONTEXT)
    return silver.summary(raw, valid, rejects)


_add("silver_run_summary", silver_run_summary, f"WITH e AS (SELECT {_POPULATION_ERROR_SQL} AS e FROM customer) SELECT count(*) AS records_read, count(*) - count(e) AS records_valid, count(e) AS records_rejected, round(count(e)::DOUBLE / count(*), 6) AS rejection_rate, 'COMPLETED_WITH_REJECTIONS' AS status, 0::BIGINT AS records_dropped FROM e")


def silver_demographics(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = _t("s_suppkey")
    raw = _table(spark, sf_dir, "supplier").select(F.lit("2020").alias("anio"), _t("s_name").alias("region"), F.lit("18,5").alias("tasa_bruta_natalidad"), F.when(k % 5 == 0, "0").otherwise("75.5").alias("esperanza_vida_nacer"), F.concat(F.lit("-"), (k % 9).cast("string"), F.lit(".25")).alias("tasa_migracion_neta"))
    return _plain(silver.process(raw, "inei_reports", "inei_demographic_indicators_region", CONTEXT)[0])


_add("silver_demographics", silver_demographics, f"SELECT 2020::BIGINT AS anio, s_name AS region, 18.5::DOUBLE AS tasa_bruta_natalidad, NULL::DOUBLE AS tasa_global_fecundidad, 75.5::DOUBLE AS esperanza_vida_nacer, NULL::DOUBLE AS tasa_mortalidad_infantil, -(s_suppkey % 9) - 0.25::DOUBLE AS tasa_migracion_neta, NULL::DOUBLE AS tasa_crecimiento_total_pct, {_RUN.format(dataset='inei_demographic_indicators_region')} FROM supplier WHERE s_suppkey % 5 > 0")


def silver_poverty(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = _t("s_suppkey")
    raw = _table(spark, sf_dir, "supplier").select((2012 + k % 14).cast("string").alias("anio"), F.concat("s_name", F.lit("  ")).alias("region"), F.when(k % 6 == 0, "101").otherwise(F.concat((k % 90).cast("string"), F.lit(".5"))).alias("pobreza_monetaria_pct"), F.lit(" INEI ").alias("source_name"))
    return _plain(silver.process(raw, "inei_reports", "inei_pobreza_departamental", CONTEXT)[0])


_add("silver_poverty", silver_poverty, f"SELECT 2012 + s_suppkey % 14 AS anio, s_name AS region, s_suppkey % 90 + 0.5::DOUBLE AS pobreza_monetaria_pct, 'INEI' AS source_name, NULL::VARCHAR AS source_period, NULL::VARCHAR AS source_type, NULL::VARCHAR AS metric, {_RUN.format(dataset='inei_pobreza_departamental')} FROM supplier WHERE s_suppkey % 6 > 0")


def silver_internet_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Access by year as columns; blank cells give no row and a row without any value is rejected."""
    k = _t("s_suppkey")
    raw = _table(spark, sf_dir, "supplier").select(_t("s_name").alias("region"), *[F.when((k + y) % 4 == 0, F.lit(" ")).when(k % 10 == 0, F.lit("")).otherwise(((k + y) % 100).cast("string")).alias(str(y)) for y in (2012, 2013, 2025)])
    return _plain(silver.process(silver.long_internet(raw), "inei_reports", "inei_internet_acceso_region", CONTEXT)[0])


_add("silver_internet_wide", silver_internet_wide, f"SELECT y::BIGINT AS anio, s_name AS region, ((s_suppkey + y) % 100)::DOUBLE AS internet_acceso_pct, 'INEI' AS source_name, '2012-2025' AS source_period, 'manual_csv' AS source_type, 'internet_acceso_pct' AS metric, {_RUN.format(dataset='inei_internet_acceso_region')} FROM supplier CROSS JOIN (VALUES (2012), (2013), (2025)) v(y) WHERE (s_suppkey + y) % 4 > 0 AND s_suppkey % 10 > 0")


def silver_enrollment(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = _t("c_custkey")
    grade = F.element_at(F.array(*map(F.lit, silver.GRADES)), (k % 5 + 1).cast("int"))
    total = k % 50
    raw = _table(spark, sf_dir, "customer").select(F.when(k % 12 == 0, "2030").otherwise("2025").alias("anio"), F.lpad((k % 25).cast("string"), 2, "0").alias("codigo_departamento"), F.concat(F.lit("Áncash "), "c_mktsegment").alias("region"), F.when(k % 7 == 0, "PRIMARIA").otherwise("SECUNDARIA").alias("nivel_educativo"), grade.alias("grado"), total.cast("string").alias("matricula_total"), *[F.floor(total / i).cast("string").alias(f"matricula_{p}") for i, p in enumerate(tables.ENROLLED, 1)])
    return _plain(silver.process(raw, "minedu_escale", "minedu_matricula_secundaria_departamental", CONTEXT)[0])


_add(
    "silver_enrollment",
    silver_enrollment,
    "WITH x AS (SELECT *, c_custkey % 50 AS t, ['PRIMER_GRADO', 'SEGUNDO_GRADO', 'TERCER_GRADO', 'CUARTO_GRADO', 'QUINTO_GRADO'] AS g FROM customer) SELECT 2025::BIGINT AS anio, lpad((c_custkey % 25)::VARCHAR, 2, '0') AS codigo_departamento, 'Áncash ' || c_mktsegment AS region, 'ANCASH ' || c_mktsegment AS region_normalizada, 'SECUNDARIA' AS nivel_educativo, g[c_custkey % 5 + 1] AS grado, c_custkey % 5 + 1 AS grado_orden, t AS matricula_total, "
    + ", ".join(f"t // {i} AS matricula_{p}, round((t // {i})::DOUBLE / nullif(t, 0), 9) AS {p}_pct" for i, p in enumerate(tables.ENROLLED, 1))
    + f", {_RUN.format(dataset='minedu_matricula_secundaria_departamental')} FROM x WHERE c_custkey % 12 > 0 AND c_custkey % 7 > 0",
)


def silver_raw_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _table(spark, sf_dir, "orders").select("o_orderkey", F.when(_t("o_orderkey") % 5 == 0, "none").otherwise(F.concat(F.lit("del "), F.year("o_orderdate").cast("string"))).alias("period"), "o_orderpriority")
    return silver.any_contains(silver.year_between(o, "period", 1996, 1998), "Urgent")


_add("silver_raw_filters", silver_raw_filters, "SELECT o_orderkey, 'del ' || year(o_orderdate) AS period, o_orderpriority FROM orders WHERE o_orderkey % 5 > 0 AND year(o_orderdate) BETWEEN 1996 AND 1998 AND lower(o_orderpriority) LIKE '%urgent%'")

# --- Gold views ---------------------------------------------------------------------------------------

def _report_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A cleaned report of orders: texts from priority and status, figures from counts, the year as its period."""
    fields = [f for f in tables.SILVER[f"pronabec_report_beca18_{name}"] if f["name"] not in silver.TECHNICAL and f["name"] not in _DOCUMENT]
    period = fields[0]["name"] if name != "becas_otorgadas_modalidad_anual" else "ano_convocatoria"
    o = _table(spark, sf_dir, "orders").groupBy(F.year("o_orderdate").alias("y"), "o_orderpriority", "o_orderstatus").agg(F.count("*").alias("n"), F.countDistinct("o_custkey").alias("d"))
    texts = iter((_t("o_orderpriority"), _t("o_orderstatus")))
    out = []
    for f in fields:
        if f["name"] == period:
            c = _t("y").cast("string" if f["type"] == "STRING" else "bigint")
        elif f["type"] == "STRING":
            c = next(texts)
        else:
            c = _t("n") if f["type"] == "INT64" else _t("d").cast("double")
        out.append(c.alias(f["name"]))
    return silver.technical(_documented(o.select(*out), raw=False), "pronabec_reports", f"report_beca18_{name}", CONTEXT)


def _gold_tables(spark: SparkSession, sf_dir: str, names: list[str]) -> views.Tables:
    return {f"pronabec_report_beca18_{n}": _report_table(spark, sf_dir, n) for n in names}


_REPORT_SQL = "r AS (SELECT year(o_orderdate) AS y, o_orderpriority AS p, o_orderstatus AS s, count(*) AS n, count(DISTINCT o_custkey)::DOUBLE AS d FROM orders GROUP BY 1, 2, 3)"
_SOURCE_SQL = "'report_beca18_{0}' AS source_dataset, 'beca18.pdf' AS source_document_file"


def _text_columns(name: str) -> dict[str, str]:
    """The SQL column behind each text of a report."""
    fields = [f for f in tables.SILVER[f"pronabec_report_beca18_{name}"] if f["type"] == "STRING" and f["name"] not in silver.TECHNICAL and f["name"] not in _DOCUMENT and f["name"] != "periodo"]
    return {f["name"]: c for f, c in zip(fields, ("p", "s"), strict=False)}


def _cell_sql(name: str, report: str) -> str:
    return name if name.startswith("'") else _text_columns(report)[name]


def gold_social_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.social_profile(_gold_tables(spark, sf_dir, [i[2] for i in views.INDICATORS]))


_add(
    "gold_social_profile",
    gold_social_profile,
    f"WITH {_REPORT_SQL} "
    + " UNION ALL ".join(
        f"SELECT '{group}' AS indicator_group, '{name}' AS indicator_name, {_cell_sql(cat, rep)} AS category, {_cell_sql(sub, rep)} AS subcategory, y::VARCHAR AS period, {'n' if count else 'NULL::BIGINT'} AS value_count, d AS value_percentage, {_SOURCE_SQL.format(rep)} FROM r"
        for group, name, rep, cat, sub, count, _ in views.INDICATORS
    ),
)


def gold_applications(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.regions_by_kind(_gold_tables(spark, sf_dir, [k[1] for k in views.APPLICATIONS]), views.APPLICATIONS, "porcentaje_becarios")


def gold_migration(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.regions_by_kind(_gold_tables(spark, sf_dir, [k[1] for k in views.MIGRATION]), views.MIGRATION, "tasa_migracion")


for _name, _query, _kinds, _value in (("gold_applications", gold_applications, views.APPLICATIONS, "porcentaje_becarios"), ("gold_migration", gold_migration, views.MIGRATION, "tasa_migracion")):
    _add(_name, _query, f"WITH {_REPORT_SQL} " + " UNION ALL ".join(f"SELECT '{k}' AS tipo_registro, {_cell_sql(m, rep)} AS region, y::VARCHAR AS periodo, d AS {_value}, {_SOURCE_SQL.format(rep)} FROM r" for k, rep, m, _ in _kinds))


def gold_choices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.choices(_gold_tables(spark, sf_dir, [c[1] for c in views.CHOICES]))


_add("gold_choices", gold_choices, f"WITH {_REPORT_SQL} " + " UNION ALL ".join(f"SELECT '{what}' AS dimension_analisis, p AS motivo, s AS segmento, d AS porcentaje_becarios, {_SOURCE_SQL.format(rep)} FROM r" for what, rep, *_ in views.CHOICES))


def gold_grants_annual(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.VIEWS["vw_beca18_becas_otorgadas_anual"](_gold_tables(spark, sf_dir, ["becas_otorgadas_modalidad_anual"]))


_add("gold_grants_annual", gold_grants_annual, f"WITH {_REPORT_SQL} SELECT p AS modalidad, y AS ano_convocatoria, n AS becas_otorgadas, 'beca18.pdf' AS source_document_file, 7::BIGINT AS source_page FROM r")


def gold_career_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.university_years({"pronabec_report_beca18_universitarios_carrera_anual": silver_wide_report(spark, sf_dir)}, "universitarios_carrera_anual")


_add(
    "gold_career_years",
    gold_career_years,
    f"""WITH y AS (SELECT unnest(range(1995, 2002)) AS y), p AS (SELECT DISTINCT o_orderpriority AS p FROM orders)
SELECT p AS carrera_estudio, CASE WHEN p = '1-URGENT' THEN 'CIVIL ENGINEERING' ELSE p END AS carrera_estudio_final, {_found('carrera_estudio', "p = '1-URGENT'", 'CIVIL ENGINEERING', 'true')}, y AS ano_convocatoria, count(o_orderkey) AS cantidad_becarios, y = 2001 AS es_anio_preliminar, 'u' AS source_publication_url, 'T1' AS source_table
FROM p CROSS JOIN y LEFT JOIN orders ON o_orderpriority = p AND year(o_orderdate) = y GROUP BY p, y""",
)


def gold_university_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = _table(spark, sf_dir, "customer").groupBy(F.concat(F.lit(" "), "c_mktsegment").alias("Universidad")).agg(F.count("*").cast("string").alias("anio_2025"), F.lit("-").alias("anio_2026_preliminar"))
    t = silver.transform(_documented(raw), silver.SPECS["pronabec_reports", "report_beca18_universitarios_universidad_anual"], CONTEXT, canonical.load_catalog(spark, CATALOG))
    return views.university_years({"pronabec_report_beca18_universitarios_universidad_anual": t}, "universitarios_universidad_anual")


_add(
    "gold_university_years",
    gold_university_years,
    f"SELECT c_mktsegment AS universidad, c_mktsegment AS universidad_final, {_none('universidad')}, y::BIGINT AS ano_convocatoria, CASE WHEN y = 2025 THEN count(*) ELSE 0 END AS cantidad_becarios, y = 2026 AS es_anio_preliminar, 'u' AS source_publication_url, 'T1' AS source_table FROM customer CROSS JOIN (VALUES (2025), (2026)) v(y) GROUP BY c_mktsegment, y",
)


def _budget_table(spark: SparkSession, sf_dir: str, end: str) -> views.Tables:
    """A cleaned budget table of whole amounts by year and dimensions, so that sums are exact."""
    li = _table(spark, sf_dir, "lineitem")
    whole = lambda c: F.sum(F.floor(c).cast("bigint")).cast("decimal(38,9)")
    dims = {"codigo_entidad": _t("l_suppkey").cast("string"), "nombre_entidad": _t("l_returnflag"), "codigo_producto": _t("l_returnflag"), "producto": _t("l_linestatus"), "codigo_actividad": _t("l_linenumber").cast("string"), "actividad": _t("l_returnflag"), "codigo_generica": _t("l_linestatus"), "generica": _t("l_returnflag")}
    own = [f["name"] for f in tables.fields(tables.BUDGET_DIMENSIONS[end])]
    g = li.groupBy(F.year("l_shipdate").cast("bigint").alias("ano"), *[dims[n].alias(n) for n in own]).agg(whole(_t("l_extendedprice")).alias("pia"), F.sum(F.when(_t("l_linenumber") > 1, F.floor("l_extendedprice").cast("bigint")).otherwise(0)).cast("decimal(38,9)").alias("pim"), whole(_t("l_extendedprice") / 2).alias("devengado"), F.count("*").cast("decimal(38,9)").alias("avance_porcentaje"))
    return {f"presupuesto_mef{end}": silver.technical(g, "mef", f"presupuesto{end}", CONTEXT)}


_BUDGET_DIMS_SQL = {"": "l_suppkey::VARCHAR AS codigo_entidad, l_returnflag AS nombre_entidad", "_producto": "l_returnflag AS codigo_producto, l_linestatus AS producto", "_actividad": "l_returnflag AS codigo_producto, l_linestatus AS producto, l_linenumber::VARCHAR AS codigo_actividad, l_returnflag AS actividad", "_generica": "l_linestatus AS codigo_generica, l_returnflag AS generica"}


def _budget_sql(end: str) -> str:
    return f"b AS (SELECT year(l_shipdate) AS ano, {_BUDGET_DIMS_SQL[end]}, sum(floor(l_extendedprice)) AS pia, sum(CASE WHEN l_linenumber > 1 THEN floor(l_extendedprice) ELSE 0 END) AS pim, sum(floor(l_extendedprice / 2)) AS devengado, count(*)::DOUBLE AS avance_porcentaje FROM lineitem GROUP BY ALL)"


def _execution_query(end: str) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: _rounded(_plain(views.budget_execution(_budget_table(spark, sf_dir, end), end)), "avance_calculado_pct")


def _rounded(df: DataFrame, *names: str, digits: int = 9) -> DataFrame:
    return df.withColumns({n: F.round(n, digits) for n in names})


for _end in _BUDGET_DIMS_SQL:
    _add(f"gold_execution{_end or '_entity'}", _execution_query(_end), f"WITH {_budget_sql(_end)} SELECT *, round(devengado / nullif(pim, 0) * 100, 9) AS avance_calculado_pct FROM b")


def gold_execution_temporal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain(views.VIEWS["vw_mef_presupuesto_ejecucion_temporal"]({"presupuesto_mef_temporal": silver.transform(_raw_budget(spark, sf_dir), silver.SPECS["mef", "presupuesto_temporal"], CONTEXT)}))


_add("gold_execution_temporal", gold_execution_temporal, f"SELECT year(l_shipdate) AS ano, {_PERIOD_SQL}, {_EXECUTED_SQL} FROM lineitem")


def _yearly(spark: SparkSession, sf_dir: str) -> views.Tables:
    return _gold_tables(spark, sf_dir, ["becas_otorgadas_modalidad_anual"]) | _budget_table(spark, sf_dir, "")


def gold_becas_vs_presupuesto(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(_plain(views.grants_against_budget(_yearly(spark, sf_dir))), "avance_presupuestal_pct", "devengado_por_beca", "pim_por_beca", digits=6)


def gold_analytic_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(_plain(views.analytic_summary(_yearly(spark, sf_dir))), "avance_presupuestal_pct", "costo_promedio_por_beca", digits=6)


_YEARLY_SQL = f"WITH {_budget_sql('')}, m AS (SELECT ano, sum(pia) AS pia, sum(pim) AS pim, sum(devengado) AS dev FROM b GROUP BY 1), g AS (SELECT year(o_orderdate) AS ano, count(*) AS becas FROM orders GROUP BY 1) SELECT ano, becas AS {{0}}, pia AS {{1}}, pim AS {{2}}, dev AS {{3}}, round(dev / nullif(pim, 0) * 100, 6) AS avance_presupuestal_pct, round(dev / nullif(becas, 0), 6) AS {{4}} {{5}} FROM g FULL JOIN m USING (ano)"
_add("gold_becas_vs_presupuesto", gold_becas_vs_presupuesto, _YEARLY_SQL.format("becas_otorgadas_total", "pia_total", "pim_total", "devengado_total", "devengado_por_beca", ", round(pim / nullif(becas, 0), 6) AS pim_por_beca"))
_add("gold_analytic_summary", gold_analytic_summary, _YEARLY_SQL.format("total_becas_otorgadas", "total_pia", "total_pim", "total_devengado", "costo_promedio_por_beca", ""))


def gold_resumen_ejecutivo(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _yearly(spark, sf_dir) | {"pronabec_convocatorias": silver_convocatorias(spark, sf_dir)}
    return _rounded(_plain(views.executive_summary(t, F.lit("2026-06-15").cast("date"))), "avance_presupuestal_pct", digits=6)


def silver_convocatorias(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _QUERIES["silver_convocatorias"](spark, sf_dir)


_add("gold_resumen_ejecutivo", gold_resumen_ejecutivo, f"WITH {_budget_sql('')} SELECT DATE '2026-06-15' AS fecha_consulta, sum(pia) AS pia_total, sum(pim) AS pim_total, sum(devengado) AS devengado_total, round(sum(devengado) / nullif(sum(pim), 0) * 100, 6) AS avance_presupuestal_pct, (SELECT count(*) FROM orders) AS total_becas_otorgadas, (SELECT count(DISTINCT o_orderpriority) FROM orders) AS modalidades_atendidas, (SELECT count(DISTINCT o_custkey) FROM orders) AS convocatorias_registradas, (SELECT 50 * count(*) FROM orders WHERE o_orderkey % 3 > 0) AS vacantes_registradas FROM b")


def gold_provinces(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = silver.transform(_table(spark, sf_dir, "nation").join(_table(spark, sf_dir, "customer").groupBy("c_nationkey").agg(F.count("*").alias("n")), F.col("n_nationkey") == F.col("c_nationkey")).select(_t("n_nationkey").cast("string").alias("source_row_id"), _t("n_regionkey").cast("string").alias("region"), _t("n_name").alias("provincia"), _t("n").cast("string").alias("b18_n"), F.lit("21/09/2016").alias("fecha_carga")), silver.SPECS["pronabec", "becarios_provincia"], CONTEXT)
    return _rounded(views.territorial_coverage({"pronabec_beca18_becarios_provincia_2016": t}).drop("extraction_date"), "participacion_provincia_region")


_add("gold_provinces", gold_provinces, "WITH n AS (SELECT n_regionkey::VARCHAR AS region, n_name AS provincia, count(*) AS c FROM nation JOIN customer ON c_nationkey = n_nationkey GROUP BY 1, 2) SELECT region, provincia, c AS becarios_b18_count, DATE '2016-09-21' AS source_snapshot_date, 'test-run' AS pipeline_run_id, rank() OVER (ORDER BY c DESC) AS ranking_nacional_provincia, (sum(c) OVER (PARTITION BY region))::BIGINT AS total_region_b18, round(c::DOUBLE / sum(c) OVER (PARTITION BY region), 9) AS participacion_provincia_region FROM n")


# --- analytic tables ------------------------------------------------------------------------------------


def _regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations as regions; every fifth merges into the nation before it."""
    n = _table(spark, sf_dir, "nation")
    home = n.select(_t("n_nationkey").alias("k"), _t("n_name").alias("region"))
    to = F.when(_t("n_nationkey") % 5 == 4, _t("n_nationkey") - 1).otherwise(_t("n_nationkey"))
    return n.withColumn("k", to).join(home, "k").select(region_key(_t("n_name")).alias("region_key"), "region")


def _sources(spark: SparkSession, sf_dir: str) -> views.Tables:
    """Cleaned regional sources of whole figures: customers as people, their balance as poverty, suppliers as access, orders as pupils."""
    n = _table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("k"), F.lower("n_name").alias("region"))
    c, s, o = (_table(spark, sf_dir, x) for x in ("customer", "supplier", "orders"))
    people = c.groupBy(_t("c_nationkey").alias("k")).agg(F.count("*").alias("all"), F.count_if(_t("c_acctbal") < 0).alias("poor"), F.count_if(_t("c_mktsegment") == "BUILDING").alias("young"))
    years = F.explode(F.array(*[F.lit(y).cast("bigint") for y in (2012, 2016, 2025)])).alias("anio")
    p = n.join(people, "k").select("*", years)
    sold = o.join(c, F.col("o_custkey") == F.col("c_custkey")).groupBy(_t("c_nationkey").alias("k")).agg(F.count("*").alias("n"), F.count_if(_t("o_orderstatus") == "O").alias("open"))
    pupils = n.join(sold, "k").select("*", F.explode(F.array(*[F.lit(y).cast("bigint") for y in (2012, 2025)])).alias("anio"), F.explode(F.array(F.lit("QUINTO_GRADO"), F.lit("CUARTO_GRADO"))).alias("grado"))
    net = n.join(s.groupBy(_t("s_nationkey").alias("k")).agg(F.count("*").alias("n")), "k").select("*", F.lit(2025).cast("bigint").alias("anio"))
    r = "pronabec_report_beca18_"
    return {
        "inei_pobreza_departamental": p.where("k % 7 > 0").select("anio", "region", (100 * _t("poor") / _t("all")).alias("pobreza_monetaria_pct"), F.lit("official").alias("source_type")),
        "inei_population_youth_region": p.where("anio > 2012").select("anio", "region", (_t("all") * 10).alias("poblacion_total"), (_t("young") * 10).alias("poblacion_15_24"), F.when(_t("k") % 3 > 0, _t("young") * 12).alias("poblacion_15_29")),
        "inei_internet_acceso_region": net.select("anio", "region", (_t("n") % 100).cast("double").alias("internet_acceso_pct"), F.lit("survey").alias("source_type")),
        "minedu_matricula_secundaria_departamental": pupils.select("anio", "region", F.upper("region").alias("region_normalizada"), "grado", _t("n").alias("matricula_total"), *[_t("open").alias(f"matricula_{x}") for x in ("publica", "privada", "urbana", "rural")]),
        r + "region_postulacion_anual": n.where("k % 2 = 0").select(F.lit(2025).cast("bigint").alias("ano_convocatoria"), F.upper("region").alias("grupo_region"), F.when(_t("k") % 4 == 0, _t("k") / 100.0).otherwise(_t("k") + 1.0).alias("porcentaje_becarios")),
        r + "becas_otorgadas_modalidad_anual": o.groupBy(F.lit(2025).cast("bigint").alias("ano_convocatoria")).agg(F.count("*").alias("becas_otorgadas")),
        r + "primera_generacion_region": n.where("k % 3 = 0").select("region", (_t("k") * 2 + 1).cast("double").alias("ratio_primera_generacion"), _t("k").cast("bigint").alias("total_becarios_primera_generacion"), (_t("k") * 3).cast("bigint").alias("total_becarios_encuestados")),
    }


def _analytic(spark: SparkSession, sf_dir: str, *wanted: str) -> views.Tables:
    """The analytic tables, all or those wanted, each stored once."""
    forecast = cost = None
    if not wanted or "region_allocation_scenarios" in wanted:
        grants = _table(spark, sf_dir, "orders").groupBy(F.year("o_orderdate").alias("ano")).agg(F.count("*").alias("becas"))
        spent = _table(spark, sf_dir, "lineitem").groupBy(F.year("l_shipdate").alias("ano")).agg(F.sum(F.floor("l_extendedprice").cast("bigint")).alias("devengado"))
        forecast, cost = _money(spark, sf_dir), predictive.latest_unit_cost(grants.join(spent, "ano"))
    out = predictive.build(spark, _sources(spark, sf_dir), _regions(spark, sf_dir), _stamp(), scratch.new_folder(spark, "analytic"), wanted, forecast, cost)
    if not wanted or "budget_forecast_results" in wanted:
        out["budget_forecast_results"] = predictive.budget_forecast(_monthly(spark, sf_dir))
    return {k: v for k, v in out.items() if not wanted or k in wanted}


def _money(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "lineitem").agg(F.count("*").cast("double").alias("forecast_value"))


def _monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "lineitem").groupBy(F.trunc(_t("l_shipdate").cast("date"), "month").alias("month")).agg(F.sum(F.floor("l_extendedprice").cast("bigint")).alias("value"))


_MAP_SQL = "d AS (SELECT lower(a.n_name) AS source, b.n_name AS region FROM nation a JOIN nation b ON b.n_nationkey = CASE WHEN a.n_nationkey % 5 = 4 THEN a.n_nationkey - 1 ELSE a.n_nationkey END)"
_FEATURES_SQL = f"""{_MAP_SQL},
k AS (SELECT n_nationkey AS k, d.region FROM nation JOIN d ON d.source = lower(n_name)),
c AS (SELECT c_nationkey AS k, count(*) AS a, count(*) FILTER (c_acctbal < 0) AS poor, count(*) FILTER (c_mktsegment = 'BUILDING') AS young FROM customer GROUP BY 1),
grid AS (SELECT y AS anio, region FROM (SELECT DISTINCT region FROM d) CROSS JOIN (SELECT unnest(range(2012, 2026)) AS y)),
po AS (SELECT y AS anio, region, avg(100 * poor / a::DOUBLE) AS poverty FROM c JOIN k USING (k) CROSS JOIN (VALUES (2012), (2016), (2025)) v(y) WHERE k % 7 > 0 GROUP BY 1, 2),
pe AS (SELECT y AS anio, region, sum(a * 10)::BIGINT AS total, sum(young * 10)::BIGINT AS p24, (sum(young * 12) FILTER (k % 3 > 0))::BIGINT AS p29 FROM c JOIN k USING (k) CROSS JOIN (VALUES (2016), (2025)) v(y) GROUP BY 1, 2),
ne AS (SELECT 2025 AS anio, region, avg(n % 100) AS access FROM (SELECT s_nationkey AS k, count(*) AS n FROM supplier GROUP BY 1) JOIN k USING (k) GROUP BY 2),
pu AS (SELECT y AS anio, region, sum(n)::BIGINT AS pupils, sum(open)::BIGINT AS rural FROM (SELECT c_nationkey AS k, count(*) AS n, count(*) FILTER (o_orderstatus = 'O') AS open FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1) JOIN k USING (k) CROSS JOIN (VALUES (2012), (2025)) v(y) GROUP BY 1, 2),
f AS (SELECT *, coalesce(p29, p24) AS youth, 100.0::DOUBLE * rural / nullif(pupils, 0) AS rurality, 100 - access AS gap, ((poverty IS NOT NULL)::INT + (coalesce(p29, p24) IS NOT NULL)::INT + (pupils IS NOT NULL)::INT + (access IS NOT NULL)::INT + (total IS NOT NULL)::INT) / 5.0::DOUBLE AS complete,
  (poverty IS NOT NULL)::INT + (total IS NOT NULL)::INT + (access IS NOT NULL)::INT + (pupils IS NOT NULL)::INT AS groups
  FROM grid LEFT JOIN po USING (anio, region) LEFT JOIN pe USING (anio, region) LEFT JOIN ne USING (anio, region) LEFT JOIN pu USING (anio, region))"""


def region_context_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = _analytic(spark, sf_dir, "region_context_features")["region_context_features"]
    return _rounded(x.select("anio", "region", "pobreza_monetaria_pct", "poblacion_total", "poblacion_15_24", "poblacion_15_29", "poblacion_joven_pct", "matricula_5to_secundaria", "ruralidad_educativa_pct", "internet_acceso_pct", "brecha_digital_pct", "feature_completeness_score", "feature_quality_flag", "source_priority"), "pobreza_monetaria_pct", "poblacion_joven_pct", "ruralidad_educativa_pct", "internet_acceso_pct", "brecha_digital_pct", "feature_completeness_score", digits=8)


_add("region_context_features", region_context_features, f"WITH {_FEATURES_SQL} SELECT anio::BIGINT AS anio, region, round(poverty, 8) AS pobreza_monetaria_pct, total AS poblacion_total, p24 AS poblacion_15_24, p29 AS poblacion_15_29, round(100.0::DOUBLE * youth / nullif(total, 0), 8) AS poblacion_joven_pct, pupils AS matricula_5to_secundaria, round(rurality, 8) AS ruralidad_educativa_pct, round(access, 8) AS internet_acceso_pct, round(gap, 8) AS brecha_digital_pct, round(complete, 8) AS feature_completeness_score, CASE WHEN complete >= 0.9 THEN 'complete' WHEN complete >= 0.7 THEN 'usable' WHEN complete >= 0.4 THEN 'partial' ELSE 'insufficient' END AS feature_quality_flag, CASE WHEN groups > 1 THEN 'mixed' ELSE 'official' END AS source_priority FROM f")

_MM = lambda c: f"CASE WHEN {c} IS NOT NULL THEN coalesce(({c} - min({c}) OVER (PARTITION BY anio))::DOUBLE / nullif((max({c}) OVER (PARTITION BY anio) - min({c}) OVER (PARTITION BY anio))::DOUBLE, 0), 0) END"


def _mean_sql(parts: dict[str, float]) -> str:
    total = " + ".join(f"{w}::DOUBLE * coalesce({c}, 0)" for c, w in parts.items())
    present = " + ".join(f"CASE WHEN {c} IS NOT NULL THEN {w}::DOUBLE ELSE 0 END" for c, w in parts.items())
    return f"round(({total}) / nullif({present}, 0), 12)"


_TIER_SQL = lambda s: f"CASE WHEN {s} IS NULL THEN 'Insuficiente' WHEN {s} >= 0.8 THEN 'Muy alta' WHEN {s} >= 0.6 THEN 'Alta' WHEN {s} >= 0.4 THEN 'Media' ELSE 'Baja' END"
_RANK_SQL = lambda s: f"rank() OVER (PARTITION BY anio ORDER BY {s} DESC NULLS LAST)"
_SCORES_SQL = f"""{_FEATURES_SQL}, m AS (SELECT *, {_MM('poverty')} AS sp, {_MM('pupils')} AS sd, {_MM('youth')} AS sy, {_MM('gap')} AS sg, {_MM('rurality')} AS sr FROM f),
v1 AS (SELECT *, {_mean_sql({'sp': .35, 'sd': .25, 'sy': .15, 'sg': .15, 'sr': .10})} AS score FROM m)"""
_PCT = lambda c: f"round({c}, 8)"


def gold_priority_v1(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = views.VIEWS["vw_predictive_region_priority_scores"](_analytic(spark, sf_dir, "region_priority_scores"))
    return _rounded(x.select("anio", "region", "priority_rank", "priority_tier", "priority_score", "priority_score_pct", "priority_label", "pobreza_score", "demanda_educativa_score", "poblacion_joven_score", "brecha_digital_score", "ruralidad_score"), "priority_score", "priority_score_pct", "pobreza_score", "demanda_educativa_score", "poblacion_joven_score", "brecha_digital_score", "ruralidad_score", digits=8)


_add("gold_priority_v1", gold_priority_v1, f"WITH {_SCORES_SQL}, q AS (SELECT *, {_RANK_SQL('score')} AS r FROM v1) SELECT anio::BIGINT AS anio, region, r AS priority_rank, {_TIER_SQL('score')} AS priority_tier, round(score, 8) AS priority_score, round(score * 100, 8) AS priority_score_pct, r || '. ' || region AS priority_label, {_PCT('sp')} AS pobreza_score, {_PCT('sd')} AS demanda_educativa_score, {_PCT('sy')} AS poblacion_joven_score, {_PCT('sg')} AS brecha_digital_score, {_PCT('sr')} AS ruralidad_score FROM q")

_COVER_SQL = f"""{_SCORES_SQL},
sh AS (SELECT region, avg(CASE WHEN k % 4 = 0 THEN k / 100.0::DOUBLE ELSE k + 1.0::DOUBLE END) AS s FROM k WHERE k % 2 = 0 GROUP BY 1),
fg AS (SELECT region, avg(k * 2 + 1) AS r0, sum(k)::BIGINT AS fa, sum(k * 3)::BIGINT AS fb FROM k WHERE k % 3 = 0 GROUP BY 1),
v AS (SELECT v1.*, {_RANK_SQL('score')} AS r1, CASE WHEN anio = 2025 THEN CASE WHEN s BETWEEN 0 AND 1 THEN s * 100 ELSE s END END AS share, CASE WHEN anio = 2025 THEN (SELECT count(*) FROM orders) END AS becas, CASE WHEN r0 > 1 THEN r0 / 100 ELSE r0 END AS first, fa, fb FROM v1 LEFT JOIN sh USING (region) LEFT JOIN fg USING (region)),
w AS (SELECT *, CAST(round(becas * share / 100) AS BIGINT) AS g FROM v), u AS (SELECT *, g::DOUBLE / nullif(youth, 0) * 1000 AS per_youth, g::DOUBLE / nullif(pupils, 0) * 1000 AS per_pupil FROM w),
cov AS (SELECT *, 1 - coalesce({_MM('per_pupil')}, CASE WHEN per_pupil IS NOT NULL THEN 0 END) AS gap_score, {_MM('first')} AS first_score FROM u)"""


def region_coverage_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = _analytic(spark, sf_dir, "region_coverage_features")["region_coverage_features"]
    return _rounded(x.select("anio", "region", "regional_becarios_pct", "regional_becarios_estimated", "total_becas_anual", "primera_generacion_ratio", "total_becarios_primera_generacion", "total_becarios_encuestados", "becas_por_1000_jovenes", "becas_por_1000_matriculados_5to", "demanda_no_cubierta_estimada", "coverage_gap_score", "primera_generacion_score", "coverage_data_quality_flag", "coverage_source_method", "has_estimated_coverage"), "regional_becarios_pct", "primera_generacion_ratio", "becas_por_1000_jovenes", "becas_por_1000_matriculados_5to", "coverage_gap_score", "primera_generacion_score", digits=8)


_add("region_coverage_features", region_coverage_features, f"""WITH {_COVER_SQL} SELECT anio::BIGINT AS anio, region, round(share, 8) AS regional_becarios_pct, g AS regional_becarios_estimated, becas AS total_becas_anual, round(first, 8) AS primera_generacion_ratio, fa AS total_becarios_primera_generacion, fb AS total_becarios_encuestados, round(per_youth, 8) AS becas_por_1000_jovenes, round(per_pupil, 8) AS becas_por_1000_matriculados_5to,
CASE WHEN g IS NOT NULL AND pupils IS NOT NULL THEN greatest(pupils - g, 0) END AS demanda_no_cubierta_estimada, round(gap_score, 8) AS coverage_gap_score, round(first_score, 8) AS primera_generacion_score, CASE WHEN g IS NOT NULL AND per_pupil IS NOT NULL AND first IS NOT NULL THEN 'complete' WHEN g IS NOT NULL AND per_pupil IS NOT NULL THEN 'usable' WHEN g IS NOT NULL OR first IS NOT NULL THEN 'partial' ELSE 'insufficient' END AS coverage_data_quality_flag,
CASE WHEN g IS NOT NULL AND first IS NOT NULL THEN 'mixed' WHEN g IS NOT NULL THEN 'estimated_from_regional_share' WHEN first IS NOT NULL THEN 'first_generation_snapshot_only' ELSE 'unavailable' END AS coverage_source_method, CASE WHEN g IS NOT NULL THEN true WHEN first IS NOT NULL THEN false END AS has_estimated_coverage FROM cov""")
_V2_SQL = f"{_COVER_SQL}, v2 AS (SELECT *, {_mean_sql({'score': .60, 'gap_score': .30, 'first_score': .10})} AS score2 FROM cov), z AS (SELECT *, {_RANK_SQL('score2')} AS r2 FROM v2)"


def gold_priority_v2(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = views.VIEWS["vw_predictive_region_priority_scores_v2"](_analytic(spark, sf_dir, "region_priority_scores_v2"))
    return _rounded(x.select("anio", "region", "priority_rank_v2", "priority_tier_v2", "priority_score_v2", "priority_score_v2_pct", "priority_label_v2", _t("total_becas_anual").cast("double").alias("total_becas_anual"), "coverage_source_method"), "priority_score_v2", "priority_score_v2_pct", digits=8)


_add("gold_priority_v2", gold_priority_v2, f"WITH {_V2_SQL} SELECT anio::BIGINT AS anio, region, r2 AS priority_rank_v2, {_TIER_SQL('score2')} AS priority_tier_v2, round(score2, 8) AS priority_score_v2, round(score2 * 100, 8) AS priority_score_v2_pct, r2 || '. ' || region AS priority_label_v2, NULL::DOUBLE AS total_becas_anual, CASE WHEN g IS NOT NULL AND first IS NOT NULL THEN 'mixed' WHEN g IS NOT NULL THEN 'estimated_from_regional_share' WHEN first IS NOT NULL THEN 'first_generation_snapshot_only' ELSE 'unavailable' END AS coverage_source_method FROM z")


def gold_allocation(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = views.VIEWS["vw_predictive_region_allocation_scenarios"](_analytic(spark, sf_dir, "region_allocation_scenarios"))
    return _rounded(x.select("anio", "region", "scenario_id", "scenario_type", "scenario_raw_score", "allocation_weight", "scenario_rank", "baseline_rank_v2", "rank_change_vs_v2", "scenario_budget_amount", "estimated_budget_amount", "estimated_scholarships"), "scenario_raw_score", "allocation_weight", "scenario_budget_amount", "estimated_budget_amount", "estimated_scholarships", digits=6)


_SCENARIOS_SQL = ", ".join("('{}', '{}', '{}', {})".format(s[0], predictive.SCENARIO_TEXTS[s[0]][1], s[1], ", ".join(f"{x}::DOUBLE" for x in s[2:])) for s in predictive.SCENARIOS)
_add("gold_allocation", gold_allocation, f"""WITH {_V2_SQL}, sc(id, type, method, bf, gf, wp, wd, wn, wc, wf) AS (VALUES {_SCENARIOS_SQL}),
a AS (SELECT anio, region, r2, id, type, bf, gf, round(CASE WHEN method = 'priority_score_v2' THEN coalesce(score2, 0) ELSE wp * coalesce(sp, 0) + wd * coalesce(sd, 0) + wn * coalesce(sy, 0) + wc * coalesce(gap_score, 0) + wf * coalesce(first_score, 0) END, 12) AS raw FROM z CROSS JOIN sc),
y AS (SELECT devengado / becas::DOUBLE AS cost FROM (SELECT year(o_orderdate) AS ano, count(*) AS becas FROM orders GROUP BY 1) JOIN (SELECT year(l_shipdate) AS ano, sum(floor(l_extendedprice)) AS devengado FROM lineitem GROUP BY 1) USING (ano) ORDER BY ano DESC LIMIT 1),
b AS (SELECT *, raw / nullif(sum(raw) OVER (PARTITION BY anio, id), 0) AS weight, rank() OVER (PARTITION BY anio, id ORDER BY raw DESC, region) AS r, (SELECT count(*) FROM lineitem)::DOUBLE * bf AS amount FROM a)
SELECT anio::BIGINT AS anio, region, id AS scenario_id, type AS scenario_type, round(raw, 6) AS scenario_raw_score, round(weight, 6) AS allocation_weight, r AS scenario_rank, r2 AS baseline_rank_v2, r2 - r AS rank_change_vs_v2, round(amount, 6) AS scenario_budget_amount, round(amount * weight, 6) AS estimated_budget_amount, round(amount * weight / (SELECT cost FROM y) * gf, 6) AS estimated_scholarships FROM b""")


def _assigned(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _analytic(spark, sf_dir, "region_coverage_features", "region_priority_scores_v2")
    return predictive.cluster_assignments(t["region_coverage_features"], t["region_priority_scores_v2"])


def gold_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.VIEWS["vw_predictive_region_clusters"]({"region_cluster_assignments": _assigned(spark, sf_dir)})


def gold_cluster_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.VIEWS["vw_predictive_region_cluster_profiles"]({"region_cluster_profiles": predictive.cluster_profiles(_assigned(spark, sf_dir), _stamp())})


# k-means isn't SQL; a test holds assignments, distances and profiles against numpy
_QUERIES |= {"gold_clusters": gold_clusters, "gold_cluster_profiles": gold_cluster_profiles}


def gold_forecast(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = views.VIEWS["vw_predictive_budget_forecast"]({"budget_forecast_results": predictive.budget_forecast(_monthly(spark, sf_dir))})
    names = {"forecast_value": "value", "prediction_interval_lower_bound": "low", "prediction_interval_upper_bound": "high"}
    return x.select(F.date_format("forecast_timestamp", "yyyy-MM-dd").alias("month"), *[F.round(_t(c) / 1e4, 0).alias(n) for c, n in names.items()], "confidence_level", "forecast_horizon_months")


_add("gold_forecast", gold_forecast, """WITH m AS (SELECT year(l_shipdate) * 12 + month(l_shipdate) - 1 AS t, sum(floor(l_extendedprice)) AS v FROM lineitem GROUP BY 1), f AS (SELECT regr_slope(v, t) AS a, regr_intercept(v, t) AS b, max(t) AS last FROM m),
o AS (SELECT t, v - b - a * t AS o FROM m, f), s AS (SELECT t % 12 AS m, avg(o) AS e FROM o GROUP BY 1), g AS (SELECT coalesce(stddev_samp(o - e), 0) AS sd FROM o JOIN s ON t % 12 = m), n AS (SELECT a, b, unnest(range(last + 1, last + 13)) AS t FROM f)
SELECT strftime(make_date((n.t // 12)::BIGINT, (n.t % 12 + 1)::BIGINT, 1), '%Y-%m-%d') AS month, round((b + a * n.t + coalesce(e, 0)) / 1e4) AS value, round((b + a * n.t + coalesce(e, 0) - 1.2815515655446004 * sd) / 1e4) AS low, round((b + a * n.t + coalesce(e, 0) + 1.2815515655446004 * sd) / 1e4) AS high, 0.8::DOUBLE AS confidence_level, 12::BIGINT AS forecast_horizon_months FROM n LEFT JOIN s ON n.t % 12 = s.m, g""")


def series_forecast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A forecast for each of ten series, by the last digit of the supplier, in the same jobs; the number of series is the key's."""
    m = _table(spark, sf_dir, "lineitem").groupBy((_t("l_suppkey") % 10).alias("series"), F.trunc(_t("l_shipdate").cast("date"), "month").alias("month")).agg(F.count("*").alias("value"))
    x = predictive.budget_forecast(m, 3)
    return x.select("series", F.date_format("forecast_timestamp", "yyyy-MM-dd").alias("month"), F.round("forecast_value", 4).alias("value"))


_add("series_forecast", series_forecast, """WITH m AS (SELECT l_suppkey % 10 AS s, year(l_shipdate) * 12 + month(l_shipdate) - 1 AS t, count(*)::DOUBLE AS v FROM lineitem GROUP BY 1, 2), f AS (SELECT s, regr_slope(v, t) AS a, regr_intercept(v, t) AS b, max(t) AS last FROM m GROUP BY 1),
e AS (SELECT s, t % 12 AS m, avg(v - b - a * t) AS e FROM m JOIN f USING (s) GROUP BY 1, 2), n AS (SELECT s, a, b, unnest(range(last + 1, last + 4)) AS t FROM f)
SELECT n.s AS series, strftime(make_date((n.t // 12)::BIGINT, (n.t % 12 + 1)::BIGINT, 1), '%Y-%m-%d') AS month, round(b + a * n.t + coalesce(e, 0), 4) AS value FROM n LEFT JOIN e ON n.s = e.s AND n.t % 12 = e.m""")

# --- rules --------------------------------------------------------------------------------------------


def quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rules of fourteen tables, in which rows of every kind of rule are broken."""
    raw, k = _raw_budget(spark, sf_dir), _t("s_suppkey")
    spec = lambda name: silver.transform(raw, silver.SPECS["mef", name], CONTEXT)
    process = lambda df, name: silver.process(df, "inei_reports", name, CONTEXT)[0]
    t = {"presupuesto_mef": spec("presupuesto").withColumn("pia", F.when(_t("codigo_entidad") == "1", -_t("pia")).otherwise(_t("pia"))), "presupuesto_mef_temporal": spec("presupuesto_temporal").withColumn("mes_numero", F.when(_t("mes_numero") < 12, _t("mes_numero"))), "presupuesto_mef_producto": spec("presupuesto_producto").limit(0)}
    t["inei_population_youth_region"] = process(_raw_population(spark, sf_dir), "inei_population_youth_region")
    s = _table(spark, sf_dir, "supplier").select(F.lit("2020").alias("anio"), _t("s_name").alias("region"), k.alias("k"), F.lit("40").alias("pobreza_monetaria_pct"), F.lit("75").alias("esperanza_vida_nacer"))
    t["inei_pobreza_departamental"] = process(s.union(s.where("k % 5 = 0")).drop("k"), "inei_pobreza_departamental")
    t["inei_demographic_indicators_region"] = process(s, "inei_demographic_indicators_region").withColumn("esperanza_vida_nacer", F.when(F.right("region", F.lit(1)) == "4", 0).otherwise(_t("esperanza_vida_nacer")))
    t["pronabec_ubigeo_postulacion"] = _QUERIES["silver_ubigeo_postulacion"](spark, sf_dir)
    sexes = "pronabec_report_beca18_sexo_anual"
    t[sexes] = _report_table(spark, sf_dir, "sexo_anual").withColumn("pipeline_run_id", F.when(_t("ano_convocatoria") != 1996, _t("pipeline_run_id")))
    t |= _analytic(spark, sf_dir, "region_context_features", "region_priority_scores", "region_allocation_scenarios", "budget_scenarios", "region_priority_scores_v2")
    c = t["region_context_features"]
    c = c.withColumns({"anio": F.when(_t("region") == "NATION_1", _t("anio") + 20).otherwise(_t("anio")), "region": F.when(_t("region") == "NATION_2", "LIMA PROVINCIAS").otherwise(_t("region")), "feature_quality_flag": F.when(_t("anio") == 2014, "odd").otherwise(_t("feature_quality_flag"))})
    t["region_context_features"] = c.withColumn("has_synthetic_values", (_t("anio") == 2015) & (_t("region") != "NATION_1"))
    t["region_priority_scores"] = t["region_priority_scores"].withColumn("priority_tier", F.when(_t("anio") == 2013, "odd").otherwise(_t("priority_tier")))
    v2 = t["region_priority_scores_v2"]
    t["region_priority_scores_v2"] = v2.withColumns({"score_version": F.when(_t("anio") == 2016, "odd").otherwise(_t("score_version")), "priority_rank_v2": F.when(_t("anio") != 2012, _t("priority_rank_v2"))})
    a = t["region_allocation_scenarios"]
    t["region_allocation_scenarios"] = a.withColumn("allocation_weight", F.when((_t("anio") == 2012) & (_t("scenario_id") == "poverty_focus"), 2.0 * _t("allocation_weight")).otherwise(_t("allocation_weight")))
    t["budget_scenarios"] = t["budget_scenarios"].where("scenario_id <> 'base_priority'").withColumn("budget_multiplier", F.when(_t("scenario_id") != "budget_plus_10", _t("budget_multiplier")))
    return run_rules(spark, t, [r for r in all_rules() if r.table in t]).select("check_id", "layer", "severity", "failed_rows", "passed")


_RULED = {"presupuesto_mef", "presupuesto_mef_temporal", "presupuesto_mef_producto", "inei_population_youth_region", "inei_pobreza_departamental", "inei_demographic_indicators_region", "pronabec_ubigeo_postulacion", "pronabec_report_beca18_sexo_anual", "region_context_features", "region_priority_scores", "region_allocation_scenarios", "budget_scenarios", "region_priority_scores_v2"}


def _rules_sql() -> str:
    critical = "(SELECT count(*) FROM (VALUES ('LIMA'), ('CALLAO'), ('CUSCO'), ('PUNO'), ('LORETO'), ('CAJAMARCA'), ('AYACUCHO')) v(x) WHERE x NOT IN (SELECT n_name FROM nation))"
    grid = "(SELECT count(*) FROM v2 WHERE {})".format
    w = "(SELECT sc.id, anio, raw / nullif(sum(raw) OVER (PARTITION BY anio), 0) AS weight FROM (SELECT anio, round(wp * coalesce(sp, 0) + wd * coalesce(sd, 0) + wn * coalesce(sy, 0) + wc * coalesce(gap_score, 0) + wf * coalesce(first_score, 0), 12) AS raw FROM v2, sc WHERE sc.id = 'poverty_focus' AND anio = 2012), sc WHERE sc.id = 'poverty_focus')"
    known = {
        "silver_presupuesto_mef_negative_values": "(SELECT count(*) FROM lineitem WHERE l_suppkey = 1)",
        "silver_presupuesto_mef_ano_range": "(SELECT count(*) FROM lineitem WHERE year(l_shipdate) NOT BETWEEN 2000 AND 2050)",
        "silver_presupuesto_mef_temporal_period_consistency": "(SELECT count(*) FROM lineitem WHERE month(l_shipdate) = 12)",
        "silver_presupuesto_mef_producto_not_empty": "1",
        "silver_inei_pobreza_departamental_duplicates": "(SELECT count(*) FROM supplier WHERE s_suppkey % 5 = 0)",
        "silver_inei_demographic_indicators_region_required_ranges": "(SELECT count(*) FROM supplier WHERE right(s_name, 1) = '4')",
        "silver_pronabec_ubigeo_postulacion_fields_nulls": "(SELECT count(*) FROM supplier)",
        "silver_pronabec_report_beca18_sexo_anual_valid": "(SELECT count(DISTINCT (o_orderpriority, o_orderstatus)) FROM orders WHERE year(o_orderdate) = 1996)",
        "ml_region_context_features_critical_regions_present": critical,
        "ml_region_context_features_year_range": grid("region = 'NATION_1' AND anio > 2005"),
        "ml_region_context_features_feature_quality_flag_allowed_values": grid("anio = 2014"),
        "ml_region_context_features_no_legacy_region_variants": grid("region = 'NATION_2'"),
        "ml_region_context_features_synthetic_metadata_consistency": grid("anio = 2015 AND region <> 'NATION_1'"),
        "ml_region_priority_scores_critical_regions_present": critical,
        "ml_region_priority_scores_tier_allowed_values": grid("anio = 2013"),
        "ml_region_priority_scores_v2_version_constant": grid("anio = 2016"),
        "ml_region_priority_scores_v2_rank_positive": grid("anio = 2012 AND score2 IS NOT NULL"),
        "ml_region_allocation_scenarios_weight_sum_by_year_scenario": f"(SELECT count(*) FROM (SELECT sum(weight) AS s FROM {w} x) WHERE s > 0)",
        "ml_region_allocation_scenarios_allocation_weight_range": f"(SELECT count(*) FROM {w} x WHERE 2 * weight > 1)",
        "ml_budget_scenarios_base_priority_present": "1",
        "ml_budget_scenarios_budget_multiplier_positive": "1",
    }
    rows = ", ".join(f"('{r.check_id}', '{r.layer}', '{r.severity}', ({known.get(r.check_id, '0')})::BIGINT)" for r in all_rules() if r.table in _RULED)
    return f"WITH {_V2_SQL}, sc(id, type, method, bf, gf, wp, wd, wn, wc, wf) AS (VALUES {_SCENARIOS_SQL}) SELECT *, failed_rows = 0 AS passed FROM (VALUES {rows}) v(check_id, layer, severity, failed_rows)"


_add("quality_rules", quality_rules, _rules_sql())


def contract_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many rows of a cleaned table each of its contract's columns leaves null; required ones none."""
    t = silver.transform(_raw_budget(spark, sf_dir).withColumnRenamed("producto_proyecto", "producto"), silver.SPECS["mef", "presupuesto_actividad"], CONTEXT)
    t = contracts.project(t, tables.SILVER["presupuesto_mef_actividad"])
    names = [f["name"] for f in tables.SILVER["presupuesto_mef_actividad"]]
    one = t.agg(*[F.count_if(F.col(n).isNull()).alias(n) for n in names])
    return one.select(F.explode(F.array(*[F.struct(F.lit(n).alias("name"), F.col(n).alias("nulls")) for n in names])).alias("x")).select("x.*")


_add("contract_catalog", contract_catalog, "SELECT name, CASE name WHEN 'actividad' THEN (SELECT count(*) FROM lineitem WHERE l_linenumber = 2) WHEN 'pim' THEN (SELECT count(*) FROM lineitem WHERE l_linenumber = 1) ELSE 0 END AS nulls FROM (VALUES " + ", ".join(f"('{f['name']}')" for f in tables.SILVER["presupuesto_mef_actividad"]) + ") v(name)")
