"""Specs, views, rules, contracts and sinks on small rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillon import table_queries
from quillon.functions import headers, numbers, text
from quillon.operators import canonical, quality, quarantine
from quillon.plans import predictive, rules, silver, views
from quillon.sources import contracts, landing, readers, sinks, tables

CONTEXT = silver.Context("2026-06-15", "test-run", "2026-06-16 00:00:00")


def _row(spark, system, dataset, catalog=None, **cells):
    df = spark.createDataFrame([tuple(cells.values())], ", ".join(f"`{c}` string" for c in cells))
    return [r.asDict() for r in silver.transform(df, silver.SPECS[system, dataset], CONTEXT, catalog).collect()]


def _eval(spark, f, value):
    return spark.createDataFrame([(value,)], "x string").select(f(F.col("x")).alias("y")).first()["y"]


@pytest.mark.parametrize("f, value, want", [
    (text.clean_basic, "  Beca   18  ", "Beca 18"), (text.clean_basic, "Universidad\tNacional", "Universidad Nacional"), (text.clean_basic, "   ", None),
    (numbers.int_safe, "10", 10), (numbers.int_safe, "not_a_number", None), (numbers.int_safe, "", None),
    (numbers.numeric_safe, "1,234.56", 1234.56), (numbers.numeric_safe, "1.234,56", 1234.56), (numbers.numeric_safe, "16,43", 16.43), (numbers.numeric_safe, "-1,234.56", -1234.56), (numbers.numeric_safe, "+16,43", 16.43),
    (numbers.numeric_safe, "  $ 1,234.56 ", 1234.56), (numbers.numeric_safe, " 50 % ", 50.0), (numbers.numeric_safe, "1.234", None), (numbers.numeric_safe, "12,345", None), (numbers.numeric_safe, "1.234.567", 1234567.0), (numbers.numeric_safe, "1,234,567", 1234567.0), (numbers.numeric_safe, "1,23,4", None),
    (numbers.bool_safe, "si", True), (numbers.bool_safe, "0", False), (numbers.bool_safe, "maybe", None),
    (numbers.budget_numeric, "-1,098,046", -1098046.0), (numbers.budget_numeric, "0", 0.0), (numbers.budget_numeric, "", None), (numbers.budget_numeric, "1,000", 1000.0), (numbers.budget_percent, "86,5", 86.5), (numbers.budget_percent, "86.5%", 86.5),
    (numbers.report_int, "66,629", 66629), (numbers.report_int, "-", None), (lambda c: numbers.report_int(c, zero_dash=True), " - ", 0), (numbers.report_numeric, "N.D.", None), (numbers.report_percent, "12,5%", 12.5),
    (text.match_key, "  Arte & Diseño   Gráfico Empresarial ", "ARTE DISENO GRAFICO EMPRESARIAL"), (text.match_key, "Beca de Permanencia - Convocatoria 2024", "BECA DE PERMANENCIA CONVOCATORIA 2024"), (text.match_key, " ACADÃ‰MICA  ", "ACADEMICA"),
    (text.clean_display, "Beca GeneraciÃ³n", "Beca Generación"), (text.region_name, "San Martín", "SAN MARTIN"),
    (text.is_total, "TOTAL GENERAL", True), (text.is_total, "Perú", True), (text.is_total, "CHACHAPOYAS", False), (text.is_total, "Total Amazonas", False),
    (text.territorial_action, "peru", "REVIEW_MAP_TO_NATIONAL_TOTAL"), (text.territorial_action, "Subtotal", "REVIEW_EXCLUDE_FROM_DETAIL_SILVER"), (text.territorial_action, "Sin información", "REVIEW_KEEP_AS_AGGREGATE_TABLE"), (text.territorial_action, "LIMA", "REVIEW_UNKNOWN"),
])
def test_vectors(spark, f, value, want):
    assert _eval(spark, f, value) == want


@pytest.mark.parametrize("value, code", [
    ("BECA   18", "REPEATED_SPACES"), ("BECA 18  ", "LEADING_OR_TRAILING_SPACE"), ("ACADÃ‰MICA", "MOJIBAKE_PATTERN"), ("ACAD�MICA", "REPLACEMENT_CHARACTER"), ("A\tB", "TAB_OR_NEWLINE"), ("ACAD$'MICA", "SUSPICIOUS_SYMBOL"),
    ("a@b", "SUSPICIOUS_SYMBOL"), ("a*b", "SUSPICIOUS_SYMBOL"), ("Beca", "LOWERCASE_OR_MIXED_CASE"), ("A-B", "PUNCTUATION_VARIANT"), ("X" * 50, "LONG_TEXT_VARIANT"), ("ÁÉ", "ACCENTED_CHARACTER"), ("日", "NON_ASCII_CHARACTER"), ("A\x07B", "CONTROL_CHARACTER"),
])
def test_issue_codes(spark, value, code):
    assert code in _eval(spark, text.issues, value)


def test_issues_of_blank_and_plain_text(spark):
    assert _eval(spark, text.issues, "  \t") == ["EMPTY_OR_WHITESPACE"] == _eval(spark, text.issues, None) and _eval(spark, text.issues, "BECA 18") == []


def test_headers():
    assert [headers.tolerant_key(h) for h in ("﻿Universidad", "Carrera de Estudio", "source_page", "Razones según la Elección")] == ["universidad", "carreraestudio", "sourcepage", "razoneseleccion"]
    assert headers.year_of("2026 (*)") == (2026, True) and headers.year_of("anio_2012") == (2012, False) and headers.year_of("Total") is None
    assert headers.is_total_header(" TOTAL ") and not headers.is_total_header("total_becarios_encuestados")


def test_budget_spec(spark):
    raw = {"ano": "2026", "ejecutora_codigo": "117-1438", "ejecutora_nombre": " PROGRAMA NACIONAL  DE BECAS ", "codigo_entidad": "other", "pia": "1,000", "pim": "2,000", "devengado": "1,500", "avance_porcentaje": "75.0", "girado": "1"}
    (r,) = _row(spark, "mef", "presupuesto", **raw)
    assert list(r) == ["ano", "codigo_entidad", "nombre_entidad", "pia", "pim", "devengado", "avance_porcentaje", *silver.TECHNICAL]
    assert (r["ano"], r["codigo_entidad"], r["nombre_entidad"], float(r["pia"]), float(r["avance_porcentaje"]), r["source_system"], r["source_dataset"]) == (2026, "117-1438", "PROGRAMA NACIONAL DE BECAS", 1000, 75, "mef", "presupuesto")
    (r,) = _row(spark, "mef", "presupuesto", ano="2026", ejecutora_codigo=" ", codigo_entidad="kept out")
    assert r["codigo_entidad"] is None  # presence decides, not content
    assert silver.SPECS["mef", "presupuesto_mef_temporal"] is silver.SPECS["mef", "presupuesto_temporal"]


def test_reports(spark):
    wide = {"universidad": " UNIVERSIDAD   NACIONAL ", "2012": "1,000", "2013": "-", "2026 (*)": "10", "Total": "1,010", "source_document_file": "beca18.pdf"}
    name = "report_beca18_universitarios_universidad_anual"
    assert [(r["universidad"], r["ano_convocatoria"], r["cantidad_becarios"], r["es_anio_preliminar"], r["source_document_file"]) for r in _row(spark, "pronabec_reports", name, **wide)] == [("UNIVERSIDAD NACIONAL", 2012, 1000, False, "beca18.pdf"), ("UNIVERSIDAD NACIONAL", 2013, 0, False, "beca18.pdf"), ("UNIVERSIDAD NACIONAL", 2026, 10, True, "beca18.pdf")]
    assert _row(spark, "pronabec_reports", name, **(wide | {"universidad": "Total general"})) == []
    (r,) = _row(spark, "pronabec_reports", "report_beca18_sexo_anual", ano_convocatoria="2025", Sexo=" Beca   GeneraciÃ³n ", porcentaje_becarios="12,5%", source_page="7")
    assert (r["ano_convocatoria"], r["sexo"], float(r["porcentaje_becarios"]), r["source_page"]) == (2025, "Beca Generación", 12.5, 7)


def test_open_data(spark):
    columns = "source_row_id string, region string, provincia string, b18_n string, fecha_carga string, more string"
    rows = [("2", " AMAZONAS ", " CHACHAPOYAS ", "72", "21/09/2016 00:00:00", "x"), ("3", "AMAZONAS", "BAGUA", "", None, "x")] + [("9", r, p, "1", None, "x") for r, p in (("AMAZONAS", "TOTAL"), (None, "TOTAL DE BENEFICIARIOS"), ("AMAZONAS", "TOTAL AMAZONAS"), ("", "CHACHAPOYAS"), ("AMAZONAS", "   "))]
    valid, rejects = silver.process(spark.createDataFrame(rows, columns), "pronabec", "becarios_provincia", CONTEXT)
    got = {r["source_row_id"]: r for r in valid.collect()}
    assert set(got) == {2, 3} and rejects.count() == 0
    assert (got[2]["region"], got[2]["provincia"], got[2]["becarios_b18_count"], str(got[2]["source_snapshot_date"]), got[2]["source_system"]) == ("AMAZONAS", "CHACHAPOYAS", 72, "2016-09-21", "PRONABEC")
    assert got[3]["becarios_b18_count"] is None


def test_rejects_name_the_first_rule(spark):
    raw = spark.createDataFrame([("2025", "Lima", "42.5"), ("2025", "Lima", "101"), ("x", None, "101"), (None, None, None)], "anio string, region string, pobreza_monetaria_pct string")
    valid, rejects = silver.process(raw, "inei_reports", "inei_pobreza_departamental", CONTEXT)
    assert valid.count() == 1
    assert sorted((r["error_code"], r["error_message"], r["processing_stage"]) for r in rejects.collect()) == [("TRANSFORM_ERROR", "anio es obligatorio y debe ser numérico.", "transform")] * 2 + [("TRANSFORM_ERROR", "pobreza_monetaria_pct debe estar entre 0 y 100.", "transform")]
    with pytest.raises(ValueError, match="unsupported dataset"):
        silver.process(raw, "inei_reports", "nothing", CONTEXT)
    other, none = silver.process(raw, "elsewhere", "anything", CONTEXT)
    assert set(silver.TECHNICAL) < set(other.columns) and other.count() == 4 and none.count() == 0
    empty, bad = silver.process(spark.createDataFrame([(" ",)], "nothing string"), "mef", "presupuesto", CONTEXT)
    assert empty.count() == 0 and [r["error_code"] for r in bad.collect()] == ["INVALID_RECORD"]


def test_enrollment(spark):
    cells = {"anio": "2025", "codigo_departamento": "02", "region": "Áncash", "nivel_educativo": "SECUNDARIA", "grado": "TERCER_GRADO", "matricula_total": "100", "matricula_publica": "80", "matricula_privada": "20", "matricula_urbana": "70", "matricula_rural": "30", "matricula_masculino": "45", "matricula_femenino": "55"}
    (r,) = _row(spark, "minedu_escale", "minedu_matricula_secundaria_departamental", **cells)
    assert (r["grado_orden"], r["region_normalizada"], float(r["publica_pct"]), float(r["femenino_pct"])) == (3, "ANCASH", 0.8, 0.55)
    (r,) = _row(spark, "minedu_escale", "minedu_matricula_secundaria_departamental", **(cells | {k: "0" for k in cells if k.startswith("matricula")}))
    assert r["publica_pct"] is None
    for bad in ({"grado": "SEXTO"}, {"matricula_rural": None}, {"anio": "2026"}, {"matricula_publica": "101"}, {"region": " "}):
        assert _row(spark, "minedu_escale", "minedu_matricula_secundaria_departamental", **(cells | bad)) == []


def test_internet_long_and_wide(spark):
    wide = spark.createDataFrame([("Amazonas", "18.2", " ", "67.7"), ("Lima", None, "", None)], "region string, `2012` string, `2013` string, `2025` string")
    valid, rejects = silver.process(silver.long_internet(wide), "inei_reports", "inei_internet_acceso_region", CONTEXT)
    assert sorted((r["anio"], float(r["internet_acceso_pct"]), r["source_name"], r["source_period"], r["source_type"], r["metric"]) for r in valid.collect()) == [(2012, 18.2, "INEI", "2012-2025", "manual_csv", "internet_acceso_pct"), (2025, 67.7, "INEI", "2012-2025", "manual_csv", "internet_acceso_pct")]
    assert rejects.count() == 1
    with pytest.raises(ValueError):
        silver.long_internet(spark.createDataFrame([("x",)], "region string"))


def test_contracts_and_rules_are_whole(spark):
    assert len(tables.SILVER) == 42 and all(f["name"] for fields in tables.SILVER.values() for f in fields)
    found = rules.all_rules()
    assert len(found) == 145 == len({r.check_id for r in found}) and sum(r.severity == "WARNING" for r in found) == 2
    empty = {name: contracts.empty_table(spark, fields) for name, fields in tables.SILVER.items()}
    got = {r["check_id"]: r for r in quality.run_rules(spark, empty, [r for r in found if r.layer == "silver"]).collect()}
    # every rule's columns are in its table's contract, and empty tables fail only what wants rows
    assert all(r["details"] in ("ok", "1 failed") for r in got.values())
    assert {k for k, r in got.items() if not r["passed"]} == {r.check_id for r in found if r.layer == "silver" and r.kind in ("not_empty", "metadata")}


def test_rules_of_analytic_tables_fit_their_columns(spark, sf):
    t = table_queries._analytic(spark, sf)
    t["region_cluster_assignments"] = predictive.cluster_assignments(t["region_coverage_features"], t["region_priority_scores_v2"])
    t["region_cluster_profiles"] = predictive.cluster_profiles(t["region_cluster_assignments"], F.lit(None).cast("timestamp"))
    done = views.publish(t, strict=False)
    assert len(done) == 6 and {r["view"] for r in views.smoke(spark, done).collect()} == set(done)
    got = quality.run_rules(spark, t | {n: spark.table(n) for n in done}, [r for r in rules.all_rules() if r.layer != "silver"]).collect()
    assert {r["check_id"] for r in got if not r["passed"]} == {"ml_region_context_features_critical_regions_present", "ml_region_priority_scores_critical_regions_present"}  # nations aren't those regions
    assert all(r["details"] in ("ok", "7 failed") for r in got)
    with pytest.raises(views.MissingTable):
        views.publish(t)


def test_clusters_are_nearest_and_profiled(spark, sf):
    t = table_queries._analytic(spark, sf)
    a = predictive.cluster_assignments(t["region_coverage_features"], t["region_priority_scores_v2"]).toPandas()
    x = a[list(predictive.CLUSTER_FEATURES)].astype(float).to_numpy()
    z = (x - x.mean(axis=0)) / np.where(x.std(axis=0, ddof=1) > 0, x.std(axis=0, ddof=1), 1)
    centers = np.stack([z[a.centroid_id == c].mean(axis=0) for c in sorted(a.centroid_id.unique())])
    away = np.sqrt(((z[:, None] - centers[None]) ** 2).sum(axis=2))
    assert sorted(a.centroid_id.unique()) == [1, 2, 3, 4] and (away.argmin(axis=1) + 1 == a.centroid_id).all()
    assert np.allclose(away.min(axis=1), a.centroid_distance, atol=1e-6)
    assert [tuple(c) for c in centers] == sorted(tuple(c) for c in centers)
    p = predictive.cluster_profiles(spark.createDataFrame(a), F.lit(None).cast("timestamp")).toPandas().set_index("centroid_id").sort_index()
    g = a.groupby("centroid_id")
    assert (p.regiones_count == g.region_canonical.nunique()).all() and np.allclose(p.avg_pobreza_monetaria_pct, g.pobreza_monetaria_pct.mean())


def test_region_dimension(spark):
    d = {r["source_region"]: r for r in canonical.region_dimension(spark).collect()}
    assert len(d) == 29 and len({r["region"] for r in d.values()}) == 25
    assert (d["LIMA PROVINCIAS"]["region"], d["LIMA"]["mapping_rule"], d["CALLAO"]["region_scope"], d["PUNO"]["is_aggregated_region"]) == ("LIMA", "manual_lima_aggregation", "province", False)


def test_sinks_and_landing(spark, tmp_path):
    path, day = str(tmp_path / "t"), {"extraction_date": "2026-06-15", "source_system": "mef", "source_dataset": "x"}
    df = spark.range(3).toDF("id")
    sinks.replace_slice(df, path, **day)
    sinks.replace_slice(df.where("id < 1"), path, **(day | {"source_dataset": "y"}))
    sinks.replace_slice(df.where("id < 2"), path, **day)
    assert spark.read.parquet(path).count() == 3
    sinks.replace_slice(df.limit(0), path, **day)  # a reload without rows empties its slice alone
    assert [r["source_dataset"] for r in spark.read.parquet(path).collect()] == ["y"]
    with pytest.raises(ValueError):
        sinks.replace_slice(df, path, **(day | {"source_system": " "}))
    sinks.write_manifests(spark.createDataFrame([("a", "{}")], "dataset string, manifest string"), str(tmp_path / "m"))
    assert (tmp_path / "m" / "_SUCCESS").exists()
    files = spark.createDataFrame([("/r/a_2026-06-15.csv", "a_2026-06-15.csv", 1), ("/r/a_2026-06-16.csv", "a_2026-06-16.csv", 2), ("/r/b.csv", "b.csv", 1)], "path string, name string, modified int")
    assert {(r["dataset"], r["path"]) for r in landing.latest_files(files).collect()} == {("a", "/r/a_2026-06-16.csv"), ("b", "/r/b.csv")}
    for name in ("b", "a"):
        (tmp_path / f"{name}.csv").write_text("x,y\n1,2\n\n3,4\n", encoding="utf-8-sig")
    assert [p.rsplit("/", 1)[1] for p in readers.expand(spark, f"{tmp_path}/*.csv")] == ["a.csv", "b.csv"]
    with pytest.raises(FileNotFoundError):
        readers.expand(spark, f"{tmp_path}/*.none")
    for r in readers.fingerprints(spark, f"{tmp_path}/a.csv").collect() + readers.line_fingerprints(spark, f"{tmp_path}/a.csv").collect():
        assert r["n_rows"] == 2 and [h.lstrip("﻿") for h in r["header"]] == ["x", "y"]
    contracts.create_external_table(spark, "outer_x", f"{tmp_path}/a.csv", tables.fields("x y"), "csv")
    assert [tuple(r) for r in spark.table("outer_x").collect()] == [("1", "2"), ("3", "4")]
    spark.sql("DROP TABLE outer_x")
    row = quarantine.audit_event(spark, run="r", note=None, metadata={"b": 1, "a": None}).first()
    assert (row["run"], row["note"], row["metadata"]) == ("r", None, '{"a": null, "b": 1}')


def test_json_lines_and_budget_html(spark, tmp_path):
    (tmp_path / "x.jsonl").write_text('{"source_row_id": "1", "vacantes": "50"}\n\n{"source_row_id": "2", "id_convocatoria":\n')
    rows, bad = readers.read_jsonl(spark, str(tmp_path / "x.jsonl"), ["source_row_id", "vacantes"])
    assert [tuple(r) for r in rows.collect()] == [("1", "50")] and [r["error_code"] for r in bad.collect()] == ["PARSE_ERROR"]
    cells = "".join(f"<td>{c}</td>" for c in ("117: BECAS", "1,429,676,488", "2", "3", "4", "5", "6", "7", "41.2"))
    grid = readers.table_grid(spark.createDataFrame([(1, f"<table class='Data'><tr>{cells}</tr><tr>{cells}</tr><tr><td>x</td></tr></table>")], "page int, html string"))
    got = readers.budget_rows(grid, "page", [f"m{i}" for i in range(8)]).collect()
    assert [(r["descriptor"], r["m0"], r["m7"]) for r in got] == [("117: BECAS", "1,429,676,488", "41.2")]
