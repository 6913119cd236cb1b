"""The Gold views as functions of cleaned and analytic tables, and their publication.

A view is made from a dictionary of tables by name. Shapes that repeat, such as tall indicators, execution
ratios and yearly joins of grants and budget, are one function each with the members as data.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillon.sources import tables as contracts

Tables = dict[str, DataFrame]
_REPORT = "pronabec_report_beca18_"

# Indicators of the social profile: group, name, report, category, subcategory, count, value.
# A category or subcategory in quotes is itself the value; others are columns.
INDICATORS = (
    ("Perfil Étnico", "Autoidentificación Étnica", "autoidentificacion_etnica_modalidad_2025", "modalidad", "autoidentificacion_etnica", None, "porcentaje_becarios"),
    ("Perfil Lingüístico", "Lengua Materna", "lengua_materna_modalidad_2025", "modalidad", "lengua_materna", None, "porcentaje_becarios"),
    ("Entorno Educativo", "Colegio de Procedencia", "colegio_gestion_2025", "'Tipo de Gestión'", "tipo_gestion_colegio", None, "porcentaje_becarios"),
    ("Entorno Familiar", "Nivel Educativo de los Padres", "padres_nivel_educativo_2025", "'Nivel Educativo'", "nivel_educativo_padres", None, "porcentaje_becarios"),
    ("Movilidad Social", "Primera Generación Universitaria", "primera_generacion_region", "region", "'Primera Generación'", "total_becarios_primera_generacion", "ratio_primera_generacion"),
    ("Impacto Social", "No Continuaría Sin Beca", "no_continuaria_sin_beca_caracteristica_2025", "grupo_caracteristica", "caracteristica", None, "porcentaje_becarios"),
    ("Entorno Educativo", "Tipo de Preparación IES", "preparacion_ies_tipo_2025", "'Tipo de Preparación'", "tipo_preparacion", None, "porcentaje_becarios"),
    ("Entorno Educativo", "Meses de Preparación IES", "preparacion_ies_meses_caracteristica_2025", "grupo_caracteristica", "caracteristica", None, "promedio_meses_preparacion"),
    ("Perfil Demográfico", "Distribución por Sexo", "sexo_anual", "'Sexo'", "sexo", None, "porcentaje_becarios"),
    ("Rendimiento ENP", "Puntaje ENP por Característica", "enp_promedio_caracteristica_2025", "grupo_caracteristica", "caracteristica", None, "puntaje_promedio_enp"),
    ("Rendimiento ENP", "Puntaje ENP por Región", "enp_promedio_region_2025", "'Región'", "region", None, "puntaje_promedio_enp"),
    ("Entorno Educativo", "Periodo de Ingreso a la Educación Superior", "periodo_ingreso_ies_genero_2025", "sexo", "periodo_ingreso_ies", None, "porcentaje_becarios"),
)
# Kinds of rows in the unions: kind, report, member, value.
APPLICATIONS = (("anual", "region_postulacion_anual", "grupo_region", "porcentaje_becarios"), ("acumulado", "region_postulacion_acumulada", "region", "porcentaje_acumulado"), ("encuesta_2025", "region_postulacion_2025", "region", "porcentaje_becarios"))
MIGRATION = (("anual", "migracion_region_anual", "'Nacional'", "porcentaje_migracion_region"), ("acumulado", "migracion_region_acumulada", "region", "tasa_migracion_acumulada"))
CHOICES = (
    ("Elección de Carrera por Gestión IES", "razones_eleccion_carrera_gestion_ies_2025", "razon_eleccion_carrera", "gestion_ies"),
    ("Elección de Carrera por Sexo", "razones_eleccion_carrera_sexo_2025", "razon_eleccion_carrera", "sexo"),
    ("Elección de IES por Gestión Escolar de Origen", "razones_eleccion_ies_gestion_2025", "razon_eleccion_ies", "gestion_ies"),
)


def safe_percent(n: Column, d: Column) -> Column:
    """100 n / d; null without a divisor."""
    return F.try_multiply(F.try_divide(n.cast("double"), F.nullif(d.cast("double"), F.lit(0.0))), F.lit(100.0))


def safe_ratio(n: Column, d: Column) -> Column:
    return F.try_divide(n.cast("double"), F.nullif(d.cast("double"), F.lit(0.0)))


def _cell(name: str) -> Column:
    """A column, or the text itself if it stands in quotes."""
    return F.lit(name[1:-1]) if name.startswith("'") else F.col(name)


def _period(report: str) -> Column:
    return F.col(contracts.report_period(report).rstrip("!").split(":")[0]).cast("string")


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def executive_summary(t: Tables, today: Column) -> DataFrame:
    """One row of totals of the budget, the grants and the calls."""
    budget = t["presupuesto_mef"].agg(F.sum("pia").alias("pia_total"), F.sum("pim").alias("pim_total"), F.sum("devengado").alias("devengado_total"))
    grants = t[f"{_REPORT}becas_otorgadas_modalidad_anual"].agg(F.sum("becas_otorgadas").alias("total_becas_otorgadas"), F.countDistinct("modalidad").alias("modalidades_atendidas"))
    calls = t["pronabec_convocatorias"].agg(F.countDistinct("id_convocatoria").alias("convocatorias_registradas"), F.sum("vacantes").alias("vacantes_registradas"))
    one = budget.withColumn("avance_presupuestal_pct", safe_percent(F.col("devengado_total"), F.col("pim_total")))
    joined = one.withColumn("_one", F.lit(1)).join(grants.withColumn("_one", F.lit(1)), "_one").join(calls.withColumn("_one", F.lit(1)), "_one")  # a row each
    return joined.select(today.alias("fecha_consulta"), "pia_total", "pim_total", "devengado_total", "avance_presupuestal_pct", "total_becas_otorgadas", "modalidades_atendidas", "convocatorias_registradas", "vacantes_registradas")


def territorial_coverage(t: Tables) -> DataFrame:
    """Provinces with their place in the country and their share of the region; totals and blanks go."""
    detail = t["pronabec_beca18_becarios_provincia_2016"].where("trim(region) <> '' AND trim(provincia) <> '' AND upper(trim(provincia)) NOT LIKE 'TOTAL%'")
    count, region = F.col("becarios_b18_count"), Window.partitionBy("region")
    total = F.sum(count).over(region)
    return detail.select("region", "provincia", "becarios_b18_count", "source_snapshot_date", "extraction_date", "pipeline_run_id", national_rank(detail, "becarios_b18_count"), total.alias("total_region_b18"), safe_ratio(count, total).alias("participacion_provincia_region"))


def national_rank(df: DataFrame, column: str) -> Column:
    """The rank over all rows of a small mart, in one task: a row a province."""
    return F.rank().over(Window.orderBy(F.col(column).desc_nulls_last())).cast("bigint").alias("ranking_nacional_provincia")


def university_years(t: Tables, report: str) -> DataFrame:
    """A wide report's rows with the canonical value, or the original where there is none, as the final one."""
    name = contracts.WIDE_REPORTS[report]
    return t[_REPORT + report].select(name, f"{name}_canonical", F.coalesce(f"{name}_canonical", name).alias(f"{name}_final"), f"{name}_canonical_match_method", f"{name}_canonical_review_required", "ano_convocatoria", "cantidad_becarios", "es_anio_preliminar", "source_publication_url", "source_table")


def social_profile(t: Tables) -> DataFrame:
    """All indicators as tall rows."""
    return _union(
        [
            t[_REPORT + report].select(
                F.lit(group).alias("indicator_group"),
                F.lit(name).alias("indicator_name"),
                _cell(category).alias("category"),
                _cell(subcategory).alias("subcategory"),
                _period(report).alias("period"),
                (F.col(count) if count else F.lit(None)).cast("bigint").alias("value_count"),
                F.col(value).alias("value_percentage"),
                "source_dataset",
                "source_document_file",
            )
            for group, name, report, category, subcategory, count, value in INDICATORS
        ]
    )


def regions_by_kind(t: Tables, kinds: tuple, value: str) -> DataFrame:
    """(tipo_registro, region, periodo, value, source fields) of the reports of several kinds."""
    return _union([t[_REPORT + report].select(F.lit(kind).alias("tipo_registro"), _cell(member).alias("region"), _period(report).alias("periodo"), F.col(c).alias(value), "source_dataset", "source_document_file") for kind, report, member, c in kinds])


def choices(t: Tables) -> DataFrame:
    """Why grantees chose what and where they study."""
    return _union([t[_REPORT + report].select(F.lit(what).alias("dimension_analisis"), F.col(reason).alias("motivo"), F.col(segment).alias("segmento"), "porcentaje_becarios", "source_dataset", "source_document_file") for what, report, reason, segment in CHOICES])


def budget_execution(t: Tables, end: str, extra: tuple[str, ...] = ()) -> DataFrame:
    """A budget table with the execution computed from its figures."""
    dims = [f["name"] for f in contracts.fields(contracts.BUDGET_DIMENSIONS[end])]
    return t[f"presupuesto_mef{end}"].select("ano", *dims, "pia", "pim", "devengado", "avance_porcentaje", safe_percent(F.col("devengado"), F.col("pim")).alias("avance_calculado_pct"), *extra)


def _by_year(t: Tables) -> DataFrame:
    """(ano, becas, pia, pim, devengado): yearly sums of grants and budget; a year may lack either."""
    grants = t[f"{_REPORT}becas_otorgadas_modalidad_anual"].groupBy(F.col("ano_convocatoria").alias("ano")).agg(F.sum("becas_otorgadas").alias("becas"))
    return grants.join(t["presupuesto_mef"].groupBy("ano").agg(*[F.sum(c).alias(c) for c in ("pia", "pim", "devengado")]), "ano", "full")


def grants_against_budget(t: Tables) -> DataFrame:
    y, c = _by_year(t), F.col
    return y.select("ano", c("becas").alias("becas_otorgadas_total"), c("pia").alias("pia_total"), c("pim").alias("pim_total"), c("devengado").alias("devengado_total"), safe_percent(c("devengado"), c("pim")).alias("avance_presupuestal_pct"), safe_ratio(c("devengado"), c("becas")).alias("devengado_por_beca"), safe_ratio(c("pim"), c("becas")).alias("pim_por_beca"))


def analytic_summary(t: Tables) -> DataFrame:
    y, c = _by_year(t), F.col
    return y.select("ano", c("becas").alias("total_becas_otorgadas"), c("pia").alias("total_pia"), c("pim").alias("total_pim"), c("devengado").alias("total_devengado"), safe_percent(c("devengado"), c("pim")).alias("avance_presupuestal_pct"), safe_ratio(c("devengado"), c("becas")).alias("costo_promedio_por_beca"))


def rank_label(rank: str, name: str) -> Column:
    """`3. NAME`, or the name alone without a rank."""
    return F.when(F.col(rank).isNull(), F.col(name)).otherwise(F.concat(F.col(rank).cast("string"), F.lit(". "), F.col(name)))


# The columns of the predictive views, in order; what is computed stands as name=score.
_V1 = "anio region region_canonical priority_rank priority_tier priority_score priority_score_pct=priority_score priority_label=priority_rank pobreza_score demanda_educativa_score poblacion_joven_score brecha_digital_score ruralidad_score pobreza_monetaria_pct matricula_5to_secundaria poblacion_15_29 poblacion_15_24 ruralidad_educativa_pct internet_acceso_pct brecha_digital_pct feature_completeness_score feature_quality_flag source_priority has_synthetic_values synthetic_fields score_version score_method created_at"
_V2 = "anio region region_canonical priority_rank_v2 priority_tier_v2 priority_score_v2 priority_score_v2_pct=priority_score_v2 priority_label_v2=priority_rank_v2 context_priority_score coverage_gap_score primera_generacion_score context_priority_rank context_priority_tier regional_becarios_pct= regional_becarios_estimated= total_becas_anual= becas_por_1000_jovenes= becas_por_1000_matriculados_5to= demanda_no_cubierta_estimada= coverage_data_quality_flag coverage_source_method coverage_source_notes has_estimated_coverage score_version score_method created_at"
_CLUSTERS = "anio region region_canonical centroid_id centroid_distance cluster_label priority_score_v2 priority_score_v2_pct=priority_score_v2 context_priority_score coverage_gap_score primera_generacion_score pobreza_monetaria_pct matricula_5to_secundaria poblacion_15_29 brecha_digital_pct ruralidad_educativa_pct primera_generacion_ratio becas_por_1000_jovenes becas_por_1000_matriculados_5to created_at"
_PROFILES = "centroid_id cluster_label regiones_count " + " ".join(f"avg_{x}" for x in ("priority_score_v2", "context_priority_score", "coverage_gap_score", "primera_generacion_score", "pobreza_monetaria_pct", "matricula_5to_secundaria", "brecha_digital_pct", "ruralidad_educativa_pct")) + " created_at"
_FORECAST = "forecast_timestamp forecast_value prediction_interval_lower_bound prediction_interval_upper_bound confidence_level forecast_horizon_months model_name forecast_version"
_ALLOCATION = "anio region region_canonical scenario_id scenario_name scenario_type allocation_method budget_multiplier scholarship_multiplier priority_score_v2 context_priority_score coverage_gap_score primera_generacion_score poverty_score demand_score population_score digital_gap_score rurality_score scenario_raw_score allocation_weight allocation_pct scenario_rank baseline_rank_v2 rank_change_vs_v2 reference_forecast_budget_amount scenario_budget_amount estimated_budget_amount estimated_scholarships scenario_version scenario_notes created_at"


def projection(df: DataFrame, columns: str) -> DataFrame:
    """The columns in order. name=score is 100 times the score, name=rank (of a label) the ranked name, and name= a typed null."""
    out = []
    for word in columns.split():
        name, sign, of = word.partition("=")
        if not sign:
            out.append(F.col(name))
        elif not of:
            out.append(F.lit(None).cast("decimal(38,9)").alias(name))
        elif "label" in name:
            out.append(rank_label(of, "region_canonical").alias(name))
        else:
            out.append(F.try_multiply(F.col(of), F.lit(100.0)).alias(name))
    return df.select(*out)


VIEWS: dict[str, Callable[[Tables], DataFrame]] = {
    "vw_pronabec_resumen_ejecutivo": lambda t: executive_summary(t, F.current_date()),
    "vw_beca18_becas_otorgadas_anual": lambda t: t[f"{_REPORT}becas_otorgadas_modalidad_anual"].select("modalidad", "ano_convocatoria", "becas_otorgadas", "source_document_file", "source_page"),
    "vw_beca18_cobertura_territorial_2016": territorial_coverage,
    "vw_beca18_universitarios_carrera_anual": lambda t: university_years(t, "universitarios_carrera_anual"),
    "vw_beca18_universitarios_universidad_anual": lambda t: university_years(t, "universitarios_universidad_anual"),
    "vw_beca18_perfil_social_indicadores": social_profile,
    "vw_beca18_region_postulacion": lambda t: regions_by_kind(t, APPLICATIONS, "porcentaje_becarios"),
    "vw_beca18_migracion_region": lambda t: regions_by_kind(t, MIGRATION, "tasa_migracion"),
    "vw_beca18_trayectoria_eleccion": choices,
    "vw_mef_presupuesto_ejecucion_anual": lambda t: budget_execution(t, "", ("extraction_date", "ingestion_timestamp")),
    "vw_mef_presupuesto_ejecucion_temporal": lambda t: t["presupuesto_mef_temporal"].select("ano", "periodo_tipo", "periodo_valor", "trimestre", "mes_numero", "mes_nombre", "devengado", "extraction_date", "ingestion_timestamp"),
    "vw_mef_presupuesto_producto": lambda t: budget_execution(t, "_producto"),
    "vw_mef_presupuesto_actividad": lambda t: budget_execution(t, "_actividad"),
    "vw_mef_presupuesto_generica": lambda t: budget_execution(t, "_generica"),
    "vw_pronabec_becas_vs_presupuesto_anual": grants_against_budget,
    "vw_pronabec_beca18_resumen_analitico": analytic_summary,
    "vw_predictive_region_priority_scores": lambda t: projection(t["region_priority_scores"], _V1),
    "vw_predictive_region_priority_scores_v2": lambda t: projection(t["region_priority_scores_v2"], _V2),
    "vw_predictive_region_clusters": lambda t: projection(t["region_cluster_assignments"], _CLUSTERS),
    "vw_predictive_region_cluster_profiles": lambda t: projection(t["region_cluster_profiles"], _PROFILES),
    "vw_predictive_budget_forecast": lambda t: projection(t["budget_forecast_results"], _FORECAST),
    "vw_predictive_region_allocation_scenarios": lambda t: projection(t["region_allocation_scenarios"], _ALLOCATION),
}


class MissingTable(Exception):
    """A view needs a table that isn't there."""


class _Tables(dict):
    def __missing__(self, name):
        raise MissingTable(name)


def publish(tables: Tables, strict: bool = True) -> list[str]:
    """Makes the views in order as temporary views of the session and gives their names.

    A table that isn't there is an error, or, if not strict, leaves out the views that need it.
    """
    done = []
    for name, view in VIEWS.items():
        try:
            df = view(_Tables(tables))
        except MissingTable:
            if strict:
                raise
            continue
        df.createOrReplaceTempView(name)
        done.append(name)
    return done


def smoke(spark: SparkSession, names: list[str]) -> DataFrame:
    """(view, rows): every view answers a count; one that can't be read is an error."""
    return _union([spark.table(n).agg(F.count("*").alias("rows")).select(F.lit(n).alias("view"), "rows") for n in names])
