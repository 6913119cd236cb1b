"""The data-quality rules of all tables, as data built from a few kinds of predicate."""

from __future__ import annotations

from quillon.operators.quality import Rule
from quillon.sources import tables


def _any(conditions: list[str]) -> str:
    return " OR ".join(f"({c})" for c in conditions)


def blank(*names: str) -> str:
    return _any([f"{n} IS NULL OR trim({n}) = ''" for n in names])


def null(*names: str) -> str:
    return _any([f"{n} IS NULL" for n in names])


def negative(*names: str) -> str:
    return _any([f"{n} < 0" for n in names])


def outside(low: float, high: float, *names: str) -> str:
    return _any([f"{n} < {low} OR {n} > {high}" for n in names])


def not_in(name: str, values: tuple[str, ...]) -> str:
    return f"{name} NOT IN ({', '.join(repr(v) for v in values)})"


def among(values: tuple[str, ...], *names: str) -> str:
    return _any([f"{n} IN ({', '.join(repr(v) for v in values)})" for n in names])


# Members that must or mustn't be there, and allowed values.
CRITICAL_REGIONS = ("LIMA", "CALLAO", "CUSCO", "PUNO", "LORETO", "CAJAMARCA", "AYACUCHO")
LEGACY_REGIONS = ("LIMA METROPOLITANA", "LIMA PROVINCIAS", "PROV. CONST. DEL CALLAO", "PROVINCIA CONSTITUCIONAL DEL CALLAO")
QUALITY_FLAGS = ("complete", "usable", "partial", "insufficient")
PRIORITIES = ("official", "manual_public_source", "synthetic_demo", "mixed")
TIERS = ("Muy alta", "Alta", "Media", "Baja", "Insuficiente")
METHODS = ("reported_regional_count", "estimated_from_regional_share", "first_generation_snapshot_only", "unavailable", "mixed")

_GRAIN = ["anio", "region_canonical"]
_SCENARIO_GRAIN = [*_GRAIN, "scenario_id"]
_REPORT = "pronabec_report_beca18_"
_MONEY = ("pia", "pim", "devengado", "avance_porcentaje")


class _Table:
    """Collects the rules of one table; check ids start with its layer and name."""

    def __init__(self, out: list[Rule], layer: str, table: str, prefix: str | None = None):
        self.out, self.layer, self.table, self.prefix = out, layer, table, prefix or f"{layer}_{table}"

    def add(self, end: str, kind: str, severity: str = "ERROR", **params) -> _Table:
        self.out.append(Rule(f"{self.prefix}_{end}", self.table, kind, params, severity, self.layer))
        return self

    def filled(self) -> _Table:
        return self.add("not_empty", "not_empty")

    def fails(self, end: str, condition: str, severity: str = "ERROR") -> _Table:
        return self.add(end, "where", severity, condition=condition)

    def unique(self, end: str, keys: list[str]) -> _Table:
        return self.add(end, "unique", keys=keys)


def _silver(out: list[Rule]) -> None:
    t = lambda name: _Table(out, "silver", name)
    t("pronabec_convocatorias").filled().fails("critical_nulls", null("source_system", "source_dataset", "extraction_date", "pipeline_run_id", "id_convocatoria"))
    t("pronabec_ubigeo_postulacion").filled().fails("format", blank("codigo_ubigeo"), "WARNING")
    t("pronabec_becarios_pais_estudio").filled().fails("nulls", null("source_system", "source_dataset", "extraction_date", "pais_estudio"))
    abroad = "upper(trim(coalesce(institucion_educativa, ''))) RLIKE 'ESTUDIOS EN EL EXTRANJERO|CONVALIDADOS POR MINEDU'"
    t("pronabec_colegios_elegibles").filled().fails("nulls", f"({blank('ugel', 'institucion_educativa', 'tipo_gestion_colegio')}) AND NOT {abroad}")
    for report, name in tables.WIDE_REPORTS.items():
        r = t(_REPORT + report).filled().unique("duplicates", [name, "ano_convocatoria", "extraction_date"])
        r.fails("canonical_consistency", f"{name}_canonical_match_method IS NOT NULL AND {name}_canonical IS NULL").fails("ranges", negative("cantidad_becarios"))
    t(_REPORT + "becas_otorgadas_modalidad_anual").filled().fails("ranges", negative("becas_otorgadas"))
    t("presupuesto_mef").filled().fails("nulls", null("ano", "source_system", "source_dataset", "extraction_date")).fails("ano_range", outside(2000, 2050, "ano"))
    period = "(periodo_tipo = 'MENSUAL' AND (mes_numero IS NULL OR mes_numero < 1 OR mes_numero > 12)) OR (periodo_tipo = 'TRIMESTRAL' AND (trimestre IS NULL OR trimestre < 1 OR trimestre > 4))"
    t("presupuesto_mef_temporal").filled().fails("period_consistency", period)
    for end in ("_producto", "_actividad", "_generica"):
        t(f"presupuesto_mef{end}").filled()
        t(f"presupuesto_mef{end}_temporal").filled()
    t("presupuesto_mef_hierarchy").filled().fails("nulls", null("nivel_jerarquia", "nombre_entidad"))
    province = "upper(trim(provincia)) LIKE 'TOTAL%' OR " + blank("region", "provincia", "pipeline_run_id") + " OR extraction_date IS NULL"
    t("pronabec_beca18_becarios_provincia_2016").filled().fails("invalid_rows", province).fails("negative_counts", negative("becarios_b18_count"))
    for end in ("", "_producto", "_actividad", "_generica", "_hierarchy"):
        t(f"presupuesto_mef{end}").fails("negative_values", negative(*_MONEY))
    for report in tables.REPORTS:
        t(_REPORT + report).add("valid", "metadata", fields=["extraction_date", "pipeline_run_id"])
    t("pronabec_colegios_elegibles").fails("fields_format", blank("distrito", "nivel_modalidad", "forma_atencion"), "WARNING")
    # Countries that have no provinces.
    abroad = "coalesce(upper(trim(region)), '') NOT IN ('CHILE', 'COLOMBIA', 'MEXICO')"
    t("pronabec_ubigeo_postulacion").fails("fields_nulls", f"{blank('region', 'distrito')} OR (({blank('provincia')}) AND {abroad})")
    t("pronabec_becarios_pais_estudio").fails("fields_nulls", blank("institucion"))
    ranges = {
        "population_youth_region": negative("poblacion_15_24", "poblacion_15_29"),
        "demographic_indicators_region": "esperanza_vida_nacer <= 0",
        "pobreza_departamental": "pobreza_monetaria_pct NOT BETWEEN 0 AND 100",
        "internet_acceso_region": "internet_acceso_pct NOT BETWEEN 0 AND 100",
    }
    for name, condition in ranges.items():
        t(f"inei_{name}").fails("required_ranges", f"anio IS NULL OR {blank('region')} OR {condition}").unique("duplicates", ["anio", "region"])


def _ml(out: list[Rule]) -> None:
    t = lambda name: _Table(out, "ml", name)
    legacy = among(LEGACY_REGIONS, "region", "region_canonical")
    c = t("region_context_features").filled().unique("unique_grain", _GRAIN).fails("year_range", outside(2012, 2025, "anio"))
    c.fails("percentage_ranges", outside(0, 100, "pobreza_monetaria_pct", "internet_acceso_pct", "brecha_digital_pct", "ruralidad_educativa_pct"))
    c.fails("nonnegative_counts", negative(*(f"matricula_5to_{x}" for x in ("secundaria", "publica", "privada", "urbana", "rural")), *(f"poblacion_{x}" for x in ("total", "15_24", "15_29"))))
    c.fails("completeness_score_range", outside(0, 1, "feature_completeness_score"))
    c.fails("feature_quality_flag_allowed_values", not_in("feature_quality_flag", QUALITY_FLAGS)).fails("source_priority_allowed_values", not_in("source_priority", PRIORITIES))
    c.add("critical_regions_present", "required_members", column="region_canonical", members=list(CRITICAL_REGIONS)).fails("no_legacy_region_variants", legacy)
    c.fails("synthetic_metadata_consistency", f"(has_synthetic_values AND ({blank('synthetic_fields')})) OR (NOT has_synthetic_values AND trim(synthetic_fields) <> '')")

    p = t("region_priority_scores").filled().unique("unique_grain", _GRAIN).fails("priority_score_range", outside(0, 1, "priority_score"))
    p.fails("component_ranges", outside(0, 1, *(f"{x}_score" for x in ("pobreza", "demanda_educativa", "poblacion_joven", "ruralidad", "brecha_digital"))))
    p.fails("tier_allowed_values", not_in("priority_tier", TIERS)).fails("rank_positive", "priority_score IS NOT NULL AND (priority_rank IS NULL OR priority_rank < 1)")
    p.fails("version_constant", "score_version <> 'regional_context_v1'").fails("no_legacy_region_variants", legacy)
    p.add("critical_regions_present", "required_members", column="region_canonical", members=list(CRITICAL_REGIONS))

    v = t("region_coverage_features").filled().unique("unique_grain", _GRAIN).fails("nonnegative_rates", negative("becas_por_1000_jovenes", "becas_por_1000_matriculados_5to"))
    v.fails("score_ranges", outside(0, 1, "coverage_gap_score", "primera_generacion_score")).fails("flag_allowed_values", not_in("coverage_data_quality_flag", QUALITY_FLAGS))
    v.fails("source_method_allowed_values", not_in("coverage_source_method", METHODS)).fails("no_legacy_region_variants", legacy)

    w = t("region_priority_scores_v2").filled().unique("unique_grain", _GRAIN).fails("priority_score_range", outside(0, 1, "priority_score_v2"))
    w.fails("component_ranges", outside(0, 1, "context_priority_score", "coverage_gap_score", "primera_generacion_score")).fails("tier_allowed_values", not_in("priority_tier_v2", TIERS))
    w.fails("rank_positive", "priority_score_v2 IS NOT NULL AND (priority_rank_v2 IS NULL OR priority_rank_v2 < 1)").fails("version_constant", "score_version <> 'regional_context_coverage_v2'")

    t("region_cluster_assignments").filled().unique("unique_grain", _GRAIN).fails("centroid_not_null", null("centroid_id")).fails("year_range", outside(2012, 2025, "anio"))
    t("region_cluster_profiles").filled().fails("region_count_positive", "regiones_count IS NULL OR regiones_count <= 0")
    f = t("budget_forecast_results").filled().fails("value_not_null", null("forecast_value"))
    f.fails("lower_bound", "prediction_interval_lower_bound > forecast_value").fails("upper_bound", "forecast_value > prediction_interval_upper_bound")
    s = t("budget_scenarios").filled().unique("unique_scenario_id", ["scenario_id"])
    for m in ("budget_multiplier", "scholarship_multiplier"):
        s.fails(f"{m}_positive", f"{m} IS NULL OR {m} <= 0")
    s.fails("weight_ranges", outside(0, 1, *(f"{x}_weight" for x in ("poverty", "demand", "population", "coverage", "first_generation", "balanced_priority"))))
    s.add("base_priority_present", "present", condition="scenario_id = 'base_priority'")
    a = t("region_allocation_scenarios").filled().unique("unique_grain", _SCENARIO_GRAIN).fails("allocation_weight_range", outside(0, 1, "allocation_weight")).fails("allocation_pct_range", outside(0, 100, "allocation_pct"))
    a.add("weight_sum_by_year_scenario", "foots", keys=["anio", "scenario_id"], column="allocation_weight", tolerance=1e-4).fails("rank_not_null", null("scenario_rank"))
    a.fails("estimated_budget_nonnegative", negative("estimated_budget_amount")).fails("scenario_budget_nonnegative", negative("scenario_budget_amount"))


def _gold(out: list[Rule]) -> None:
    t = lambda name: _Table(out, "gold", f"vw_predictive_{name}", f"gold_predictive_{name}")
    for end in ("", "_v2"):
        score, rank = f"priority_score{end}", f"priority_rank{end}"
        g = t(f"region_priority_scores{end}").filled().unique("unique_grain", _GRAIN).fails("priority_score_range", outside(0, 1, score))
        g.fails("priority_score_pct_range", outside(0, 100, f"{score}_pct")).fails("rank_positive", f"{score} IS NOT NULL AND ({rank} IS NULL OR {rank} < 1)")
    for name in ("region_clusters", "region_cluster_profiles", "budget_forecast"):
        t(name).filled()
    t("region_allocation_scenarios").filled().unique("unique_grain", _SCENARIO_GRAIN).fails("allocation_weight_range", outside(0, 1, "allocation_weight")).fails("rank_not_null", null("scenario_rank"))


def all_rules() -> list[Rule]:
    out: list[Rule] = []
    _silver(out)
    _ml(out)
    _gold(out)
    return out
