"""Contracts of the cleaned tables, built by rule from their dimensions and measures.

A field is written `name`, `name:type` or with a `!` if it is required; without a type it is text.
"""

from __future__ import annotations

_KINDS = {"text": "STRING", "int": "INT64", "dec": "NUMERIC", "bool": "BOOL", "date": "DATE", "ts": "TIMESTAMP"}


def fields(text: str) -> list[dict]:
    out = []
    for word in text.split():
        name, _, kind = word.rstrip("!").partition(":")
        out.append({"name": name, "type": _KINDS[kind or "text"], "mode": "REQUIRED" if word.endswith("!") else "NULLABLE"})
    return out


#: Fields that every cleaned table ends with.
TECHNICAL = "source_system! source_dataset! extraction_date:date! ingestion_timestamp:ts! pipeline_run_id!"
# Fields that tell the document a report's figures come from.
DOCUMENT = "source_document_file! source_document_title! source_page:int! source_figure! extraction_method!"
DOCUMENT_OF_TABLE = "source_document_file! source_document_title! source_publication_url! source_page:int! source_table! extraction_method!"

# Names of budget fields.
MONEY = "pia:dec pim:dec devengado:dec avance_porcentaje:dec"
PERIOD = "periodo_tipo! periodo_valor! trimestre:int mes_numero:int mes_nombre"
BUDGET_DIMENSIONS = {"": "codigo_entidad! nombre_entidad!", "_producto": "codigo_producto! producto!", "_actividad": "codigo_producto! producto! codigo_actividad! actividad!", "_generica": "codigo_generica! generica!"}

# Dimensions and measure of each report; the name's ending tells its period.
REPORTS = {
    "autoidentificacion_etnica_modalidad_2025": "autoidentificacion_etnica! modalidad! porcentaje_becarios:dec",
    "colegio_gestion_2025": "tipo_gestion_colegio! porcentaje_becarios:dec",
    "enp_promedio_caracteristica_2025": "grupo_caracteristica! caracteristica! puntaje_promedio_enp:dec",
    "enp_promedio_region_2025": "region! puntaje_promedio_enp:dec",
    "lengua_materna_modalidad_2025": "lengua_materna! modalidad! porcentaje_becarios:dec",
    "migracion_region_acumulada": "region! tasa_migracion_acumulada:dec",
    "migracion_region_anual": "porcentaje_migracion_region:dec",
    "no_continuaria_sin_beca_caracteristica_2025": "grupo_caracteristica! caracteristica! porcentaje_becarios:dec",
    "padres_nivel_educativo_2025": "nivel_educativo_padres! porcentaje_becarios:dec",
    "periodo_ingreso_ies_genero_2025": "periodo_ingreso_ies! sexo! porcentaje_becarios:dec",
    "preparacion_ies_meses_caracteristica_2025": "grupo_caracteristica! caracteristica! promedio_meses_preparacion:dec",
    "preparacion_ies_tipo_2025": "tipo_preparacion! porcentaje_becarios:dec",
    "primera_generacion_region": "region! total_becarios_primera_generacion:int total_becarios_encuestados:int ratio_primera_generacion:dec",
    "razones_eleccion_carrera_gestion_ies_2025": "razon_eleccion_carrera! gestion_ies! porcentaje_becarios:dec",
    "razones_eleccion_carrera_sexo_2025": "razon_eleccion_carrera! sexo! porcentaje_becarios:dec",
    "razones_eleccion_ies_gestion_2025": "razon_eleccion_ies! gestion_ies! porcentaje_becarios:dec",
    "region_postulacion_2025": "region! porcentaje_becarios:dec",
    "region_postulacion_acumulada": "region! porcentaje_acumulado:dec",
    "region_postulacion_anual": "grupo_region! porcentaje_becarios:dec",
    "sexo_anual": "sexo! porcentaje_becarios:dec",
}
# Reports with a column a year, and their dimension.
WIDE_REPORTS = {"universitarios_carrera_anual": "carrera_estudio", "universitarios_universidad_anual": "universidad"}
# Open-data tables; `=` marks fields that get canonical values.
OPEN_DATA = {
    "pronabec_convocatorias": "source_row_id:int id_convocatoria:int codigo_anual descripcion_convocatoria modalidad= programa= vacantes:int",
    "pronabec_ubigeo_postulacion": "source_row_id:int region= provincia distrito codigo_ubigeo",
    "pronabec_becarios_pais_estudio": "source_row_id:int convocatoria modalidad= pais_estudio= institucion sexo=",
    "pronabec_beca18_becarios_provincia_2016": "source_row_id:int region provincia becarios_b18_count:int source_snapshot_date:date",
    "pronabec_colegios_elegibles": "source_row_id:int ugel= institucion_educativa tipo_gestion_colegio= nivel_modalidad= forma_atencion= distrito",
}
# Regional tables.
SOURCE = "source_name source_period source_type metric"
REGIONAL = {
    "inei_population_youth_region": "anio:int! region! poblacion_total:int poblacion_15_24:int poblacion_15_29:int poblacion_17_24:int poblacion_18_24:int share_15_24_total:dec",
    "inei_demographic_indicators_region": "anio:int! region! tasa_bruta_natalidad:dec tasa_global_fecundidad:dec esperanza_vida_nacer:dec tasa_mortalidad_infantil:dec tasa_migracion_neta:dec tasa_crecimiento_total_pct:dec",
    "inei_pobreza_departamental": f"anio:int! region! pobreza_monetaria_pct:dec {SOURCE}",
    "inei_internet_acceso_region": f"anio:int! region! internet_acceso_pct:dec {SOURCE}",
}
ENROLLED = ("publica", "privada", "urbana", "rural", "masculino", "femenino")
ENROLLMENT = "anio:int! codigo_departamento! region! region_normalizada! nivel_educativo! grado! grado_orden:int! matricula_total:int! " + " ".join([f"matricula_{p}:int" for p in ENROLLED] + [f"{p}_pct:dec" for p in ENROLLED])


def canonical_triple(name: str) -> str:
    return f"{name}_canonical {name}_canonical_match_method {name}_canonical_review_required:bool"


def report_period(name: str) -> str:
    """The period field that a report starts with."""
    if name.endswith("_2025"):
        return "ano_encuesta:int!"
    return "periodo!" if name.endswith(("_acumulada", "primera_generacion_region")) else "ano_convocatoria:int!"


def _silver() -> dict[str, list[dict]]:
    out = {}
    for end, dims in BUDGET_DIMENSIONS.items():
        out[f"presupuesto_mef{end}"] = f"ano:int! {dims} {MONEY}"
        out[f"presupuesto_mef{end}_temporal"] = f"ano:int! {PERIOD} {dims if end else ''} devengado:dec"
    out["presupuesto_mef_hierarchy"] = f"ano:int! nivel_jerarquia! codigo_entidad nombre_entidad! {MONEY}"
    for name, own in REPORTS.items():
        out[f"pronabec_report_beca18_{name}"] = f"{report_period(name)} {own} {DOCUMENT}"
    out["pronabec_report_beca18_becas_otorgadas_modalidad_anual"] = f"modalidad! ano_convocatoria:int! becas_otorgadas:int {DOCUMENT}"
    for name, own in WIDE_REPORTS.items():
        out[f"pronabec_report_beca18_{name}"] = f"{own}! {canonical_triple(own)} ano_convocatoria:int! cantidad_becarios:int! es_anio_preliminar:bool! {DOCUMENT_OF_TABLE}"
    for name, own in OPEN_DATA.items():
        out[name] = " ".join(f"{w[:-1]} {canonical_triple(w[:-1])}" if w.endswith("=") else w for w in own.split())
    out |= REGIONAL | {"minedu_matricula_secundaria_departamental": ENROLLMENT}
    loose = TECHNICAL.replace("!", "")
    return {name: fields(f"{own} {loose if name in OPEN_DATA else TECHNICAL}") for name, own in out.items()}


SILVER = _silver()


def bronze(silver: str) -> list[dict]:
    """The raw contract behind a cleaned table: its own fields as nullable text, without canonical and technical ones."""
    technical = {f["name"] for f in fields(TECHNICAL)}
    return [{"name": f["name"], "type": "STRING", "mode": "NULLABLE"} for f in SILVER[silver] if f["name"] not in technical and "_canonical" not in f["name"]]
