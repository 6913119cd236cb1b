"""Cleaned tables from raw ones: declarative specs, one projection a table, and quarantine of rows that break a rule.

A spec names each field's source and how its text is read. Rows are never tested one by one in Python:
each rule is a column that gives its message, the first message that a row gets is its reason for
quarantine, and rows without one are valid.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from quillon.functions import dates, numbers, text
from quillon.functions.bind import let
from quillon.functions.headers import is_total_header, tolerant_key, year_of
from quillon.operators import canonical, quarantine
from quillon.sources import contracts, tables

TECHNICAL = tuple(f["name"] for f in tables.fields(tables.TECHNICAL))
ERROR = "_error"

_BUDGET = {"int": numbers.budget_int, "numeric": numbers.budget_numeric, "percent": numbers.budget_percent, "text": text.clean_basic}
_OPEN = {"int": numbers.int_safe, "numeric": numbers.numeric_safe, "percent": numbers.numeric_safe, "text": text.clean_display, "date": dates.snapshot_date}
_REPORT = {"int": numbers.report_int, "numeric": numbers.report_numeric, "percent": numbers.report_percent, "text": text.clean_display}
_REGIONAL = {"int": numbers.int_safe, "numeric": numbers.numeric_safe, "percent": numbers.numeric_safe, "text": text.clean_basic}


@dataclass(frozen=True)
class Context:
    """What a run stamps on its rows."""

    extraction_date: str
    pipeline_run_id: str
    ingestion_timestamp: str


@dataclass(frozen=True)
class Spec:
    """How one raw dataset becomes a cleaned table.

    aliases: the raw names of a field, of which the first that is present counts, even if it is blank;
    tolerant: headers are matched without case, blanks and stop words; canonical: field -> domain of
    the catalogue; rules: checks that give (condition of failing, message) from the raw and the read
    column of each field; derived: fields computed from others; keep: rows that stay.
    """

    dataset: str
    target: str
    system: str
    dialect: dict[str, Callable[[Column], Column]]
    aliases: dict[str, tuple[str, ...]] = field(default_factory=dict)
    tolerant: bool = False
    canonical: dict[str, str] = field(default_factory=dict)
    rules: Callable[[Callable[[str], Column], Callable[[str], Column]], list[tuple[Column, Column | str]]] | None = None
    derived: dict[str, Callable[[Callable[[str], Column]], Column]] = field(default_factory=dict)
    keep: Callable[[Callable[[str], Column]], Column] | None = None
    wide: str | None = None  # the dimension of a table with a column a year

    @property
    def contract(self) -> list[dict]:
        return tables.SILVER[self.target]


def technical(df: DataFrame, system: str, dataset: str, context: Context) -> DataFrame:
    """df with the technical fields, in place of any that it has."""
    return df.withColumns(
        {
            "source_system": F.lit(system),
            "source_dataset": F.lit(dataset),
            "extraction_date": F.lit(context.extraction_date).cast("date"),
            "ingestion_timestamp": F.lit(context.ingestion_timestamp).cast("timestamp"),
            "pipeline_run_id": F.lit(context.pipeline_run_id),
        }
    )


class _Finder:
    """The raw column of a field; null text where no name of it is present."""

    def __init__(self, df: DataFrame, spec: Spec):
        self.spec, self.by_key = spec, {}
        for c in df.columns:
            self.by_key.setdefault(tolerant_key(c) if spec.tolerant else c, c)

    def column(self, name: str) -> str | None:
        for alias in (*self.spec.aliases.get(name, ()), name):
            key = tolerant_key(alias) if self.spec.tolerant else alias
            if key in self.by_key:
                return self.by_key[key]
        return None

    def __call__(self, name: str) -> Column:
        found = self.column(name)
        return F.col(f"`{found}`").cast("string") if found else F.lit(None).cast("string")


CELLS = "_cells"


def _text_columns(df: DataFrame) -> list[str]:
    """All columns but those of years and totals."""
    return [c for c in df.columns if c != CELLS and not (year_of(c) or is_total_header(c))]


def with_clean_cells(df: DataFrame) -> DataFrame:
    """df with its text columns as one array of cleaned cells: one expression, however many columns there are."""
    cells = [F.col(f"`{c}`").cast("string") for c in _text_columns(df)]
    return df.withColumn(CELLS, F.transform(F.array(*cells), text.clean_display) if cells else F.array().cast("array<string>"))


def is_total_row() -> Column:
    """Whether any cleaned cell says TOTAL or TOTAL GENERAL."""
    return F.coalesce(F.exists(CELLS, lambda c: F.upper(c).isin("TOTAL", "TOTAL GENERAL")), F.lit(False))


def unpivot_years(df: DataFrame, keep: list[str], value: str) -> DataFrame:
    """(keep..., ano_convocatoria, value, es_anio_preliminar): one row for each year column, its cell as text, blank ones included; total columns are skipped."""
    found = [(c, year_of(c)) for c in df.columns]
    cells = [F.struct(F.lit(y[0]).cast("bigint").alias("ano_convocatoria"), F.col(f"`{c}`").cast("string").alias(value), F.lit(y[1]).alias("es_anio_preliminar")) for c, y in found if y]
    if not cells:
        raise ValueError("no column of a year")
    return df.select(*[F.col(f"`{c}`") for c in keep], F.explode(F.array(*cells)).alias("y")).select(*[F.col(f"`{c}`") for c in keep], "y.*")


def read_fields(df: DataFrame, spec: Spec, context: Context, catalog: DataFrame | None = None) -> DataFrame:
    """The contract's fields, and the first rule that each row breaks in ERROR."""
    zero_dash = False
    places: dict[str, int] = {}
    if spec.tolerant:
        df = with_clean_cells(df).where(~is_total_row())
        places = {c: i for i, c in enumerate(_text_columns(df))}
    if spec.wide:
        df = unpivot_years(df, [*_text_columns(df), CELLS], "cantidad_becarios")
        zero_dash = True
    find = _Finder(df.drop(CELLS), spec)
    kinds = contracts.kinds(spec.contract)
    own = [f["name"] for f in spec.contract if f["name"] not in TECHNICAL and "_canonical" not in f["name"]]

    def read(name: str) -> Column:
        if name in spec.derived:
            return spec.derived[name](read)
        if spec.wide and name == "cantidad_becarios":
            return numbers.report_int(find(name), zero_dash=zero_dash)
        if name == "es_anio_preliminar":
            return F.col(name)
        how = spec.dialect[kinds[name]]
        if how is text.clean_display and find.column(name) in places:
            return F.get(CELLS, F.lit(places[find.column(name)]))
        return how(find(name))

    raw = [find(n).alias(f"_raw_{n}") for n in own] if spec.rules else []
    out = df.select(F.struct(*[F.col(f"`{c}`").cast("string").alias(c) for c in df.columns if c != CELLS]).alias("_record"), *raw, *[read(n).alias(n) for n in own])
    if spec.keep:
        out = out.where(spec.keep(F.col))
    message = F.lit(None).cast("string")
    if spec.rules:
        for condition, said in reversed(spec.rules(lambda n: F.col(f"_raw_{n}"), F.col)):
            message = F.when(condition, said if isinstance(said, Column) else F.lit(said)).otherwise(message)
    out = out.withColumn(ERROR, message).select("_record", *own, ERROR)
    if spec.canonical:
        index = canonical.checked_index(catalog) if catalog is not None else None
        for name, domain in spec.canonical.items():
            if index is None:
                out = out.withColumns({f"{name}_canonical": F.lit(None).cast("string"), f"{name}_canonical_match_method": F.lit(None).cast("string"), f"{name}_canonical_review_required": F.lit(None).cast("boolean")})
            else:
                out = canonical.apply_canonical(out, index, {name: domain})
    return technical(out, spec.system, spec.dataset, context)


def transform(df: DataFrame, spec: Spec, context: Context, catalog: DataFrame | None = None) -> DataFrame:
    """The cleaned table of the rows that break no rule, in the contract's order and types."""
    return contracts.project(read_fields(df, spec, context, catalog).where(F.col(ERROR).isNull()), spec.contract)


def judge(df: DataFrame, system: str, dataset: str, context: Context, catalog: DataFrame | None = None) -> DataFrame:
    """(kind, valid, reject) of each raw row that its spec keeps: kind is `valid` or `rejected`, the other struct is null.

    Rejects are of stage transform with TRANSFORM_ERROR for the first rule broken, INVALID_RECORD for
    rows of which nothing could be read, and of stage validation with SCHEMA_MISMATCH where a table has
    columns that its contract doesn't know (a fact of the whole table; quarantine.unknown_keys judges record by record). Rows that a spec leaves out,
    such as totals, are neither. A system that has no specs gets the technical fields alone.
    """
    spec = find_spec(system, dataset)
    if spec is None:
        rows = technical(df, system, dataset, context)
        return rows.select(F.lit("valid").alias("kind"), F.struct(*[F.col(f"`{c}`") for c in rows.columns]).alias("valid"), F.lit(None).cast(_REJECT).alias("reject"))
    rows = read_fields(df, spec, context, catalog)
    names = [f["name"] for f in spec.contract]
    own = [n for n in names if n not in TECHNICAL and n != "es_anio_preliminar"]
    empty = F.lit(True)
    for n in own:
        empty &= F.col(n).isNull()
    reason = F.when(F.col(ERROR).isNotNull(), "TRANSFORM_ERROR").when(empty, "INVALID_RECORD")
    message = F.coalesce(F.col(ERROR), F.when(empty, F.lit("nothing could be read from the record")))
    unknown = contracts.unexpected_columns(rows.drop("_record", ERROR), spec.contract)
    stage = F.lit("transform")
    if unknown:
        reason, message, stage = F.coalesce(reason, F.lit("SCHEMA_MISMATCH")), F.coalesce(message, F.lit(f"columns that the contract doesn't have: {sorted(unknown)}")), F.when(reason.isNull(), "validation").otherwise("transform")
    judged = rows.withColumns({"_reason": reason, "_message": message, "_stage": stage})
    partial = F.when(F.col("_reason") == "SCHEMA_MISMATCH", F.to_json(F.struct(*[F.col(n) for n in names if n in rows.columns])))
    keys = {**{t: F.col(t) for t in TECHNICAL}, "processing_stage": F.col("_stage"), "error_code": F.col("_reason"), "error_message": F.col("_message"), "raw_record": F.to_json("_record"), "failed_field": F.lit(sorted(unknown)[0] if unknown else None).cast("string"), "partial_record": partial}
    good = F.col("_reason").isNull()
    valid = F.struct(*[(F.col(f.name) if f.name in judged.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in contracts.to_schema(spec.contract)])
    reject = F.struct(*[c.alias(n) for n, c in keys.items()]).cast(_REJECT)
    return judged.select(F.when(good, "valid").otherwise("rejected").alias("kind"), F.when(good, valid).alias("valid"), F.when(~good, reject).alias("reject"))


_REJECT = "struct<" + ",".join([*(f"{f.name}:{f.dataType.simpleString()}" for f in contracts.to_schema(tables.fields(tables.TECHNICAL))), *(f"{n}:string" for n in ("processing_stage", "error_code", "error_message", "raw_record", "failed_field", "partial_record"))]) + ">"


def process(df: DataFrame, system: str, dataset: str, context: Context, catalog: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(valid rows, rejects) of a raw dataset, as judge() tells them; each is a plan of its own over the raw rows. run() reads these once."""
    judged = judge(df, system, dataset, context, catalog)
    return judged.where("kind = 'valid'").select("valid.*"), judged.where("kind = 'rejected'").select("reject.*")


@dataclass(frozen=True)
class Run:
    """What run() wrote, read back, and its counts (records_read, records_valid, records_rejected)."""

    valid: DataFrame
    rejects: DataFrame
    counts: dict[str, int]

    def summary(self) -> DataFrame:
        """As summary(), without reading anything again."""
        c = self.counts
        spark = self.valid.sparkSession
        out = quarantine.summary(spark, spark.createDataFrame([tuple(c.values())], ", ".join(f"{k} long" for k in c)))
        return out.withColumn("records_dropped", F.greatest(F.col("records_read") - F.col("records_valid") - F.col("records_rejected"), F.lit(0)))


def run(df: DataFrame, system: str, dataset: str, context: Context, folder: str, catalog: DataFrame | None = None) -> Run:
    """Judges the raw rows in one scan, writes them by kind under a new folder, and counts while the write runs.

    The counts are observed on the rows that pass: on the raw ones before the spec, and on the judged
    ones by kind. No row is read twice for a count, and both tables are read back from what was written.
    """
    read, judged = Observation("records_read"), Observation("records_judged")
    rows = judge(df.observe(read, F.count(F.lit(1)).alias("records_read")), system, dataset, context, catalog)
    kind = F.col("kind")
    rows = rows.observe(judged, F.count_if(kind == "valid").alias("records_valid"), F.count_if(kind == "rejected").alias("records_rejected"))
    rows.write.partitionBy("kind").parquet(folder)
    back = df.sparkSession.read.schema(rows.schema).parquet(folder)
    return Run(back.where("kind = 'valid'").select("valid.*"), back.where("kind = 'rejected'").select("reject.*"), read.get | judged.get)


def summary(read: DataFrame, valid: DataFrame, rejects: DataFrame) -> DataFrame:
    """One row: records read, valid, rejected and dropped, rejection_rate and status.

    dropped counts the rows that are neither valid nor rejected; where a row gives several, it is 0 at least.
    """
    one = lambda df, name: df.agg(F.count("*").alias(name)).withColumn("_one", F.lit(1))
    counts = one(read, "records_read").join(one(valid, "records_valid"), "_one").join(one(rejects, "records_rejected"), "_one").drop("_one")
    out = quarantine.summary(read.sparkSession, counts)
    return out.withColumn("records_dropped", F.greatest(F.col("records_read") - F.col("records_valid") - F.col("records_rejected"), F.lit(0)))


# --- specs ----------------------------------------------------------------------------------------

# Raw names of budget fields.
_BUDGET_ALIASES = {
    "presupuesto": {"codigo_entidad": ("ejecutora_codigo",), "nombre_entidad": ("ejecutora_nombre",)},
    "presupuesto_hierarchy": {"codigo_entidad": ("codigo", "ejecutora_codigo"), "nombre_entidad": ("descripcion", "ejecutora_nombre")},
}
_PRODUCT = {"producto": ("producto_proyecto", "producto_nombre")}
# Open-data datasets, their tables, raw names and domains of canonical values.
_OPEN_DATA = {
    "convocatorias": ("pronabec_convocatorias", {"descripcion_convocatoria": ("description_conv",)}, {"modalidad": "modalidad", "programa": "programa"}),
    "ubigeo_postulacion": ("pronabec_ubigeo_postulacion", {}, {"region": "region"}),
    "becarios_pais_estudio": ("pronabec_becarios_pais_estudio", {}, {"modalidad": "modalidad", "pais_estudio": "pais", "sexo": "sexo"}),
    "becarios_provincia": ("pronabec_beca18_becarios_provincia_2016", {"becarios_b18_count": ("b18_n",), "source_snapshot_date": ("fecha_carga",)}, {}),
    "colegios_habiles": ("pronabec_colegios_elegibles", {"tipo_gestion_colegio": ("tipo_gestion",)}, {n: n for n in ("ugel", "tipo_gestion_colegio", "nivel_modalidad", "forma_atencion")}),
}


def _province_detail(c: Callable[[str], Column]) -> Column:
    """Rows of a named region and province; totals go without a reject."""
    return c("region").isNotNull() & c("provincia").isNotNull() & ~F.upper(c("provincia")).startswith("TOTAL")


def _filled(raw: Column) -> Column:
    return text.clean_basic(raw).isNotNull()


def _between(value: Column, low: float, high: float) -> Column:
    return (value < low) | (value > high)


def _regional_rules(target: str, ints: tuple[str, ...] = (), decimals: tuple[str, ...] = (), percents: tuple[str, ...] = (), positive: tuple[str, ...] = ()):
    def rules(raw, read):
        out = [(read("anio").isNull(), "anio es obligatorio y debe ser numérico."), (read("region").isNull(), "region es obligatoria.")]
        for n in ints:
            out += [(_filled(raw(n)) & read(n).isNull(), f"{n} debe ser entero."), (read(n) < 0, f"{n} no puede ser negativo.")]
        for n in (*decimals, *percents):
            out.append((_filled(raw(n)) & read(n).isNull(), f"{n} debe ser numérico."))
        out += [(_between(read(n), 0, 100), f"{n} debe estar entre 0 y 100.") for n in percents]
        return out + [(read(n) <= 0, f"{n} debe ser mayor que 0.") for n in positive]

    return Spec(target, target, "INEI", _REGIONAL, rules=rules)


# Grades in their order.
GRADES = ("PRIMER_GRADO", "SEGUNDO_GRADO", "TERCER_GRADO", "CUARTO_GRADO", "QUINTO_GRADO")


def _enrollment() -> Spec:
    counts = ["matricula_total", *(f"matricula_{p}" for p in tables.ENROLLED)]

    def rules(raw, read):
        needed = lambda n: [(read(n).isNull(), f"{n} es obligatorio y debe ser entero."), (read(n) < 0, f"{n} no puede ser negativo.")]
        out = [*needed("anio"), (_between(read("anio"), 2012, 2025), "anio debe estar entre 2012 y 2025."), (read("codigo_departamento").isNull(), "codigo_departamento es obligatorio.")]
        out.append((~F.coalesce(read("grado").isin(*GRADES), F.lit(False)), F.concat(F.lit("grado invalido: "), F.coalesce(read("grado"), F.lit("None")))))
        out += [(~F.coalesce(read("nivel_educativo") == "SECUNDARIA", F.lit(False)), "nivel_educativo debe ser SECUNDARIA."), (read("region").isNull(), "region es obligatoria.")]
        for n in counts:
            out += needed(n)
        return out + [(_between(read(f"{p}_pct"), 0, 1), f"{p}_pct debe estar entre 0 y 1.") for p in tables.ENROLLED]

    derived: dict = {
        "region_normalizada": lambda read: text.region_name(read("region")),
        "grado_orden": lambda read: let(F.array_position(F.array(*map(F.lit, GRADES)), read("grado")), lambda i: F.when(i > 0, i.cast("bigint"))),
    }
    for p in tables.ENROLLED:
        derived[f"{p}_pct"] = lambda read, n=f"matricula_{p}": numbers.ratio9(read(n), read("matricula_total"))
    target = "minedu_matricula_secundaria_departamental"
    return Spec(target, target, "MINEDU_ESCALE", _REGIONAL, rules=rules, derived=derived)


def _specs() -> dict[tuple[str, str], Spec]:
    out = {}
    for target in tables.SILVER:
        if target.startswith("presupuesto_mef"):
            dataset = "presupuesto" + target.removeprefix("presupuesto_mef")
            aliases = _BUDGET_ALIASES.get(dataset, _PRODUCT if dataset.startswith("presupuesto_producto") else {})
            spec = Spec(dataset, target, "mef", _BUDGET, aliases)
            out["mef", dataset] = out["mef", target] = spec
        elif target.startswith("pronabec_report_"):
            name = target.removeprefix("pronabec_")
            wide = tables.WIDE_REPORTS.get(name.removeprefix("report_beca18_"))
            domains = {"carrera_estudio": {"carrera_estudio": "carrera"}, "universidad": {"universidad": "institucion"}}.get(wide, {})
            out["pronabec_reports", name] = Spec(name, target, "pronabec_reports", _REPORT, tolerant=True, canonical=domains, wide=wide)
    for dataset, (target, aliases, domains) in _OPEN_DATA.items():
        keep = _province_detail if dataset == "becarios_provincia" else None
        out["pronabec", dataset] = Spec(dataset, target, "PRONABEC" if keep else "pronabec", _OPEN, aliases, canonical=domains, keep=keep)
    people = tuple(f"poblacion_{x}" for x in ("total", "15_24", "15_29", "17_24", "18_24"))
    rates = tuple(f["name"] for f in tables.fields(tables.REGIONAL["inei_demographic_indicators_region"]) if f["type"] == "NUMERIC")
    regional = [
        _regional_rules("inei_population_youth_region", people, percents=("share_15_24_total",)),
        _regional_rules("inei_demographic_indicators_region", decimals=rates, positive=("esperanza_vida_nacer",)),
        _regional_rules("inei_pobreza_departamental", percents=("pobreza_monetaria_pct",)),
        _regional_rules("inei_internet_acceso_region", percents=("internet_acceso_pct",)),
    ]
    out |= {("inei_reports", s.dataset): s for s in regional}
    spec = _enrollment()
    out["minedu_escale", spec.dataset] = spec
    return out


SPECS = _specs()


def find_spec(system: str, dataset: str) -> Spec | None:
    """The spec of a dataset; None for a system that has none, an error for a dataset that its system doesn't have.

    A report that no spec knows is passed on with technical fields alone, as an unknown system's rows are.
    """
    found = SPECS.get((system, dataset))
    known = sorted(d for s, d in SPECS if s == system)
    if found is None and known and system != "pronabec_reports":
        raise ValueError(f"unsupported dataset of {system}: {dataset}; supported: {', '.join(known)}")
    return found


def long_internet(df: DataFrame) -> DataFrame:
    """Internet access with a column a year, as rows (anio, region, internet_acceso_pct, source fields); long input stays as it is.

    Blank cells give no row. The source fields have defaults where the input has none; the period is
    that of the year columns. A row without any value keeps one row with a null year, which the rules reject.
    """
    years = sorted(c for c in df.columns if c.isdigit())
    if "anio" in df.columns or "internet_acceso_pct" in df.columns:
        return df
    if not years:
        raise ValueError("neither anio and internet_acceso_pct nor columns of years")
    # Defaults of the source fields.
    defaults = {"source_name": "INEI", "source_period": f"{years[0]}-{years[-1]}", "source_type": "manual_csv", "metric": "internet_acceso_pct"}
    source = [F.coalesce(text.clean_basic(F.col(n)), F.lit(v)).alias(n) if n in df.columns else F.lit(v).alias(n) for n, v in defaults.items()]
    cells = F.filter(F.array(*[F.struct(F.lit(y).alias("anio"), F.col(f"`{y}`").cast("string").alias("internet_acceso_pct")) for y in years]), lambda x: text.clean_basic(x["internet_acceso_pct"]).isNotNull())
    return df.select("region", *source, F.explode_outer(cells).alias("y")).select("y.anio", "region", "y.internet_acceso_pct", *defaults)


# --- filters on raw rows ----------------------------------------------------------------------------


def year_between(df: DataFrame, column: str, first: int, last: int) -> DataFrame:
    """Rows whose column holds a four-digit year of the range; rows without one go."""
    year = F.regexp_extract(F.col(column).cast("string"), r"\d{4}", 0).try_cast("int")
    return df.where(year.between(first, last))


def any_contains(df: DataFrame, wanted: str) -> DataFrame:
    """Rows with the text in any column, whatever its case."""
    return df.where(F.contains(F.lower(F.concat_ws(" ", *[F.col(f"`{c}`").cast("string") for c in df.columns])), F.lit(wanted.lower())))
