"""The analytic tables by region and year: context, scores, coverage, clusters, forecast, allocation.

Each function gives one table in the columns of its contract, from cleaned tables and the analytic tables
before it. Rows of the cleaned tables are first joined to the dimension of regions and summed by year and
region; all that follows works on that small grid.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillon.operators.canonical import join_region
from quillon.plans.regional import COMBINED_WEIGHTS, PRIORITY_WEIGHTS, SCENARIOS, min_max, tier

Tables = dict[str, DataFrame]
GRAIN = ["anio", "region_canonical"]
# The years of the grid.
YEARS = (2012, 2025)
# Least completeness of each quality flag.
QUALITY = ((0.9, "complete"), (0.7, "usable"), (0.4, "partial"))
# Components of the first score, and what each is scaled from.
COMPONENTS = {"pobreza_score": "pobreza_monetaria_pct", "demanda_educativa_score": "matricula_5to_secundaria", "poblacion_joven_score": "poblacion_joven", "brecha_digital_score": "brecha_digital_pct", "ruralidad_score": "ruralidad_educativa_pct"}


def _ratio(n: Column, d: Column, times: float = 1.0) -> Column:
    return F.try_divide(n.cast("double"), F.nullif(d.cast("double"), F.lit(0.0))) * times


def year_region_grid(spark: SparkSession, dimension: DataFrame, years: tuple[int, int] = YEARS) -> DataFrame:
    """(anio, region_canonical): every year of the range for every region; as many rows as their product."""
    regions = dimension.select(F.col("region").alias("region_canonical")).distinct()
    return regions.withColumn("anio", F.explode(F.sequence(F.lit(years[0]).cast("bigint"), F.lit(years[1]).cast("bigint")))).select(*GRAIN)


def by_region(df: DataFrame, dimension: DataFrame, region: str = "region") -> DataFrame:
    """Rows with region_canonical in place of their spelling; unknown spellings go (see canonical.unknown_regions)."""
    return join_region(df, dimension, region).withColumnRenamed("canonical_region", "region_canonical")


def source_presence(sources: dict[str, DataFrame]) -> DataFrame:
    """(anio, region_canonical, source_group_count): how many groups of sources say something of a year and region."""
    rows = reduce(DataFrame.unionByName, [df.select(*GRAIN, F.lit(name).alias("source_group")) for name, df in sources.items()])
    return rows.groupBy(*GRAIN).agg(F.countDistinct("source_group").alias("source_group_count"))


def context_features(spark: SparkSession, t: Tables, dimension: DataFrame, created_at: Column, years: tuple[int, int] = YEARS) -> DataFrame:
    """The grid with what the sources say: counts are summed over merged regions, percentages are plain means."""
    poverty = by_region(t["inei_pobreza_departamental"], dimension)
    people = by_region(t["inei_population_youth_region"], dimension)
    internet = by_region(t["inei_internet_acceso_region"], dimension)
    pupils = t["minedu_matricula_secundaria_departamental"].where("upper(trim(grado)) = 'QUINTO_GRADO'").withColumn("region", F.coalesce("region_normalizada", "region"))
    pupils = by_region(pupils, dimension)
    mean = lambda df, value, kind: df.where(F.col(value).isNotNull()).groupBy(*GRAIN).agg(F.avg(F.col(value).cast("double")).alias(value), F.min("source_type").alias(kind))
    counted = ("poblacion_total", "poblacion_15_24", "poblacion_15_29")
    sums = people.where(" OR ".join(f"{c} IS NOT NULL" for c in counted)).groupBy(*GRAIN).agg(*[F.sum(c).alias(c) for c in counted])
    grade = pupils.groupBy(*GRAIN).agg(F.sum("matricula_total").alias("matricula_5to_secundaria"), *[F.sum(f"matricula_{x}").alias(f"matricula_5to_{x}") for x in ("publica", "privada", "urbana", "rural")], F.lit("official").alias("education_source_type"))
    present = source_presence({"poverty": poverty, "population": people, "internet": internet, "education": pupils})
    g = year_region_grid(spark, dimension, years)
    for part in (mean(poverty, "pobreza_monetaria_pct", "poverty_source_type"), sums, mean(internet, "internet_acceso_pct", "internet_source_type"), grade, present):
        g = g.join(part, GRAIN, "left")
    youth = F.coalesce("poblacion_15_29", "poblacion_15_24")
    told = [F.col("pobreza_monetaria_pct"), youth, F.col("matricula_5to_secundaria"), F.col("internet_acceso_pct"), F.col("poblacion_total")]
    complete = sum((c.isNotNull().cast("int") for c in told), F.lit(0)) / F.lit(5.0)
    flag = F.lit("insufficient")
    for least, name in reversed(QUALITY):
        flag = F.when(complete >= least, name).otherwise(flag)
    return g.select(
        "anio",
        F.col("region_canonical").alias("region"),
        "region_canonical",
        "pobreza_monetaria_pct",
        "poverty_source_type",
        *counted,
        F.when(F.col("poblacion_total") > 0, _ratio(youth, F.col("poblacion_total"), 100.0)).alias("poblacion_joven_pct"),
        *[f"matricula_5to_{x}" for x in ("secundaria", "publica", "privada", "urbana", "rural")],
        F.when(F.col("matricula_5to_secundaria") > 0, _ratio(F.col("matricula_5to_rural"), F.col("matricula_5to_secundaria"), 100.0)).alias("ruralidad_educativa_pct"),
        "education_source_type",
        "internet_acceso_pct",
        (100 - F.col("internet_acceso_pct")).alias("brecha_digital_pct"),
        "internet_source_type",
        complete.alias("feature_completeness_score"),
        flag.alias("feature_quality_flag"),
        F.lit(False).alias("has_synthetic_values"),
        F.lit(None).cast("string").alias("synthetic_fields"),
        F.when(F.coalesce("source_group_count", F.lit(0)) > 1, "mixed").otherwise("official").alias("source_priority"),
        created_at.alias("created_at"),
    )


def _weighted(weights: list[tuple[str, float]]) -> Column:
    """The mean of the components that aren't null, by their weights."""
    total = sum((F.lit(w) * F.coalesce(F.col(c), F.lit(0.0)) for c, w in weights), F.lit(0.0))
    present = sum((F.when(F.col(c).isNotNull(), F.lit(w)).otherwise(F.lit(0.0)) for c, w in weights), F.lit(0.0))
    return F.round(F.try_divide(total, F.nullif(present, F.lit(0.0))), 12)


def _rank(score: str) -> Column:
    return F.rank().over(Window.partitionBy("anio").orderBy(F.col(score).desc_nulls_last())).cast("bigint")


def priority_scores(context: DataFrame) -> DataFrame:
    """The first score: components scaled within the year, weighted, ranked and tiered."""
    x = context.withColumn("poblacion_joven", F.coalesce("poblacion_15_29", "poblacion_15_24"))
    x = x.withColumns({name: min_max(F.col(of).cast("double"), "anio") for name, of in COMPONENTS.items()})
    x = x.withColumn("priority_score", _weighted(list(zip(COMPONENTS, PRIORITY_WEIGHTS.values(), strict=True))))
    kept = "anio region region_canonical pobreza_monetaria_pct poblacion_15_24 poblacion_15_29 poblacion_joven_pct matricula_5to_secundaria ruralidad_educativa_pct internet_acceso_pct brecha_digital_pct pobreza_score demanda_educativa_score poblacion_joven_score ruralidad_score brecha_digital_score priority_score".split()
    labels = {"priority_rank": _rank("priority_score"), "priority_tier": tier(F.col("priority_score")), "score_version": F.lit("regional_context_v1"), "score_method": F.lit("weighted_minmax_context_score")}
    return x.select(*kept, *[c.alias(n) for n, c in labels.items()], "feature_completeness_score", "feature_quality_flag", "source_priority", "has_synthetic_values", "synthetic_fields", "created_at")


def auto_percent(c: Column) -> Column:
    """A share as a percentage, given as a ratio in [0, 1] or a percentage; a true share of up to 1 % is taken for a ratio."""
    return F.when((c >= 0) & (c <= 1), c * 100).otherwise(c)


def coverage_features(scores: DataFrame, t: Tables, dimension: DataFrame, created_at: Column) -> DataFrame:
    """Estimated grantees of each region and year, their rates, the gap they leave and where the figures come from.

    scores has the whole grid with what it needs of the context, so that the context isn't joined again.
    """
    report = "pronabec_report_beca18_"
    share = by_region(t[report + "region_postulacion_anual"].where("porcentaje_becarios IS NOT NULL"), dimension, "grupo_region")
    share = share.groupBy(F.col("ano_convocatoria").alias("anio"), "region_canonical").agg(F.avg(F.col("porcentaje_becarios").cast("double")).alias("s")).select(*GRAIN, auto_percent(F.col("s")).alias("regional_becarios_pct"))
    total = t[report + "becas_otorgadas_modalidad_anual"].where("becas_otorgadas IS NOT NULL").groupBy(F.col("ano_convocatoria").alias("anio")).agg(F.sum("becas_otorgadas").alias("total_becas_anual"))
    first = by_region(t[report + "primera_generacion_region"], dimension).groupBy("region_canonical").agg(F.avg(F.col("ratio_primera_generacion").cast("double")).alias("f"), F.sum("total_becarios_primera_generacion").alias("total_becarios_primera_generacion"), F.sum("total_becarios_encuestados").alias("total_becarios_encuestados"))
    first = first.withColumn("primera_generacion_ratio", F.when(F.col("f") > 1, F.col("f") / 100).otherwise(F.col("f"))).drop("f")  # a snapshot that holds for every year
    own = ("anio", "region", "region_canonical", "pobreza_monetaria_pct", "poblacion_15_24", "poblacion_15_29", "matricula_5to_secundaria", "ruralidad_educativa_pct", "internet_acceso_pct", "brecha_digital_pct")
    base = scores.select(*own, *[F.col(f"priority_{x}").alias(f"context_priority_{x}") for x in ("score", "rank", "tier")])
    x = base.join(share, GRAIN, "left").join(total, "anio", "left").join(first, "region_canonical", "left")
    grants = F.round(F.col("total_becas_anual") * F.col("regional_becarios_pct") / 100).cast("bigint")
    x = x.withColumn("regional_becarios_estimated", grants)
    enrolled, g, f = F.col("matricula_5to_secundaria"), F.col("regional_becarios_estimated"), F.col("primera_generacion_ratio")
    x = x.withColumns(
        {
            "becas_por_1000_jovenes": _ratio(g, F.coalesce("poblacion_15_29", "poblacion_15_24"), 1000.0),
            "becas_por_1000_matriculados_5to": _ratio(g, enrolled, 1000.0),
            "demanda_no_cubierta_estimada": F.when(enrolled.isNotNull() & g.isNotNull(), F.greatest(enrolled - g, F.lit(0).cast("bigint"))),
        }
    )
    rate = F.col("becas_por_1000_matriculados_5to")
    by_share, by_first = "regional_share_estimated_from_total_becas_anual", "first_generation_snapshot_applied_to_context_years"
    case = lambda both, one, other, none: F.when(g.isNotNull() & f.isNotNull(), both).when(g.isNotNull(), one).when(f.isNotNull(), other).otherwise(none)
    made = {
        "coverage_gap_score": F.when(rate.isNotNull(), 1 - F.coalesce(min_max(rate, "anio"), F.lit(0.0))),
        "primera_generacion_score": min_max(f, "anio"),
        "coverage_data_quality_flag": F.when(g.isNotNull() & rate.isNotNull() & f.isNotNull(), "complete").when(g.isNotNull() & rate.isNotNull(), "usable").when(g.isNotNull() | f.isNotNull(), "partial").otherwise("insufficient"),
        "coverage_source_method": case("mixed", "estimated_from_regional_share", "first_generation_snapshot_only", "unavailable"),
        "coverage_source_notes": case(f"{by_share}; {by_first}", by_share, by_first, "coverage_signals_not_available"),
        "has_estimated_coverage": F.when(g.isNotNull(), True).when(f.isNotNull(), False),
    }
    kept = [*base.columns, "regional_becarios_pct", "regional_becarios_estimated", "total_becas_anual", "primera_generacion_ratio", "total_becarios_primera_generacion", "total_becarios_encuestados", "becas_por_1000_jovenes", "becas_por_1000_matriculados_5to", "demanda_no_cubierta_estimada"]
    return x.select(*kept, *[c.alias(n) for n, c in made.items()], created_at.alias("created_at"))


def priority_scores_v2(coverage: DataFrame) -> DataFrame:
    """The second score: context, coverage gap and first generation, weighted, ranked and tiered."""
    weights = list(zip(("context_priority_score", "coverage_gap_score", "primera_generacion_score"), COMBINED_WEIGHTS.values(), strict=True))
    x = coverage.withColumn("priority_score_v2", _weighted(weights))
    labels = {"priority_rank_v2": _rank("priority_score_v2"), "priority_tier_v2": tier(F.col("priority_score_v2"))}
    constant = {"score_version": F.lit("regional_context_coverage_v2"), "score_method": F.lit("weighted_available_components")}
    kept = ["context_priority_rank", "context_priority_tier", "coverage_data_quality_flag", "coverage_source_method", "coverage_source_notes", "has_estimated_coverage"]
    return x.select("anio", "region", "region_canonical", *[c for c, _ in weights], "priority_score_v2", *[c.alias(n) for n, c in labels.items()], *kept, *[c.alias(n) for n, c in constant.items()], "created_at")


# Name, type and description of each scenario.
SCENARIO_TEXTS = {
    "base_priority": ("Base score v2", "base", "Escenario base que distribuye presupuesto segun el score regional v2 balanceado."),
    "budget_plus_10": ("Presupuesto +10%", "budget_increase", "Escenario que mantiene el ranking por score v2 y simula un incremento presupuestal de 10%."),
    "budget_plus_20": ("Presupuesto +20%", "budget_increase", "Escenario que mantiene el ranking por score v2 y simula un incremento presupuestal de 20%."),
    "budget_minus_10": ("Presupuesto -10%", "budget_decrease", "Escenario que mantiene el ranking por score v2 y simula una reduccion presupuestal de 10%."),
    "poverty_focus": ("Enfoque pobreza", "equity", "Escenario de equidad que prioriza pobreza y mantiene demanda, poblacion joven, primera generacion y cobertura como senales complementarias."),
    "demand_population_focus": ("Enfoque demanda y poblacion joven", "demand", "Escenario que prioriza demanda educativa y poblacion joven con senales sociales complementarias."),
    "first_generation_focus": ("Enfoque primera generacion", "social_mobility", "Escenario de movilidad social que prioriza primera generacion universitaria con pobreza y demanda como soporte."),
    "balanced_equity_demand": ("Balance equidad-demanda", "balanced", "Escenario balanceado de equidad territorial y demanda educativa con cobertura en peso no dominante."),
}
SCENARIO_VERSION = "regional_allocation_scenarios_v1"
ALLOCATION_NOTES = "Simulacion prescriptiva basada en scores regionales; no es asignacion oficial, prediccion individual ni inferencia causal."
SCENARIO_WEIGHTS = ("poverty_weight", "demand_weight", "population_weight", "coverage_weight", "first_generation_weight")


def budget_scenarios(spark: SparkSession, created_at: Column) -> DataFrame:
    """The catalogue of scenarios."""
    rows = [(s[0], *SCENARIO_TEXTS[s[0]][:2], s[1], *s[2:], 1.0 if s[1] == "priority_score_v2" else 0.0, SCENARIO_TEXTS[s[0]][2], SCENARIO_VERSION) for s in SCENARIOS]
    names = ["scenario_id", "scenario_name", "scenario_type", "allocation_method", "budget_multiplier", "scholarship_multiplier", *SCENARIO_WEIGHTS, "balanced_priority_weight", "scenario_description", "scenario_version"]
    df = spark.createDataFrame(rows, ", ".join(f"{n} {'double' if n.endswith(('multiplier', 'weight')) else 'string'}" for n in names))
    return df.withColumn("created_at", created_at)


def latest_unit_cost(yearly: DataFrame) -> Column | DataFrame:
    """(unit_cost): the budget for each grant of the latest year that has both, from (ano, becas, devengado)."""
    cost = _ratio(F.col("devengado"), F.col("becas"))
    return yearly.withColumn("cost", cost).where("cost > 0").agg(F.max_by("cost", "ano").alias("unit_cost"))


def allocation_scenarios(context_scores: DataFrame, v2: DataFrame, scenarios: DataFrame, forecast: DataFrame, unit_cost: DataFrame, created_at: Column) -> DataFrame:
    """Every scenario's share of the forecast budget for every region and year.

    A scenario's score is the second score or the weighted sum of the components; the weight is its share of
    the year. Ties rank by name. The multiplier acts on the budget and again on the grants.
    """
    parts = {"poverty_score": "pobreza_score", "demand_score": "demanda_educativa_score", "population_score": "poblacion_joven_score", "digital_gap_score": "brecha_digital_score", "rurality_score": "ruralidad_score"}
    x = v2.join(context_scores.select(*GRAIN, *[F.col(of).alias(n) for n, of in parts.items()]), GRAIN, "left")
    money = F.broadcast(forecast.agg(F.sum("forecast_value").alias("reference_forecast_budget_amount")))  # one row
    x = x.join(F.broadcast(scenarios.drop("created_at"))).join(money).join(F.broadcast(unit_cost))  # a row a scenario; one row
    factors = ("poverty_score", "demand_score", "population_score", "coverage_gap_score", "primera_generacion_score")
    mixed = sum((F.col(w) * F.coalesce(F.col(c), F.lit(0.0)) for w, c in zip(SCENARIO_WEIGHTS, factors, strict=True)), F.lit(0.0))
    raw = F.round(F.when(F.col("allocation_method") == "priority_score_v2", F.coalesce("priority_score_v2", F.lit(0.0))).otherwise(mixed), 12)
    group = Window.partitionBy("anio", "scenario_id")
    x = x.withColumn("scenario_raw_score", raw)
    x = x.withColumn("allocation_weight", F.try_divide(F.col("scenario_raw_score"), F.nullif(F.sum("scenario_raw_score").over(group), F.lit(0.0))))
    x = x.withColumn("scenario_rank", F.rank().over(group.orderBy(F.desc("scenario_raw_score"), "region_canonical")).cast("bigint"))
    x = x.withColumn("scenario_budget_amount", F.col("reference_forecast_budget_amount") * F.col("budget_multiplier"))
    x = x.withColumn("estimated_budget_amount", F.col("scenario_budget_amount") * F.col("allocation_weight"))
    kept = ["scenario_id", "scenario_name", "scenario_type", "allocation_method", "budget_multiplier", "scholarship_multiplier", "priority_score_v2", "context_priority_score", "coverage_gap_score", "primera_generacion_score", *parts, "scenario_raw_score", "allocation_weight"]
    return x.select(
        "anio",
        "region",
        "region_canonical",
        *kept,
        (F.col("allocation_weight") * 100).alias("allocation_pct"),
        "scenario_rank",
        F.col("priority_rank_v2").alias("baseline_rank_v2"),
        (F.col("priority_rank_v2") - F.col("scenario_rank")).alias("rank_change_vs_v2"),
        "reference_forecast_budget_amount",
        "scenario_budget_amount",
        "estimated_budget_amount",
        (F.try_divide("estimated_budget_amount", F.nullif("unit_cost", F.lit(0.0))) * F.col("scholarship_multiplier")).alias("estimated_scholarships"),
        "scenario_version",
        F.lit(ALLOCATION_NOTES).alias("scenario_notes"),
        created_at.alias("created_at"),
    )


def build(spark: SparkSession, t: Tables, dimension: DataFrame, created_at: Column, folder: str, wanted: tuple[str, ...] = (), forecast: DataFrame | None = None, unit_cost: DataFrame | None = None) -> Tables:
    """The analytic tables in the order in which they need each other, each written once under a new folder and read back.

    What stands on a table reads its files, so no source is scanned again for a score of a score. wanted
    (all by default) ends the run after the last table named; forecast and unit_cost are what the
    allocation needs.
    """
    out: Tables = {}

    def read(name: str) -> DataFrame:
        return out[name]

    steps: dict[str, Callable[[], DataFrame]] = {
        "region_context_features": lambda: context_features(spark, t, dimension, created_at),
        "region_priority_scores": lambda: priority_scores(read("region_context_features")),
        "region_coverage_features": lambda: coverage_features(read("region_priority_scores"), t, dimension, created_at),
        "region_priority_scores_v2": lambda: priority_scores_v2(read("region_coverage_features")),
        "budget_scenarios": lambda: budget_scenarios(spark, created_at),
        "region_allocation_scenarios": lambda: allocation_scenarios(read("region_priority_scores"), read("region_priority_scores_v2"), read("budget_scenarios"), forecast, unit_cost, created_at),
    }
    names = list(steps)
    last = max((names.index(n) for n in wanted if n in steps), default=len(names) - 1)
    for name in names[: last + 1]:
        df = steps[name]()
        df.write.parquet(f"{folder}/{name}")
        out[name] = spark.read.schema(df.schema).parquet(f"{folder}/{name}")
    return out


# The features that regions are clustered by.
CLUSTER_FEATURES = ("context_priority_score", "coverage_gap_score", "primera_generacion_score", "pobreza_monetaria_pct", "matricula_5to_secundaria", "poblacion_15_29", "brecha_digital_pct", "ruralidad_educativa_pct", "primera_generacion_ratio", "becas_por_1000_jovenes", "becas_por_1000_matriculados_5to")


def cluster_assignments(coverage: DataFrame, v2: DataFrame, years: tuple[int, int] = YEARS, k: int = 4, seed: int = 7) -> DataFrame:
    """Each region and year with the nearest of k centroids of the standardised features, and its distance to it.

    Rows without a context score are left out and nulls count as 0. Centroids are numbered from 1 in the
    order of their coordinates, so that numbers don't hang on the start.
    """
    from pyspark.ml import Pipeline
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.feature import StandardScaler, VectorAssembler
    from pyspark.ml.functions import vector_to_array

    names = list(CLUSTER_FEATURES)
    x = coverage.where(F.col("anio").between(*years) & F.col("context_priority_score").isNotNull()).select("anio", "region", "region_canonical", *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in names], "created_at")
    model = Pipeline(stages=[VectorAssembler(inputCols=names, outputCol="v"), StandardScaler(inputCol="v", outputCol="x", withMean=True), KMeans(featuresCol="x", predictionCol="c", k=k, seed=seed)]).fit(x)
    centers = model.stages[2].clusterCenters()
    order = sorted(range(len(centers)), key=lambda i: tuple(centers[i]))
    number = F.element_at(F.create_map(*[F.lit(v) for n, i in enumerate(order, 1) for v in (i, n)]), F.col("c")).cast("bigint")
    # every centroid with its distance, of which the one assigned is picked
    away = F.array(*[F.struct(F.lit(n).cast("bigint").alias("centroid_id"), F.sqrt(F.aggregate(F.zip_with(vector_to_array("x"), F.array(*[F.lit(float(v)) for v in centers[i]]), lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, d: s + d)).alias("distance")) for n, i in enumerate(order, 1)])
    y = model.transform(x).withColumn("centroid_id", number).withColumn("away", away)
    y = y.withColumn("centroid_distance", F.get(F.filter("away", lambda a: a["centroid_id"] == F.col("centroid_id")), F.lit(0))["distance"])
    y = y.join(v2.select(*GRAIN, "priority_score_v2"), GRAIN, "left")
    whole = {"matricula_5to_secundaria", "poblacion_15_29"}
    return y.select("anio", "region", "region_canonical", "priority_score_v2", *[F.col(c).cast("bigint" if c in whole else "double").alias(c) for c in names], "centroid_id", "centroid_distance", F.concat(F.lit("Cluster "), F.col("centroid_id").cast("string")).alias("cluster_label"), "created_at")


# What a cluster's profile averages.
PROFILED = ("priority_score_v2", "context_priority_score", "coverage_gap_score", "primera_generacion_score", "pobreza_monetaria_pct", "matricula_5to_secundaria", "brecha_digital_pct", "ruralidad_educativa_pct")


def cluster_profiles(assigned: DataFrame, created_at: Column) -> DataFrame:
    """Each cluster's number of regions and the means of its features."""
    return assigned.groupBy("centroid_id", "cluster_label").agg(F.countDistinct("region_canonical").alias("regiones_count"), *[F.avg(F.col(c).cast("double")).alias(f"avg_{c}") for c in PROFILED]).withColumn("created_at", created_at)


def budget_forecast(monthly: DataFrame, horizon: int = 12, z: float = 1.2815515655446004) -> DataFrame:
    """The next months of each series, in the contract's columns, with an interval of 80 % (z standard errors of the residuals).

    monthly has (month date, value double) and may have series, a key that is forecast by itself: a linear
    trend and additive effects of the months, all series in the same few grouped jobs.
    """
    keys = [c for c in ("series",) if c in monthly.columns]
    x = monthly.withColumn("t", (F.year("month") * 12 + F.month("month") - 1).cast("bigint")).withColumn("value", F.col("value").cast("double"))
    grouped = lambda df, *more: df.groupBy(*keys, *more)
    fit = grouped(x).agg(F.regr_slope("value", "t").alias("slope"), F.regr_intercept("value", "t").alias("base"), F.max("t").alias("last"), F.count("*").alias("n"))
    trend = F.col("base") + F.col("slope") * F.col("t")
    y = (x.join(fit, keys) if keys else x.join(F.broadcast(fit))).withColumn("off", F.col("value") - trend).withColumn("m", F.pmod("t", F.lit(12)))
    season = grouped(y, "m").agg(F.avg("off").alias("effect"))
    spread = grouped(y.join(season, [*keys, "m"])).agg(F.coalesce(F.stddev_samp(F.col("off") - F.col("effect")), F.lit(0.0)).alias("sigma"))
    ahead = (fit.join(spread, keys) if keys else fit.join(F.broadcast(spread))).withColumn("t", F.explode(F.sequence(F.col("last") + 1, F.col("last") + horizon))).withColumn("m", F.pmod("t", F.lit(12)))
    out = ahead.join(season, [*keys, "m"], "left").withColumn("forecast_value", trend + F.coalesce("effect", F.lit(0.0)))
    stamp = F.make_date(F.floor(F.col("t") / 12).cast("int"), (F.col("t") % 12 + 1).cast("int"), F.lit(1)).cast("timestamp_ntz")
    return out.select(
        *keys,
        stamp.alias("forecast_timestamp"),
        "forecast_value",
        (F.col("forecast_value") - z * F.col("sigma")).alias("prediction_interval_lower_bound"),
        (F.col("forecast_value") + z * F.col("sigma")).alias("prediction_interval_upper_bound"),
        F.lit(0.8).alias("confidence_level"),
        F.lit(horizon).cast("bigint").alias("forecast_horizon_months"),
        F.lit("seasonal_trend").alias("model_name"),
        F.lit("budget_forecast_trend_v1").alias("forecast_version"),
    )
