"""Regional features, scores, coverage gaps, budget allocation, clusters and a monthly forecast."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Weights of the scores.
PRIORITY_WEIGHTS = {"poverty": 0.35, "demand": 0.25, "youth": 0.15, "digital": 0.15, "rurality": 0.10}
COMBINED_WEIGHTS = {"priority_score": 0.60, "gap_score": 0.30, "first_generation_score": 0.10}
# Least score of each tier.
TIERS = ((0.80, "Muy alta"), (0.60, "Alta"), (0.40, "Media"))
# Scenario, method, factors on budget and grants, weights of poverty, demand, population, coverage and first generation.
SCENARIOS = (
    ("base_priority", "priority_score_v2", 1.0, 1.0, 0.0, 0.0, 0.0, 0.0, 0.0),
    ("budget_plus_10", "priority_score_v2", 1.1, 1.1, 0.0, 0.0, 0.0, 0.0, 0.0),
    ("budget_plus_20", "priority_score_v2", 1.2, 1.2, 0.0, 0.0, 0.0, 0.0, 0.0),
    ("budget_minus_10", "priority_score_v2", 0.9, 0.9, 0.0, 0.0, 0.0, 0.0, 0.0),
    ("poverty_focus", "poverty_weighted", 1.0, 1.0, 0.60, 0.15, 0.10, 0.05, 0.10),
    ("demand_population_focus", "demand_population_weighted", 1.0, 1.0, 0.10, 0.45, 0.35, 0.05, 0.05),
    ("first_generation_focus", "first_generation_weighted", 1.0, 1.0, 0.25, 0.15, 0.05, 0.05, 0.50),
    ("balanced_equity_demand", "multi_factor_weighted", 1.0, 1.0, 0.30, 0.25, 0.15, 0.15, 0.15),
)
SCENARIO_SCHEMA = "scenario_id string, method string, budget_factor double, grants_factor double, w_poverty double, w_demand double, w_population double, w_coverage double, w_first double"


def min_max(c: Column, by: str) -> Column:
    """(x - min) / (max - min) within a period; 0 where all are equal, null for null."""
    w = Window.partitionBy(by)
    low, high = F.min(c).over(w), F.max(c).over(w)
    return F.when(c.isNotNull(), F.coalesce(F.try_divide((c - low).cast("double"), F.nullif((high - low).cast("double"), F.lit(0.0))), F.lit(0.0)))


def nano(c: Column) -> Column:
    """Whole billionths, half up even where the last bits fall just short of the half."""
    return F.floor(c * 1e9 + 0.5001).cast("bigint")


def weighted(weights: dict[str, float]) -> Column:
    """The weighted mean of the components that aren't null; null if all are."""
    total = sum((F.lit(w) * F.coalesce(F.col(c), F.lit(0.0)) for c, w in weights.items()), F.lit(0.0))
    present = sum((F.when(F.col(c).isNotNull(), F.lit(w)).otherwise(F.lit(0.0)) for c, w in weights.items()), F.lit(0.0))
    return nano(F.try_divide(total, F.nullif(present, F.lit(0.0)))) / F.lit(1e9)


def tier(score: Column) -> Column:
    out = F.when(score.isNull(), "Insuficiente")
    for least, name in TIERS:
        out = out.when(score >= least, name)
    return out.otherwise("Baja")


def ranked(score: str, by: str) -> Column:
    """Nulls rank last and share that rank."""
    return F.rank().over(Window.partitionBy(by).orderBy(F.col(score).desc_nulls_last())).cast("bigint")


def priority(context: DataFrame, by: str = "year") -> DataFrame:
    """Adds the min-max components, priority_score, tier and rank within the period."""
    scaled = context.select("region", by, *[min_max(F.col(c), by).alias(c) for c in PRIORITY_WEIGHTS])
    scored = scaled.withColumn("priority_score", weighted(PRIORITY_WEIGHTS))
    return scored.withColumn("tier", tier(F.col("priority_score"))).withColumn("priority_rank", ranked("priority_score", by))


def coverage(rows: DataFrame, by: str = "year") -> DataFrame:
    """(region, by, enrolled, grantees, uncovered, per_1000, gap_score, first_generation_score)."""
    rate = F.round(F.try_divide(1000.0 * F.col("grantees"), F.nullif(F.col("enrolled").cast("double"), F.lit(0.0))), 6)
    r = rows.withColumn("per_1000", rate)
    gap = F.when(F.col("per_1000").isNotNull(), 1 - F.coalesce(min_max(F.col("per_1000"), by), F.lit(0.0)))
    return r.select(
        "region",
        by,
        "enrolled",
        "grantees",
        F.greatest(F.col("enrolled") - F.col("grantees"), F.lit(0).cast("bigint")).alias("uncovered"),
        "per_1000",
        F.round(gap, 9).alias("gap_score"),
        F.round(min_max(F.col("first_generation"), by), 9).alias("first_generation_score"),
    )


def priority_v2(scored: DataFrame, covered: DataFrame, by: str = "year") -> DataFrame:
    """The score that joins context, coverage gap and first generation."""
    j = scored.select("region", by, "priority_score", "poverty", "demand", "youth").join(covered.select("region", by, "gap_score", "first_generation_score"), ["region", by], "left")
    j = j.withColumn("score_v2", weighted(COMBINED_WEIGHTS))
    return j.withColumn("tier_v2", tier(F.col("score_v2"))).withColumn("rank_v2", ranked("score_v2", by))


def scenarios(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(SCENARIOS), SCENARIO_SCHEMA)


def allocate(scored: DataFrame, plan: DataFrame, budget: DataFrame, by: str = "year") -> DataFrame:
    """Shares each period's budget(by, budget, unit_cost) among regions, for every scenario of the plan.

    The plan is a catalogue of a few rows, so each region row becomes as many rows as it has scenarios.
    """
    parts = (("w_poverty", "poverty"), ("w_demand", "demand"), ("w_population", "youth"), ("w_coverage", "gap_score"), ("w_first", "first_generation_score"))
    combined = sum((F.col(f"s.{w}") * F.coalesce(F.col(c), F.lit(0.0)) for w, c in parts), F.lit(0.0))
    rows = scored.join(F.broadcast(plan.select(F.struct(*plan.columns).alias("s")))).join(budget, by)
    rows = rows.withColumn("raw", nano(F.when(F.col("s.method") == "priority_score_v2", F.coalesce("score_v2", F.lit(0.0))).otherwise(combined)))
    rows = rows.withColumn("scenario_id", F.col("s.scenario_id"))
    group = Window.partitionBy(by, "scenario_id")
    total = F.sum("raw").over(group).cast("double")
    rows = rows.withColumn("weight", F.try_divide(F.col("raw").cast("double"), F.nullif(total, F.lit(0.0))))
    rows = rows.withColumn("scenario_rank", F.row_number().over(group.orderBy(F.desc("raw"), "region")).cast("bigint"))
    base = F.max(F.when(F.col("scenario_id") == "base_priority", F.col("scenario_rank"))).over(Window.partitionBy(by, "region"))
    amount = F.col("budget") * F.col("s.budget_factor") * F.col("weight")
    return rows.select(
        "scenario_id",
        "region",
        by,
        F.round("weight", 9).alias("weight"),
        "scenario_rank",
        (base - F.col("scenario_rank")).alias("rank_change"),
        # Half a cent goes up even where the last bits of the product fall just short of it.
        F.floor(amount * 100 + 0.500001).cast("bigint").alias("region_budget_cents"),
        F.round(F.try_divide(amount, F.nullif("unit_cost", F.lit(0.0))) * F.col("s.grants_factor"), 6).alias("grants"),
    )


def clusters(features: DataFrame, columns: list[str], k: int = 4, seed: int = 7) -> DataFrame:
    """Adds cluster (1 to k, by ascending centroid of the first feature) from standardised features; null counts as 0."""
    from pyspark.ml import Pipeline
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.feature import StandardScaler, VectorAssembler

    filled = features.select(*[c for c in features.columns if c not in columns], *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in columns])
    stages = [VectorAssembler(inputCols=columns, outputCol="_v"), StandardScaler(inputCol="_v", outputCol="_x", withMean=True), KMeans(featuresCol="_x", predictionCol="_c", k=k, seed=seed)]
    model = Pipeline(stages=stages).fit(filled)
    order = sorted(range(len(model.stages[2].clusterCenters())), key=lambda i: tuple(model.stages[2].clusterCenters()[i]))
    names = F.create_map(*[x for n, i in enumerate(order, 1) for x in (F.lit(i), F.lit(n))])
    return model.transform(filled).withColumn("cluster", F.element_at(names, F.col("_c"))).drop("_v", "_x", "_c")


def monthly_forecast(monthly: DataFrame, horizon: int = 12) -> DataFrame:
    """A linear trend on (t, value) with additive month effects, for the next months.

    monthly has (t long: months since a fixed one, value double). Rows: (t, forecast).
    """
    fit = monthly.agg(F.regr_slope("value", "t").alias("slope"), F.regr_intercept("value", "t").alias("base"), F.max("t").alias("last"))
    fit = F.broadcast(fit)  # one row
    season = monthly.join(fit).groupBy((F.col("t") % 12).alias("m")).agg(F.avg(F.col("value") - F.col("base") - F.col("slope") * F.col("t")).alias("effect"))
    ahead = fit.select("slope", "base", F.explode(F.sequence(F.col("last") + 1, F.col("last") + horizon)).alias("t"))
    return ahead.join(season, F.col("t") % 12 == F.col("m"), "left").select("t", F.round(F.col("base") + F.col("slope") * F.col("t") + F.coalesce("effect", F.lit(0.0)), 0).alias("forecast"))
