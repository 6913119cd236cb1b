"""Canonical values through a versioned alias catalogue."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillon.functions.text import match_key, region_key

METHODS = ("manual_alias", "safe_equivalent", "profile_candidate")
CONFIDENCES = ("high", "medium", "low")
FIELDS = ("domain", "canonical_value", "aliases", "normalized_key", "match_method", "confidence", "review_required")
SCHEMA = "domain string, canonical_value string, aliases array<string>, normalized_key string, match_method string, confidence string, review_required boolean"
#: A catalogue of at most so many keys is broadcast; a larger one is joined by a shuffle.
BROADCAST_KEYS = 100_000


def load_catalog(spark: SparkSession, mappings: dict[str, list[dict]]) -> DataFrame:
    """The catalogue as a table, after its contract is checked: fields, methods, confidences, aliases."""
    rows = []
    for domain, entries in mappings.items():
        for e in entries:
            if missing := [f for f in FIELDS[1:] if f not in e]:
                raise ValueError(f"{domain}: fields missing {missing}")
            if e["match_method"] not in METHODS or e["confidence"] not in CONFIDENCES:
                raise ValueError(f"{domain}: match_method or confidence not allowed in {e['canonical_value']}")
            if not e["aliases"]:
                raise ValueError(f"{domain}: no aliases of {e['canonical_value']}")
            rows.append((domain, *[e[f] for f in FIELDS[1:]]))
    return spark.createDataFrame(rows, SCHEMA)


def alias_index(catalog: DataFrame) -> DataFrame:
    """(domain, key, canonical_value, match_method, review_required), one row for each key."""
    spelled = F.array_compact(F.array_union(F.array_union("aliases", F.array("canonical_value")), F.array("normalized_key")))
    rows = catalog.select("domain", F.explode(spelled).alias("alias"), "canonical_value", "match_method", "review_required")
    rows = rows.select("domain", match_key(F.col("alias")).alias("key"), "canonical_value", "match_method", "review_required").where("key IS NOT NULL")
    return rows.groupBy("domain", "key").agg(F.min(F.struct("canonical_value", "match_method", "review_required")).alias("m")).select("domain", "key", "m.*")


def ambiguous_aliases(catalog: DataFrame) -> DataFrame:
    """(domain, key, canonicals) of keys that lead to several canonical values."""
    spelled = F.array_compact(F.array_union(F.array_union("aliases", F.array("canonical_value")), F.array("normalized_key")))
    rows = catalog.select("domain", F.explode(spelled).alias("alias"), "canonical_value").select("domain", match_key(F.col("alias")).alias("key"), "canonical_value")
    return rows.groupBy("domain", "key").agg(F.countDistinct("canonical_value").alias("canonicals")).where("canonicals > 1")


def checked_index(catalog: DataFrame) -> DataFrame:
    if bad := ambiguous_aliases(catalog).limit(5).collect():
        raise ValueError(f"ambiguous aliases: {[(r['domain'], r['key']) for r in bad]}")
    return alias_index(catalog)


def apply_canonical(df: DataFrame, index: DataFrame, fields: dict[str, str]) -> DataFrame:
    """Adds <field>_canonical, _canonical_match_method and _canonical_review_required for fields {column: domain}.

    Without a match, or for a domain the catalogue doesn't have, all three are null; no fuzzy matching.
    """
    small = index.limit(BROADCAST_KEYS + 1).count() <= BROADCAST_KEYS
    for column, domain in fields.items():
        part = index.where(F.col("domain") == domain).select(F.col("key").alias("_key"), F.col("canonical_value").alias(f"{column}_canonical"), F.col("match_method").alias(f"{column}_canonical_match_method"), F.col("review_required").alias(f"{column}_canonical_review_required"))
        df = df.withColumn("_key", match_key(F.col(column))).join(F.broadcast(part) if small else part, "_key", "left").drop("_key")
    return df


def final_value(column: str):
    return F.coalesce(F.col(f"{column}_canonical"), F.col(column))


# The regions, and spellings of those that several spellings merge into.
REGIONS = ("AMAZONAS", "ANCASH", "APURIMAC", "AREQUIPA", "AYACUCHO", "CAJAMARCA", "CALLAO", "CUSCO", "HUANCAVELICA", "HUANUCO", "ICA", "JUNIN", "LA LIBERTAD", "LAMBAYEQUE", "LIMA", "LORETO", "MADRE DE DIOS", "MOQUEGUA", "PASCO", "PIURA", "PUNO", "SAN MARTIN", "TACNA", "TUMBES", "UCAYALI")
MERGED_REGIONS = {"LIMA METROPOLITANA": "LIMA", "LIMA PROVINCIAS": "LIMA", "PROV. CONST. DEL CALLAO": "CALLAO", "PROVINCIA CONSTITUCIONAL DEL CALLAO": "CALLAO"}
PROVINCES = ("CALLAO",)


def region_dimension(spark: SparkSession, names: tuple[str, ...] = REGIONS, merged: dict[str, str] | None = None) -> DataFrame:
    """(source_region, region_key, region, region_scope, mapping_rule, is_aggregated_region): spellings and the region each belongs to."""
    merged = MERGED_REGIONS if merged is None else merged
    several = set(merged.values())
    row = lambda spelling, region: (spelling, region, "province" if region in PROVINCES else "department", f"manual_{region.lower()}_aggregation" if region in several else "identity", region in several)
    rows = [row(n, n) for n in names] + [row(a, b) for a, b in merged.items()]
    df = spark.createDataFrame(rows, "source_region string, region string, region_scope string, mapping_rule string, is_aggregated_region boolean")
    return df.select("source_region", region_key(F.col("source_region")).alias("region_key"), "region", "region_scope", "mapping_rule", "is_aggregated_region")


def join_region(df: DataFrame, dimension: DataFrame, column: str) -> DataFrame:
    """Inner join on the region key; a spelling the dimension doesn't have disappears (count it with unknown_regions)."""
    d = dimension.select("region_key", F.col("region").alias("canonical_region"))
    return df.withColumn("region_key", region_key(F.col(column))).join(F.broadcast(d), "region_key")  # the dimension is a literal table


def unknown_regions(df: DataFrame, dimension: DataFrame, column: str) -> DataFrame:
    d = dimension.select("region_key")
    return df.withColumn("region_key", region_key(F.col(column))).join(F.broadcast(d), "region_key", "left_anti").groupBy(column).count()
