"""What stands under a landing root: files, rows, columns, dates and years by dataset, and totals over them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillon.sources.readers import json_records, partition_value

#: Systems whose datasets have years.
YEARLY = ("MEF",)


def dataset_summary(spark: SparkSession, root: str, pattern: str = "*.jsonl", year_field: str = "ano", yearly: tuple[str, ...] = YEARLY) -> DataFrame:
    """(source_system, dataset, file_count, row_count, column_count, extraction_dates_detected, years_detected).

    Files stand under root/system/dataset/extraction_date=/...; each line is a JSON record, and a dataset's
    columns are the keys that any of its records has. Dates come from the paths, one for each file; years, of
    yearly systems only, from the paths and the year field, each once. Both are joined by `|`. A file
    of blank lines counts as a file; one of no bytes isn't seen by Spark's readers. Records are counted by file first, so a dataset of many files is
    a row a file when it is added up.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(root).select(F.col("_metadata.file_path").alias("path"))
    records = json_records(spark, root, pattern).where("record IS NOT NULL")
    by_file = records.groupBy("path").agg(F.count("*").alias("n"), F.array_distinct(F.flatten(F.collect_set(F.array_sort(F.map_keys("record"))))).alias("keys"), F.collect_set(F.nullif(F.trim(F.col("record")[year_field]), F.lit(""))).alias("years"))
    path = F.col("path")
    rows = files.join(by_file, "path", "left").select(
        F.regexp_extract(path, "/([^/]+)/[^/]+/extraction_date=", 1).alias("source_system"),
        F.regexp_extract(path, "/([^/]+)/extraction_date=", 1).alias("dataset"),
        partition_value(path, "extraction_date").alias("date"),
        F.array_compact(F.array_append(F.coalesce("years", F.array().cast("array<string>")), partition_value(path, "year"))).alias("years"),
        F.coalesce("n", F.lit(0)).alias("n"),
        F.coalesce("keys", F.array().cast("array<string>")).alias("keys"),
    )
    together = lambda c: F.array_distinct(F.flatten(F.collect_set(c)))
    g = rows.groupBy("source_system", "dataset").agg(F.count("*").alias("file_count"), F.sum("n").alias("row_count"), F.size(together("keys")).cast("long").alias("column_count"), F.array_join(F.array_sort(F.collect_list("date")), "|").alias("extraction_dates_detected"), F.array_join(F.array_sort(together("years")), "|").alias("years_detected"))
    return g.withColumn("years_detected", F.when(F.upper("source_system").isin(*yearly), F.col("years_detected")).otherwise(""))


def summary_totals(summary: DataFrame) -> DataFrame:
    """(source_system, total_datasets, total_files, total_rows): one row for each system and, with a null system, one for all, by one rollup."""
    g = summary.rollup("source_system").agg(F.count("*").alias("total_datasets"), F.sum("file_count").alias("total_files"), F.sum("row_count").alias("total_rows"), F.grouping("source_system").alias("_all"))
    return g.select(F.when(F.col("_all") == 0, F.coalesce("source_system", F.lit(""))).alias("source_system"), "total_datasets", F.coalesce("total_files", F.lit(0)).alias("total_files"), F.coalesce("total_rows", F.lit(0)).alias("total_rows"))
