"""Table sinks: dispositions, replacing one slice, rejects as JSON lines."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

MODES = {"APPEND": "append", "TRUNCATE": "overwrite", "EMPTY": "errorifexists"}
SLICE = ("extraction_date", "source_system", "source_dataset")


def write_table(spark: SparkSession, df: DataFrame, table: str, disposition: str = "APPEND", create: str = "IF_NEEDED") -> None:
    """APPEND, TRUNCATE or EMPTY (the table must have no rows); create NEVER wants the table to exist."""
    if disposition not in MODES:
        raise ValueError(f"unknown disposition {disposition}; there are {sorted(MODES)}")
    if create not in ("IF_NEEDED", "NEVER"):
        raise ValueError(f"unknown create disposition {create}")
    exists = spark.catalog.tableExists(table)
    if create == "NEVER" and not exists:
        raise ValueError(f"table {table} doesn't exist")
    if disposition == "EMPTY" and exists and spark.table(table).limit(1).count():
        raise ValueError(f"table {table} has rows")
    df.write.mode("append" if exists and disposition == "EMPTY" else MODES[disposition]).format("parquet").saveAsTable(table)


def replace_slice(df: DataFrame, path: str, slice_columns: tuple[str, ...] = SLICE, **values: str) -> None:
    """Replaces one (extraction_date, source_system, source_dataset) of a partitioned table by df.

    A rerun of a load leaves the same rows, and a load without rows leaves the slice empty. Other slices
    aren't touched. A blank value is refused, as is one with characters that paths escape.
    """
    if blank := [c for c in slice_columns if not str(values.get(c, "")).strip()]:
        raise ValueError(f"blank slice values: {blank}")
    if odd := [c for c in slice_columns if not re.fullmatch(r"[\w.-]+", str(values[c]))]:
        raise ValueError(f"slice values with other characters than letters, digits, _ . -: {odd}")
    where = "/".join(f"{c}={values[c]}" for c in slice_columns)
    df.drop(*slice_columns).write.mode("overwrite").parquet(f"{path}/{where}")


def overwrite_slices(df: DataFrame, path: str, slice_columns: tuple[str, ...] = SLICE) -> None:
    """Replaces every slice that df has rows of, by one write; the slices that it has none of stay as they are.

    The write is a dynamic partition overwrite, so a load that fails leaves the old rows. A slice that
    should become empty needs replace_slice, as no row names it.
    """
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*slice_columns).parquet(path)


def dry_run(df: DataFrame) -> None:
    """Computes everything and writes nothing."""
    df.write.format("noop").mode("overwrite").save()


def write_rejects(rejects: DataFrame, root: str) -> None:
    """One JSON line for each reject under root/source_system=/source_dataset=/extraction_date=.

    The three columns must be there; null fields are left out of the lines. A load's rejects take the
    place of those that an earlier run of the same slice left, so a rerun doesn't double them.
    """
    rest = [c for c in rejects.columns if c not in SLICE]
    lines = rejects.select("source_system", "source_dataset", "extraction_date", F.to_json(F.struct(*rest)).alias("value"))
    lines.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("source_system", "source_dataset", "extraction_date").text(root)


def read_rejects(spark: SparkSession, root: str, fields: list[str]) -> DataFrame:
    """(fields..., source_system, source_dataset, extraction_date) of the lines under a root; partition values come back as text."""
    lines = spark.read.schema("value string, source_system string, source_dataset string, extraction_date string").text(root)
    return lines.select(F.from_json("value", ", ".join(f"`{f}` string" for f in fields)).alias("r"), *SLICE[1:], SLICE[0]).select("r.*", *SLICE[1:], SLICE[0])


def write_ordered(df: DataFrame, path: str, *keys: Column, files: int | None = None) -> None:
    """Writes df in the total order of keys (with their null placement): range partitions, each sorted, one file each.

    Rows with equal keys are one partition's, so the last key should tell rows apart. `_file` and `_at`
    keep each row's place, for read_ordered.
    """
    n = files or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = df.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
    rows.select("*", F.spark_partition_id().alias("_file"), F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("_at")).write.mode("overwrite").parquet(path)


def read_ordered(spark: SparkSession, path: str, name: str = "row_no") -> DataFrame:
    """What write_ordered wrote, with each row's number in the whole order, from 1.

    Only the counts of the files are added up in one task, a row a file.
    """
    rows = spark.read.parquet(path)
    counts = rows.groupBy("_file").agg(F.count("*").alias("_n"))
    before = counts.select("_file", (F.sum("_n").over(Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, 0)) - F.col("_n")).alias("_before"))
    return rows.join(before, "_file").withColumn(name, F.col("_before") + F.col("_at") + 1).drop("_file", "_at", "_before")


def write_by_year(df: DataFrame, path: str, column: str = "ano") -> None:
    """Partitioned by the first four-digit run of a column; a row without one is an error."""
    year = F.nullif(F.regexp_extract(F.col(column).cast("string"), r"\d{4}", 0), F.lit(""))
    df.withColumn("year", F.when(year.isNotNull(), year).otherwise(F.raise_error(F.concat(F.lit("no year in "), F.coalesce(F.col(column).cast("string"), F.lit("null")))).cast("string"))).write.mode("overwrite").partitionBy("year").parquet(path)


def write_manifests(manifests: DataFrame, path: str) -> None:
    """manifests(dataset, manifest) as one JSON text a dataset under path/dataset=, with the writer's _SUCCESS marker when all are there."""
    manifests.select("dataset", F.col("manifest").alias("value")).write.mode("overwrite").partitionBy("dataset").text(path)
