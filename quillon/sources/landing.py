"""Landing checks: page ranges, chunk consolidation, counts and manifests, all as tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def split_pages(discovery: DataFrame, single: Column | None = None) -> DataFrame:
    """discovery(dataset, total_pages, chunk_size) -> (dataset, chunk_id, page_start, page_end).

    No page gives one row (1, 0); a dataset marked single is one chunk.
    """
    total = F.coalesce(F.col("total_pages").cast("long"), F.lit(0))
    size = F.when(F.coalesce(single, F.lit(False)) if single is not None else F.lit(False), F.greatest(total, F.lit(1))).otherwise(F.greatest(F.col("chunk_size").cast("long"), F.lit(1)))
    rows = discovery.select("dataset", total.alias("total_pages"), size.alias("_size"), F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.ceil(total / size) - 1, F.lit(0)).cast("long"))).alias("_i"))
    return rows.select("dataset", F.format_string("%s_%04d", "dataset", F.col("_i") + 1).alias("chunk_id"), (F.col("_i") * F.col("_size") + 1).alias("page_start"), F.least((F.col("_i") + 1) * F.col("_size"), F.col("total_pages")).alias("page_end"))


def page_faults(chunks: DataFrame) -> DataFrame:
    """(dataset, chunk_id, fault) where ranges of chunks(dataset, chunk_id, page_start, page_end) leave a GAP, OVERLAP or are a DUPLICATE."""
    w = Window.partitionBy("dataset").orderBy("page_start", "page_end", "chunk_id")
    before = chunks.withColumn("_end", F.max("page_end").over(w.rowsBetween(Window.unboundedPreceding, -1))).withColumn("_n", F.count("*").over(Window.partitionBy("dataset", "page_start", "page_end")))
    fault = F.when(F.col("_n") > 1, "DUPLICATE").when(F.col("_end").isNull() & (F.col("page_start") > 1), "GAP").when(F.col("page_start") > F.col("_end") + 1, "GAP").when(F.col("page_start") <= F.col("_end"), "OVERLAP")
    return before.select("dataset", "chunk_id", fault.alias("fault")).where("fault IS NOT NULL")


def covers_all(chunks: DataFrame, discovery: DataFrame) -> DataFrame:
    """(dataset, covered): whether the ranges run from 1 to total_pages."""
    ends = chunks.groupBy("dataset").agg(F.min("page_start").alias("lo"), F.max("page_end").alias("hi"))
    return discovery.join(ends, "dataset", "left").select("dataset", F.coalesce((F.col("lo") == 1) & (F.col("hi") == F.col("total_pages")), F.lit(False)).alias("covered"))


def consolidate_chunks(plan: DataFrame, manifests: DataFrame) -> DataFrame:
    """One row for each dataset of plan(dataset, chunk_id): its chunks' manifests (dataset, chunk_id,
    status, extraction_date, run_id, page_size, records_written, started_at, finished_at) together.

    ok wants every planned chunk, all SUCCESS, one date, one run and one page size.
    """
    j = plan.select("dataset", "chunk_id").join(manifests, ["dataset", "chunk_id"], "left")
    g = j.groupBy("dataset").agg(
        F.count("*").alias("chunks"),
        F.count("status").alias("chunks_found"),
        F.count_if(F.col("status") == "SUCCESS").alias("chunks_ok"),
        F.size(F.collect_set("extraction_date")).alias("dates"),
        F.size(F.collect_set("run_id")).alias("runs"),
        F.size(F.collect_set("page_size")).alias("page_sizes"),
        F.sum("records_written").alias("records_written"),
        F.min("started_at").alias("started_at"),
        F.max("finished_at").alias("finished_at"),
    )
    ok = (F.col("chunks_ok") == F.col("chunks")) & (F.col("dates") == 1) & (F.col("runs") == 1) & (F.col("page_sizes") == 1)
    return g.withColumn("ok", ok)


def reconcile_counts(written: DataFrame, expected: DataFrame, tolerant: list[str] = ()) -> DataFrame:
    """(dataset, expected, written, passed) of written(dataset, records) against expected(dataset, records)."""
    got = written.groupBy("dataset").agg(F.sum("records").alias("written"))
    j = expected.select("dataset", F.col("records").alias("expected")).join(got, "dataset", "full").select("dataset", F.coalesce("expected", F.lit(0)).alias("expected"), F.coalesce("written", F.lit(0)).alias("written"))
    return j.withColumn("passed", (F.col("expected") == F.col("written")) | F.col("dataset").isin(*tolerant) if tolerant else F.col("expected") == F.col("written"))


def manifest_faults(expected: DataFrame, manifests: DataFrame, fields: tuple[str, ...] = ("system", "extraction_date", "status"), markers: DataFrame | None = None) -> DataFrame:
    """(dataset, faults): every expected dataset whose manifest is missing or differs, all faults of it together.

    markers(dataset, fields...): what the success markers say, of those that are there; with them, a missing marker or one
    that differs is a fault too (MARKER_MISSING, MARKER_STATUS_MISMATCH and the like). Both sides have a row a dataset.
    """
    sides = {"": manifests} | ({"MARKER_": markers} if markers is not None else {})
    j, faults = expected.alias("e"), []
    for i, (prefix, side) in enumerate(sides.items()):
        j = j.join(side.alias(f"m{i}"), F.col("e.dataset") == F.col(f"m{i}.dataset"), "left")
        missing = F.col(f"m{i}.dataset").isNull()
        faults += [F.when(missing, F.lit(f"{prefix}MISSING")), *[F.when(~missing & ~F.col(f"e.{f}").eqNullSafe(F.col(f"m{i}.{f}")), F.lit(f"{prefix}{f.upper()}_MISMATCH")) for f in fields]]
    return j.select(F.col("e.dataset").alias("dataset"), F.array_compact(F.array(*faults)).alias("faults")).where(F.size("faults") > 0)


def success_manifest(chunks: DataFrame) -> DataFrame:
    """(dataset, manifest): the JSON summary of a dataset's chunks, in page order."""
    g = chunks.groupBy("dataset").agg(F.min("started_at").alias("started_at"), F.max("finished_at").alias("finished_at"), F.sum("records_written").alias("records_written"), F.array_sort(F.collect_list(F.struct("page_start", "page_end", "chunk_id", "records_written"))).alias("chunks"))
    return g.select("dataset", F.to_json(F.struct(F.lit("SUCCESS").alias("status"), "dataset", "started_at", "finished_at", "records_written", "chunks")).alias("manifest"))


def dataset_of_landing_file(name: Column) -> Column:
    """report_x_2026-06-15.csv -> report_x."""
    return F.regexp_extract(name, r"^(.*?)(?:[_-]\d{4}-?\d{2}-?\d{2})?\.[A-Za-z]+$", 1)


def latest_files(files: DataFrame) -> DataFrame:
    """(dataset, path): of files(path, name, modified) the one modified last of each dataset that the names tell; ties go to the last path."""
    return files.groupBy(dataset_of_landing_file(F.col("name")).alias("dataset")).agg(F.max_by("path", F.struct("modified", "path")).alias("path"))
