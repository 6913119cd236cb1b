"""Validation rules as columns, quarantine of rows that fail, and run metrics."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillon.functions.numbers import NUMBER
from quillon.functions.text import blank_to_null

ERRORS = "array<struct<field:string,code:string,message:string>>"


def _error(when: Column, field: str, code: str, message: str) -> Column:
    return F.when(when, F.struct(F.lit(field).alias("field"), F.lit(code).alias("code"), F.lit(message).alias("message")))


def required(df: DataFrame, fields: list[str]) -> list[Column]:
    """MISSING_FIELD where the column or value is missing, BLANK_FIELD where the text is blank."""
    out = []
    for f in fields:
        if f not in df.columns:
            out.append(_error(F.lit(True), f, "MISSING_FIELD", f"{f} is missing"))
        else:
            c = F.col(f)
            out.append(_error(c.isNull(), f, "MISSING_FIELD", f"{f} is missing"))
            out.append(_error(c.isNotNull() & blank_to_null(c.cast("string")).isNull(), f, "BLANK_FIELD", f"{f} is blank"))
    return out


def numeric_range(field: str, low: float | None = None, high: float | None = None) -> list[Column]:
    """INVALID_NUMERIC, NUMERIC_BELOW_MIN, NUMERIC_ABOVE_MAX; blank passes and a comma is a decimal point."""
    text = F.trim(F.replace(F.col(field).cast("string"), F.lit(","), F.lit(".")))
    value = F.when(text.rlike(NUMBER), text.try_cast("double"))
    out = [_error((text != "") & value.isNull(), field, "INVALID_NUMERIC", f"{field} is no number")]
    if low is not None:
        out.append(_error(value < low, field, "NUMERIC_BELOW_MIN", f"{field} is under {low}"))
    if high is not None:
        out.append(_error(value > high, field, "NUMERIC_ABOVE_MAX", f"{field} is over {high}"))
    return out


def cross_foot(total: str, parts: list[str], tolerance: int = 1) -> Column:
    """FOOTING_MISMATCH where the parts differ from the total by more than the tolerance."""
    return _error(F.abs(sum(F.col(p) for p in parts) - F.col(total)) > tolerance, total, "FOOTING_MISMATCH", f"{'+'.join(parts)} differs from {total}")


def with_errors(df: DataFrame, rules: list[Column]) -> DataFrame:
    """Adds validation_errors, the list of all rules that fail."""
    return df.withColumn("validation_errors", F.array_compact(F.array(*rules)) if rules else F.array().cast(ERRORS))


def split(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid rows, invalid rows with validation_errors)."""
    return df.where(F.size("validation_errors") == 0).drop("validation_errors"), df.where(F.size("validation_errors") > 0)


def first_error(*rules: tuple[Column, str]) -> Column:
    """The message of the first rule whose condition holds, null if none does."""
    out = None
    for condition, message in rules:
        out = F.when(condition, F.lit(message)) if out is None else out.when(condition, F.lit(message))
    return out if out is not None else F.lit(None).cast("string")


def reject(df: DataFrame, stage: str, code: str, message: Column, raw: list[str], partial: list[str] | None = None) -> DataFrame:
    """Rejects as (stage, error_code, error_message, raw_record, partial_record); null keys are left out of the JSON."""
    return df.select(
        F.lit(stage).alias("stage"),
        F.lit(code).alias("error_code"),
        message.alias("error_message"),
        F.to_json(F.struct(*[F.col(c).cast("string").alias(c) for c in raw])).alias("raw_record"),
        (F.to_json(F.struct(*partial)) if partial else F.lit(None).cast("string")).alias("partial_record"),
    )


def unknown_keys(rows: DataFrame, known: list[str], record: str = "record", partial: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(rows, rejects) of rows with a map of each record's keys: a record with a key that its contract lacks is a SCHEMA_MISMATCH.

    The rejects' failed_field is the first unknown key in alphabetical order, failed_value what it holds; raw_record
    is the whole record, and partial_record that of a column given. A null record has no keys.
    """
    extra = F.array_sort(F.array_except(F.map_keys(record), F.array(*map(F.lit, known))))
    some = F.coalesce(F.size(extra) > 0, F.lit(False))
    bad = rows.where(some).withColumn("_extra", extra)
    first = F.get("_extra", F.lit(0))
    rejects = bad.select(
        *[c for c in rows.columns if c not in (record, partial)],
        F.lit("validation").alias("stage"),
        F.lit("SCHEMA_MISMATCH").alias("error_code"),
        F.concat(F.lit("columns that the contract doesn't have: "), F.array_join("_extra", ", ")).alias("error_message"),
        first.alias("failed_field"),
        F.col(record)[first].alias("failed_value"),
        F.to_json(record).alias("raw_record"),
        (F.to_json(partial) if partial else F.lit(None).cast("string")).alias("partial_record"),
    )
    return rows.where(~some), rejects


def union_rejects(*parts: DataFrame) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def summary(spark: SparkSession, counts: DataFrame) -> DataFrame:
    """Adds status and rejection_rate to rows of (records_read, records_valid, records_rejected)."""
    rate = F.when(F.col("records_read") > 0, F.round(F.col("records_rejected") / F.col("records_read"), 6)).otherwise(F.lit(0.0))
    status = F.when((F.col("records_valid") == 0) & (F.col("records_read") > 0), "FAILED").when(F.col("records_rejected") > 0, "COMPLETED_WITH_REJECTIONS").otherwise("COMPLETED")
    return counts.withColumn("rejection_rate", rate).withColumn("status", status)


def audit_event(spark: SparkSession, **fields) -> DataFrame:
    """One row of audit fields as text; metadata, if given, becomes JSON text, and None is null."""
    text = lambda k, v: v if v is None or isinstance(v, str) else json.dumps(v, sort_keys=True) if k == "metadata" else str(v)
    return spark.createDataFrame([tuple(text(k, v) for k, v in fields.items())], ", ".join(f"{k} string" for k in fields))
