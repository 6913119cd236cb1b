"""Table contracts: JSON lists of {name, type, mode} as Spark schemas, and checks against them."""

from __future__ import annotations

import json
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_TYPES = {
    "STRING": T.StringType(),
    "INT64": T.LongType(),
    "INTEGER": T.LongType(),
    "NUMERIC": T.DecimalType(38, 9),
    "FLOAT64": T.DoubleType(),
    "FLOAT": T.DoubleType(),
    "BOOL": T.BooleanType(),
    "BOOLEAN": T.BooleanType(),
    "DATE": T.DateType(),
    "TIMESTAMP": T.TimestampType(),
    "JSON": T.StringType(),
}


def to_schema(fields: list[dict]) -> T.StructType:
    """REQUIRED fields aren't nullable; REPEATED ones are arrays."""
    out = []
    for f in fields:
        mode = f.get("mode", "NULLABLE").upper()
        try:
            kind = _TYPES[f["type"].upper()]
        except KeyError:
            raise ValueError(f"unknown type of {f['name']}: {f['type']}") from None
        out.append(T.StructField(f["name"], T.ArrayType(kind) if mode == "REPEATED" else kind, mode != "REQUIRED"))
    return T.StructType(out)


def load(path: str | Path) -> list[dict]:
    found = json.loads(Path(path).read_text(encoding="utf-8"))
    if not isinstance(found, list) or any("name" not in f or "type" not in f for f in found):
        raise ValueError(f"not a list of fields: {path}")
    return found


def load_all(folder: str | Path) -> dict[str, list[dict]]:
    """Contracts by table, from <table>_schema.json files."""
    return {p.stem.removesuffix("_schema"): load(p) for p in sorted(Path(folder).glob("*.json"))}


def kinds(fields: list[dict]) -> dict[str, str]:
    """How raw text of each field is read: int, percent, numeric, date or text."""
    def kind(f: dict) -> str:
        t = f["type"].upper()
        if t in ("INT64", "INTEGER"):
            return "int"
        if f["name"].startswith("porcentaje") or f["name"].endswith(("_porcentaje", "_pct")):
            return "percent"
        return {"NUMERIC": "numeric", "FLOAT64": "numeric", "DATE": "date"}.get(t, "text")

    return {f["name"]: kind(f) for f in fields}


def missing_columns(df: DataFrame, fields: list[dict]) -> list[str]:
    return [f["name"] for f in fields if f["name"] not in df.columns]


def unexpected_columns(df: DataFrame, fields: list[dict]) -> list[str]:
    names = {f["name"] for f in fields}
    return [c for c in df.columns if c not in names]


def project(df: DataFrame, fields: list[dict]) -> DataFrame:
    """The contract's columns in its order and types; missing ones are null."""
    return df.select(*[(df[f.name] if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in to_schema(fields)])


def empty_table(spark: SparkSession, fields: list[dict]) -> DataFrame:
    return spark.createDataFrame([], to_schema(fields))


def create_table(spark: SparkSession, name: str, fields: list[dict], partition_by: list[str] | None = None) -> None:
    """An empty managed table of the contract, if there is none."""
    if not spark.catalog.tableExists(name):
        w = empty_table(spark, fields).write.format("parquet")
        (w.partitionBy(*partition_by) if partition_by else w).saveAsTable(name)


def create_external_table(spark: SparkSession, name: str, path: str, fields: list[dict], source: str = "json") -> None:
    """A table over the files of a folder, in the contract's fields; fields of the files that it doesn't know are ignored.

    Partition values in the paths (`key=`) become columns if the contract has them.
    """
    options = {"header": "true"} if source == "csv" else {}
    spark.catalog.createTable(name, path=path, source=source, schema=to_schema(fields), **options)
