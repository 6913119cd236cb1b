"""Data-quality rules as data. All row rules of a table are counted in one scan of it."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

COLUMNS = "check_id string, layer string, table_name string, severity string, failed_rows long, passed boolean, details string"


@dataclass(frozen=True)
class Rule:
    """kind and params: not_empty; nulls(fields); where(condition: SQL text of a failing row);
    allowed(column, values); unique(keys); required_members(column, members); foots(keys, column,
    total, tolerance); present(condition); metadata(fields)."""

    check_id: str
    table: str
    kind: str
    params: dict = field(default_factory=dict)
    severity: str = "ERROR"
    layer: str = "silver"


def _row_test(r: Rule) -> Column | None:
    """Which rows fail, for the kinds that look at one row."""
    p = r.params
    if r.kind in ("nulls", "metadata"):
        out = F.lit(False)
        for f in p["fields"]:
            out |= F.col(f).isNull() | (F.trim(F.col(f).cast("string")) == "")
        return out
    if r.kind == "where":
        return F.expr(p["condition"])
    if r.kind == "allowed":
        return F.col(p["column"]).isNull() | ~F.col(p["column"]).isin(*p["values"])
    return None


def _group_test(df: DataFrame, r: Rule) -> DataFrame:
    """(failed) of the kinds that look at groups."""
    p = r.params
    if r.kind == "unique":
        return df.groupBy(*p["keys"]).count().where("count > 1").agg(F.count("*").alias("failed"))
    if r.kind == "foots":
        return df.groupBy(*p["keys"]).agg(F.sum(p["column"]).alias("s")).where(F.abs(F.col("s") - p.get("total", 1)) > p.get("tolerance", 1e-4)).agg(F.count("*").alias("failed"))
    if r.kind == "required_members":
        wanted = df.sparkSession.createDataFrame([(m,) for m in p["members"]], "m string")
        return wanted.join(df.select(F.col(p["column"]).cast("string").alias("m")).distinct(), "m", "left_anti").agg(F.count("*").alias("failed"))
    raise ValueError(f"unknown kind of rule: {r.kind}")


def _unresolved(plan) -> str | None:
    """What a plan can't be resolved for (a column or function that isn't there, kinds that don't fit), if anything."""
    try:
        plan()
    except AnalysisException as e:
        return str(e).splitlines()[0][:200]
    return None


def run_rules(spark: SparkSession, tables: dict[str, DataFrame], rules: list[Rule], scope: dict[str, str] | None = None) -> DataFrame:
    """One result row for each rule.

    scope ({column: value}) restricts silver tables that have all its columns to the current run. A
    rule whose table, column or condition doesn't exist is a failed row, not an error.
    """
    parts: list[DataFrame] = []
    broken: list[tuple] = []
    order = {r.check_id: i for i, r in enumerate(rules)}
    for name in dict.fromkeys(r.table for r in rules):
        mine = [r for r in rules if r.table == name]
        df = tables.get(name)
        if df is None:
            broken += [(r, f"no table {name}") for r in mine]
            continue
        if scope and all(c in df.columns for c in scope) and mine[0].layer == "silver":
            for c, v in scope.items():
                df = df.where(F.col(c) == v)
        scan: dict[str, Column] = {}
        for r in mine:
            if r.kind in ("not_empty", "present"):
                test = F.lit(True) if r.kind == "not_empty" else F.expr(r.params["condition"])
                scan[r.check_id] = F.when(F.count_if(test) == 0, 1).otherwise(0).cast("long")
            elif (test := _row_test(r)) is not None:
                one = F.count_if(test)
                scan[r.check_id] = (one + F.when(F.count("*") == 0, 1).otherwise(0) if r.kind == "metadata" else one).cast("long")
            elif said := _unresolved(lambda r=r: _group_test(df, r)):
                broken.append((r, said))
            else:
                parts.append(_group_test(df, r).select(F.lit(r.check_id).alias("check_id"), F.col("failed").cast("long").alias("failed_rows")))
        # one analysis for all row rules; only where it fails are they looked at one by one
        if scan and _unresolved(lambda: df.agg(*scan.values())):
            found = {k: _unresolved(lambda c=c: df.agg(c)) for k, c in scan.items()}
            broken += [(r, found[r.check_id]) for r in mine if found.get(r.check_id)]
            scan = {k: c for k, c in scan.items() if not found[k]}
        if scan:
            row = df.agg(*[c.alias(k) for k, c in scan.items()])
            parts.append(row.select(F.explode(F.array(*[F.struct(F.lit(k).alias("check_id"), F.col(f"`{k}`").alias("failed_rows")) for k in scan])).alias("r")).select("r.*"))
    facts = spark.createDataFrame([(r.check_id, r.layer, r.table, r.severity, order[r.check_id]) for r in rules], "check_id string, layer string, table_name string, severity string, _n int")
    counted = None
    for p in parts:
        counted = p if counted is None else counted.unionByName(p)
    errors = spark.createDataFrame([(r.check_id, 1, m) for r, m in broken], "check_id string, failed_rows long, details string")
    counted = errors if counted is None else counted.withColumn("details", F.lit(None).cast("string")).unionByName(errors)
    out = F.broadcast(facts).join(counted, "check_id")  # a row a rule
    details = F.coalesce("details", F.when(F.col("failed_rows") > 0, F.format_string("%d failed", "failed_rows")).otherwise("ok"))
    return out.select("check_id", "layer", "table_name", "severity", "failed_rows", (F.col("failed_rows") == 0).alias("passed"), details.alias("details"))


def failed_run(results: DataFrame) -> bool:
    """Whether any ERROR rule failed; warnings never fail a run."""
    return bool(results.where("severity = 'ERROR' AND NOT passed").limit(1).count())
