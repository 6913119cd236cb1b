"""Gold marts: execution ratios, tall indicators, coverage shares, unit costs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def cents(c: Column) -> Column:
    """An amount as whole cents, so that sums don't depend on the order of rows."""
    return F.floor(c * 100 + 0.5).cast("bigint")


def percent(n: Column, d: Column, digits: int = 6) -> Column:
    """100 n / d; null without a divisor."""
    return F.round(F.try_divide(100.0 * n, F.nullif(d, F.lit(0).cast("bigint"))), digits)


def execution(rows: DataFrame, keys: list[str], opening: Column, modified: Column, executed: Column) -> DataFrame:
    """(keys, opening, modified, executed, balance, execution_percent, modification_percent)."""
    g = rows.groupBy(*keys).agg(F.sum(cents(opening)).alias("opening"), F.sum(cents(modified)).alias("modified"), F.sum(cents(executed)).alias("executed"))
    return g.select(
        *keys,
        "opening",
        "modified",
        "executed",
        (F.col("modified") - F.col("executed")).alias("balance"),
        percent(F.col("executed"), F.col("modified")).alias("execution_percent"),
        percent(F.col("modified") - F.col("opening"), F.col("opening")).alias("modification_percent"),
    )


def indicator(rows: DataFrame, name: str, period: Column, member: Column, value: Column) -> DataFrame:
    """(indicator, period, member, value): one tall indicator."""
    return rows.groupBy(period.alias("period"), member.alias("member")).agg(value.cast("bigint").alias("value")).select(F.lit(name).alias("indicator"), "period", "member", "value")


def union_indicators(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def unit_cost(grants: DataFrame, budget: DataFrame, key: str) -> DataFrame:
    """(key, grants, executed, cost_per_grant) of a full outer join; either side may lack a period."""
    return grants.join(budget, key, "full").select(key, "grants", "executed", F.round(F.try_divide(F.col("executed") / 100.0, F.col("grants").cast("double")), 4).alias("cost_per_grant"))


def coverage_shares(counts: DataFrame, group: str, value: str) -> DataFrame:
    """Adds share_percent of the whole group, rank inside it and the running total by rank."""
    by = Window.partitionBy(group)
    order = by.orderBy(F.desc(value), "member")
    return counts.select(
        "*",
        percent(F.col(value), F.sum(value).over(by)).alias("share_percent"),
        F.rank().over(by.orderBy(F.desc(value))).cast("bigint").alias("rank"),
        F.sum(value).over(order.rowsBetween(Window.unboundedPreceding, 0)).cast("bigint").alias("running"),
    )
