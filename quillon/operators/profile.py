"""Profiles of tables and of text quality, one pass over unpivoted (column, value) rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillon.functions.numbers import numeric_safe, value_class
from quillon.functions.text import AGGREGATE_KEYS, CHILD_COLUMNS, EMPTY_ISSUE, ISSUES, MILD_ISSUES, PARENT_COLUMNS, clean_display, is_territorial, is_total, issues, match_key, preview, territorial_action

NULL_LIKE = ("", "null", "none", "nan", "n/a", "na", "-")
IDENTIFIER = r"(^|_)(id|codigo|code|key|ruc|dni|ubigeo|telefono|phone)(_|$)"


def unpivot(df: DataFrame, columns: list[str] | None = None, keep: list[str] = ()) -> DataFrame:
    """(keep..., column, value): each cell as text, nulls included."""
    columns = columns or [c for c in df.columns if c not in keep]
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns])
    return df.select(*keep, F.explode(cells).alias("c")).select(*keep, "c.column", "c.value")


def columns_profile(df: DataFrame, samples: int = 5) -> DataFrame:
    """(column, rows, nulls, empty, distinct_values, max_length, samples, null_percent) of every column.

    Cells are counted by value first, so a frequent value is one row after the first shuffle. samples
    holds the smallest filled values: partial lists are cut to so many before they meet.
    """
    values = unpivot(df).groupBy("column", "value").agg(F.count("*").alias("n"))
    some = F.row_number().over(Window.partitionBy("column", F.pmod(F.xxhash64("value"), F.lit(64))).orderBy("value"))
    few = values.where(F.trim("value") != "").withColumn("r", some).where(F.col("r") <= samples).groupBy("column").agg(F.slice(F.array_sort(F.collect_list("value")), 1, samples).alias("samples"))
    blank = F.trim("value") == ""
    g = values.groupBy("column").agg(
        F.sum("n").alias("rows"),
        F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("n"))), F.lit(0)).alias("nulls"),
        F.coalesce(F.sum(F.when(blank, F.col("n"))), F.lit(0)).alias("empty"),
        F.count_if(F.col("value").isNotNull() & ~blank).alias("distinct_values"),
        F.coalesce(F.max(F.length("value")), F.lit(0)).alias("max_length"),
    )
    g = g.join(F.broadcast(few), "column", "left")  # a row a column
    return g.withColumn("samples", F.coalesce("samples", F.array().cast("array<string>"))).withColumn("null_percent", F.round(100 * (F.col("nulls") + F.col("empty")) / F.col("rows"), 4))


def top_values(df: DataFrame, columns: list[str], n: int = 10) -> DataFrame:
    """(column, value, times, share_percent, place) of the most frequent values of each column."""
    values = unpivot(df, columns).where(F.trim(F.coalesce("value", F.lit(""))) != "").groupBy("column", "value").agg(F.count("*").alias("times"))
    totals = values.groupBy("column").agg(F.sum("times").alias("total"))
    place = F.row_number().over(Window.partitionBy("column").orderBy(F.desc("times"), "value"))
    ranked = values.withColumn("place", place).where(F.col("place") <= n)
    return ranked.join(F.broadcast(totals), "column").select("column", "value", "times", F.round(100 * F.col("times") / F.col("total"), 4).alias("share_percent"), "place")


def type_suggestions(df: DataFrame) -> DataFrame:
    """(column, suggested_type, confidence): the one class that at least 95 % of the filled cells have.

    Names of identifiers are STRING whatever they hold; no filled cell gives UNKNOWN.
    """
    c = unpivot(df).select("column", value_class(F.col("value")).alias("class"))
    count = lambda *names: F.count_if(F.col("class").isin(*names))
    g = c.groupBy("column").agg(count("BOOLEAN", "INTEGER", "NUMERIC", "DATE", "TIMESTAMP", "TEXT").alias("filled"), count("BOOLEAN").alias("b"), count("INTEGER").alias("i"), count("INTEGER", "NUMERIC").alias("n"), count("DATE").alias("d"), count("TIMESTAMP").alias("t"))
    share = lambda x: F.try_divide(F.col(x), F.col("filled"))
    forced = F.lower("column").rlike(IDENTIFIER)
    kind = F.when(F.col("filled") == 0, "UNKNOWN").when(forced, "STRING")
    confidence = F.when(F.col("filled") == 0, F.lit(0.0)).when(forced, F.lit(1.0))
    for x, name in (("b", "BOOLEAN_LIKE"), ("t", "TIMESTAMP"), ("d", "DATE"), ("i", "INTEGER"), ("n", "NUMERIC")):
        kind, confidence = kind.when(share(x) >= 0.95, name), confidence.when(share(x) >= 0.95, share(x))
    return g.select("column", kind.otherwise("STRING").alias("suggested_type"), F.round(confidence.otherwise(F.lit(1.0)), 4).alias("confidence"))


def _ends(df: DataFrame) -> DataFrame:
    """(column, least, most) of the filled cells as text.

    Folded side by side without a key: keyed by column, texts can't stand in a hash table of
    aggregates, so a task would sort all its cells for a row a column.
    """

    def ends(name: str) -> Column:
        value = F.col(f"`{name}`").cast("string")
        filled = F.when(value.rlike(r"(?U)\S"), value)
        return F.struct(F.lit(name).alias("column"), F.min(filled).alias("least"), F.max(filled).alias("most"))

    return df.agg(F.array(*map(ends, df.columns)).alias("e")).select(F.explode("e").alias("e")).select("e.*")


def warnings(df: DataFrame) -> DataFrame:
    """(column, warning), one row each."""
    c = unpivot(df).withColumn("class", value_class(F.col("value")))
    g = c.groupBy("column").agg(
        F.count("*").alias("n"),
        F.count_if(F.col("class") == "EMPTY").alias("empty"),
        F.count_if(F.col("class") == "INTEGER").alias("ints"),
        F.count_if(F.col("class").isin("INTEGER", "NUMERIC")).alias("nums"),
        F.count_if(F.col("class") == "TEXT").alias("texts"),
        F.count_if(F.col("value").rlike(r"^\s*[+-]?\d+,\d{1,2}\s*$")).alias("commas"),
    )
    g = g.join(F.broadcast(_ends(df)), "column")  # a row a column
    filled = F.col("n") - F.col("empty")
    w = F.array_compact(
        F.array(
            F.when(100 * F.col("empty") >= 80 * F.col("n"), "HIGH_NULL_PERCENTAGE"),
            F.when(F.col("empty") == F.col("n"), "ALL_EMPTY"),
            F.when((filled > 1) & (F.col("least") == F.col("most")), "LOW_DISTINCT"),
            F.when((F.col("ints") > 0) & F.lower("column").rlike(IDENTIFIER), "POSSIBLE_IDENTIFIER_AS_NUMBER"),
            F.when(F.col("commas") > 0, "POSSIBLE_DECIMAL_COMMA"),
            F.when((F.col("nums") > 0) & (F.col("texts") > 0), "MIXED_TYPE_VALUES"),
        )
    )
    return g.select("column", F.explode(w).alias("warning"))


def recommendation(null_percent: Column, distinct: Column) -> Column:
    return F.when(null_percent >= 100, "DROP").when((null_percent >= 80) | (distinct <= 1), "REVIEW").otherwise("KEEP")


def sample_profile(df: DataFrame) -> DataFrame:
    """(column, n, null_like, distinct_values, uniqueness, numeric_valid, min, max, mean): numbers where at least 80 % of the filled cells are."""
    c = unpivot(df).withColumn("null_like", F.coalesce(F.lower(F.trim("value")), F.lit("")).isin(*NULL_LIKE))
    v = F.when(~F.col("null_like"), numeric_safe(F.col("value")))
    by = c.groupBy("column", "value", "null_like").agg(F.count("*").alias("n")).withColumn("v", F.when(~F.col("null_like"), numeric_safe(F.col("value"))))
    g = by.groupBy("column").agg(F.sum("n").alias("rows"), F.coalesce(F.sum(F.when(F.col("null_like"), F.col("n"))), F.lit(0)).alias("null_like"), F.count_if(~F.col("null_like")).alias("distinct_values"), F.coalesce(F.sum(F.when(F.col("v").isNotNull(), F.col("n"))), F.lit(0)).alias("numeric_valid"), F.min("v").alias("lo"), F.max("v").alias("hi"), F.sum(F.col("v") * F.col("n")).alias("s"))
    filled = F.col("rows") - F.col("null_like")
    enough = (F.col("numeric_valid") > 0) & (F.col("numeric_valid") >= 0.8 * filled)
    return g.select("column", "rows", "null_like", "distinct_values", F.round(F.try_divide("distinct_values", filled), 6).alias("uniqueness"), "numeric_valid", F.when(enough, F.col("lo")).alias("min_value"), F.when(enough, F.col("hi")).alias("max_value"), F.when(enough, F.round(F.col("s") / F.col("numeric_valid"), 6)).alias("mean_value"))


# Texts that a sample's profile takes for null, after trimming, and what a date column's name holds.
SAMPLE_NULLS = ("", "null", "none", "nan", "NaN", "NULL", "None", "-")
DATE_NAMES = ("fecha", "date")
#: Shares from which a column is mostly numbers or dates, and percentage of nulls from which it is listed; values listed.
MOSTLY, HIGH_NULL, LISTED = 0.8, 50, 5


def _sample_number(value: Column) -> Column:
    """The number of a text with points between thousands and a decimal comma; null if it is none."""
    t = F.trim(F.replace(F.replace(value, F.lit("."), F.lit("")), F.lit(","), F.lit(".")))
    return F.when(t.rlike(r"^[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?$"), t.try_cast("double"))


def _sample_date(value: Column) -> Column:
    """The time of a text that begins with a date, the day first or in ISO order."""
    t = F.trim(value)
    day, time = F.split(F.replace(t, F.lit("T"), F.lit(" ")), " ", 2), F.lit(" ")
    iso = F.coalesce(F.try_to_date(F.get(day, F.lit(0)), "yyyy-MM-dd"), F.try_to_date(F.get(day, F.lit(0)), "dd/MM/yyyy"), F.try_to_date(F.get(day, F.lit(0)), "dd-MM-yyyy"))
    return F.concat(iso.cast("string"), time, F.coalesce(F.get(day, F.lit(1)), F.lit("00:00:00"))).try_cast("timestamp_ntz")


def profiled_columns(df: DataFrame) -> DataFrame:
    """(column, non_null_count, null_count, null_percentage, unique_count, unique_percentage, sample_values, top_values,
    numeric and date counts, numeric_min/max/mean and date_min/max of columns that mostly are, is_mostly_numeric, is_mostly_date).

    Cells are counted by value in one pass, and all else is read off that count: a frequent value is parsed
    once. Samples are the smallest values, top values the most frequent, ties by value. Only columns
    whose name says so are looked at for dates.
    """
    cells = unpivot(df).withColumn("value", F.when(~F.trim("value").isin(*SAMPLE_NULLS), F.col("value")))
    values = cells.groupBy("column", "value").agg(F.count("*").alias("n"))
    dated = F.lower("column").rlike("|".join(DATE_NAMES))
    parsed = values.withColumns({"v": _sample_number(F.col("value")), "d": F.when(dated, _sample_date(F.col("value")))})
    some = F.col("value").isNotNull()
    count = lambda when: F.coalesce(F.sum(F.when(when, F.col("n"))), F.lit(0))
    g = parsed.groupBy("column").agg(
        F.sum("n").alias("rows"), count(some).alias("non_null_count"), F.count("value").alias("unique_count"), count(F.col("v").isNotNull()).alias("numeric_valid_count"), count(F.col("d").isNotNull()).alias("date_valid_count"),
        F.min("v").alias("v_min"), F.max("v").alias("v_max"), F.sum(F.col("v") * F.col("n")).alias("v_sum"), F.min("d").alias("d_min"), F.max("d").alias("d_max"),
    )
    listed = {}
    for name, order in (("sample_values", [F.asc("value")]), ("top_values", [F.desc("n"), F.asc("value")])):
        place = F.row_number().over(Window.partitionBy("column").orderBy(*order))
        few = values.where(some).withColumn("place", place).where(F.col("place") <= LISTED)
        listed[name] = few.groupBy("column").agg(F.transform(F.array_sort(F.collect_list(F.struct("place", "value", "n"))), lambda x: F.struct(x["value"].alias("value"), x["n"].alias("times"))).alias(name))
    for few in listed.values():
        g = g.join(few, "column", "left")  # a row a column
    share = lambda c: F.coalesce(F.try_divide(F.col(c), F.col("non_null_count")), F.lit(0.0)) >= MOSTLY
    percent = lambda c: F.round(100 * c / F.col("rows"), 2)
    numeric, date = (F.col("numeric_valid_count") > 0) & share("numeric_valid_count"), (F.col("date_valid_count") > 0) & share("date_valid_count")
    none = F.array().cast("array<struct<value:string,times:bigint>>")
    return g.select(
        "column", "non_null_count", (F.col("rows") - F.col("non_null_count")).alias("null_count"), percent(F.col("rows") - F.col("non_null_count")).alias("null_percentage"), "unique_count", percent(F.col("unique_count")).alias("unique_percentage"),
        F.transform(F.coalesce("sample_values", none), lambda x: x["value"]).alias("sample_values"), F.coalesce("top_values", none).alias("top_values"),
        numeric.alias("is_mostly_numeric"), "numeric_valid_count", (F.col("non_null_count") - F.col("numeric_valid_count")).alias("numeric_invalid_count"), F.when(numeric, F.col("v_min")).alias("numeric_min"), F.when(numeric, F.col("v_max")).alias("numeric_max"), F.when(numeric, F.round(F.col("v_sum") / F.col("numeric_valid_count"), 4)).alias("numeric_mean"),
        date.alias("is_mostly_date"), "date_valid_count", (F.col("non_null_count") - F.col("date_valid_count")).alias("date_invalid_count"), F.when(date, F.col("d_min")).alias("date_min"), F.when(date, F.col("d_max")).alias("date_max"),
    )


def table_facts(df: DataFrame, columns: DataFrame | None = None) -> DataFrame:
    """One row: row_count, column_count, duplicated_rows, and the names of the columns that are mostly null, numbers or dates, sorted."""
    columns = profiled_columns(df) if columns is None else columns
    names = lambda when: F.array_sort(F.collect_list(F.when(when, F.col("column"))))
    lists = columns.agg(F.count("*").alias("column_count"), names(F.col("null_percentage") >= HIGH_NULL).alias("high_null_columns"), names(F.col("is_mostly_numeric")).alias("mostly_numeric_columns"), names(F.col("is_mostly_date")).alias("mostly_date_columns"))
    plain = df.select(*[F.when(~F.trim(F.col(f"`{c}`").cast("string")).isin(*SAMPLE_NULLS), F.col(f"`{c}`").cast("string")).alias(c) for c in df.columns])
    rows = duplicate_rows(plain).select(F.col("rows").alias("row_count"), F.col("duplicates").alias("duplicated_rows"))
    return rows.join(F.broadcast(lists))  # one row each


def date_profile(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, valid_ratio, first, last) of columns that hold dates as text."""
    c = unpivot(df, columns).where("trim(coalesce(value, '')) <> ''")
    d = F.coalesce(F.try_to_date(F.substring("value", 1, 10), "yyyy-MM-dd"), F.try_to_date(F.substring("value", 1, 10), "dd/MM/yyyy"))
    return c.withColumn("d", d).groupBy("column").agg(F.round(F.count("d") / F.count("*"), 6).alias("valid_ratio"), F.min("d").alias("first"), F.max("d").alias("last"))


def duplicate_rows(df: DataFrame) -> DataFrame:
    """(rows, duplicates): rows beyond the first of equal rows."""
    g = df.groupBy(*df.columns).agg(F.count("*").alias("_n"))
    return g.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("rows"), F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicates"))


# --- text quality ---------------------------------------------------------------------------------


def issue_summary(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, n, and a count for each issue code)."""
    c = unpivot(df, columns).groupBy("column", "value").agg(F.count("*").alias("times")).withColumn("issues", issues(F.col("value")))
    codes = [EMPTY_ISSUE, *[code for code, _ in ISSUES]]
    return c.groupBy("column").agg(F.sum("times").alias("n"), F.count_if(F.col("value").isNotNull()).alias("distinct_values"), *[F.coalesce(F.sum(F.when(F.array_contains("issues", code), F.col("times"))), F.lit(0)).alias(code.lower()) for code in codes])


def anomalies(df: DataFrame, columns: list[str], id_column: str) -> DataFrame:
    """(column, value, issue, times, suggested, key, example_id) of every issue but the mild ones.

    example_id is the smallest id with the value.
    """
    c = unpivot(df, columns, [id_column]).groupBy("column", "value").agg(F.count("*").alias("times"), F.min(id_column).alias("example_id"))
    p = c.withColumn("issue", F.explode(F.array_except(issues(F.col("value")), F.array(*map(F.lit, MILD_ISSUES)))))
    return p.select("column", "value", "issue", "times", clean_display(F.col("value")).alias("suggested"), match_key(F.col("value")).alias("key"), "example_id")


def normalisation_preview(df: DataFrame, columns: list[str], n: int = 100) -> DataFrame:
    """(column, times, and the steps of preview()) of the n most frequent values of each column."""
    top = top_values(df, columns, n)
    return top.select("column", "times", "place", preview(F.col("value")).alias("p")).select("column", "times", "place", "p.*")


def alias_groups(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, key, spellings, times, originals): matching keys with several spellings.

    originals lists the spellings joined by ` | `, sorted.
    """
    v = unpivot(df, columns).where("value IS NOT NULL").groupBy("column", "value").agg(F.count("*").alias("times")).withColumn("key", match_key(F.col("value"))).where("key IS NOT NULL")
    return v.groupBy("column", "key").agg(F.count("*").alias("spellings"), F.sum("times").alias("times"), F.array_join(F.array_sort(F.collect_list("value")), " | ").alias("originals")).where("spellings > 1")


def territorial_rows(df: DataFrame, keep: list[str]) -> DataFrame:
    """(keep..., parent_column, parent_value, column, value, issue, action): two issues for each total in a territorial column.

    The parent is the first filled parent column of the row, "" where none is.
    """
    columns = [c for c in df.columns if is_territorial(c)]
    filled = lambda c: F.when(F.col(c).cast("string") != "", F.struct(F.lit(c.lower()).alias("column"), F.col(c).cast("string").alias("value")))
    parents = [filled(c) for c in columns if c.lower() in PARENT_COLUMNS]
    none = F.struct(F.lit("").alias("column"), F.lit("").alias("value"))
    rows = df.withColumn("parent", F.coalesce(*parents, none)).select(*keep, "parent", *columns)
    c = unpivot(rows, columns, [*keep, "parent"]).where(is_total(F.col("value")))
    below = F.lower("column").isin(*CHILD_COLUMNS) & (F.col("parent.column") != "")
    second = F.when(below | match_key(F.col("value")).isin(*AGGREGATE_KEYS), "AGGREGATE_TOTAL_ROW").otherwise("POSSIBLE_NON_TERRITORIAL_VALUE")
    c = c.withColumn("issue", F.explode(F.array(F.lit("TERRITORIAL_TOTAL_VALUE"), second)))
    return c.select(*keep, F.col("parent.column").alias("parent_column"), F.col("parent.value").alias("parent_value"), F.lower("column").alias("column"), "value", "issue", territorial_action(F.col("value")).alias("action"))


def mixed_granularity(df: DataFrame) -> DataFrame:
    """(column, totals, details, mixed) of the territorial columns."""
    c = unpivot(df, [x for x in df.columns if is_territorial(x)]).where("value IS NOT NULL").groupBy("column", "value").agg(F.count("*").alias("n"))
    t = is_total(F.col("value"))
    g = c.groupBy("column").agg(F.coalesce(F.sum(F.when(t, F.col("n"))), F.lit(0)).alias("totals"), F.coalesce(F.sum(F.when(~t, F.col("n"))), F.lit(0)).alias("details"))
    return g.withColumn("mixed", (F.col("totals") > 0) & (F.col("details") > 0))
